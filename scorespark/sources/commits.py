"""Files that are made once: the commit primitive of the registry, the streams and the retrain triggers.

Whoever creates the file owns what it names; everybody else learns that it exists. On a local
file system the whole content appears at once (a hard link, which fails if the name is
taken); elsewhere the file system's create without overwriting decides.
"""

from __future__ import annotations

import os
import time
import uuid

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create ``path`` with ``text``; False, and nothing is changed, if there is such a file."""
    fs, place = _file_system(spark, path)
    if fs.getScheme() == "file":
        target = place.toUri().getPath()
        os.makedirs(os.path.dirname(target), exist_ok=True)
        draft = os.path.join(os.path.dirname(target), f".{uuid.uuid4().hex}")
        with open(draft, "w", encoding="utf-8") as f:
            f.write(text)
        try:
            os.link(draft, target)
            return True
        except FileExistsError:
            return False
        finally:
            os.remove(draft)
    try:
        out = fs.create(place, False)
    except Exception:
        if fs.exists(place):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def read_once(spark: SparkSession, path: str, patience: float = 30.0) -> str | None:
    """The text of a file made by :func:`create_once`; None if there is none.

    Where a new file is empty until its writer closes it, wait for that.
    """
    fs, place = _file_system(spark, path)
    until = time.time() + patience
    while fs.exists(place):
        if fs.getFileStatus(place).getLen() or time.time() > until:
            stream = fs.open(place)
            try:
                return bytes(stream.readAllBytes()).decode()
            finally:
                stream.close()
        time.sleep(0.1)
    return None


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a folder that need not exist; drafts are left out."""
    fs, place = _file_system(spark, folder)
    if not fs.exists(place):
        return []
    found = [status.getPath().getName() for status in fs.listStatus(place)]
    return sorted(n for n in found if not n.startswith((".", "_")))
