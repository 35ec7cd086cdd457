"""Tasks that hold all rows of a fit and add up their sums over and over in one barrier stage."""

from __future__ import annotations

import base64
import os
import time
import uuid
from math import isqrt
from urllib.parse import urlparse

import numpy as np
from pyspark import BarrierTaskContext
from pyspark.sql import SparkSession

from scorespark.models.histogram_trees import ROWS_A_TASK

#: Bytes of rows that a task holds at most, and bytes that all tasks together get of one another's sums at a time.
HELD_BYTES, SENT_BYTES = 1 << 29, 1 << 28
#: Seconds until files of the others count as out of reach, and until a task that waits for them gives up.
SEEN_WITHIN, WAIT = 20, 1800


def together(spark: SparkSession, rows: int, row_bytes: int, sums_bytes: int) -> int:
    """Tasks that run at once and hold all rows for the whole fit; 0 where rows, sums or the session do not allow it."""
    if spark.conf.get("spark.dynamicAllocation.enabled", "false") == "true":
        return 0  # has no barrier stages
    context = spark.sparkContext._jsc.sc()
    slots = context.maxNumConcurrentTasks(context.resourceProfileManager().defaultResourceProfile())
    most = max(1, HELD_BYTES // row_bytes)
    tasks = max(1, min(rows // ROWS_A_TASK, slots, isqrt(SENT_BYTES // sums_bytes)), -(-rows // most))
    return tasks if tasks <= slots and tasks * tasks * sums_bytes <= SENT_BYTES else 0


class Exchange:
    """Adds up arrays of whole numbers over all tasks of a barrier stage; every task gets the same totals.

    The arrays go by files of ``folder``, on storage that all tasks reach. Where it is no path of a file system, or some
    task does not see the files of the others, they go by the driver, which takes a second each time.
    """

    def __init__(self, folder: str):
        self.context = BarrierTaskContext.get()
        self.me, self.tasks, self.turn = self.context.partitionId(), len(self.context.getTaskInfos()), 0
        self.by_files = False
        if self.tasks > 1:
            # a stage that is tried again has a folder of its own
            place = urlparse(folder)
            self.folder = os.path.join(place.path, self.context.allGather(uuid.uuid4().hex)[0])
            seen = place.scheme in ("", "file") and self._seen()
            self.by_files = all(x == "seen" for x in self.context.allGather("seen" if seen else "-"))

    def added(self, own: np.ndarray) -> np.ndarray:
        if self.tasks == 1:
            return own
        if not self.by_files:
            everyone = self.context.allGather(base64.b64encode(own.tobytes()).decode())
            return sum(np.frombuffer(base64.b64decode(x), dtype=own.dtype) for x in everyone).reshape(own.shape)
        self.turn += 1
        self._put(f"{self.turn}-{self.me}", own.tobytes())
        total = own.copy()
        for k in range(self.tasks):
            if k != self.me:
                total += np.frombuffer(self._get(f"{self.turn}-{k}", WAIT), dtype=own.dtype).reshape(own.shape)
        # who has given this turn's has read the last one's
        if self.turn > 1:
            os.unlink(os.path.join(self.folder, f"{self.turn - 1}-{self.me}"))
        return total

    def _seen(self) -> bool:
        try:
            os.makedirs(self.folder, exist_ok=True)
            self._put(f"0-{self.me}", b"-")
            for k in range(self.tasks):
                self._get(f"0-{k}", SEEN_WITHIN)
            return True
        except OSError:
            return False

    def _put(self, name: str, content: bytes) -> None:
        path = os.path.join(self.folder, name)
        with open(f"{path}.part", "wb") as file:
            file.write(content)
        os.replace(f"{path}.part", path)

    def _get(self, name: str, seconds: float) -> bytes:
        until = time.monotonic() + seconds
        while True:
            try:
                with open(os.path.join(self.folder, name), "rb") as file:
                    return file.read()
            except FileNotFoundError:
                if time.monotonic() > until:
                    raise
            time.sleep(0.002)
