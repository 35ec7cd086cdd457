"""Exact deduplication by Grace hashing.

Texts are equal when they are identical after deleting white space. Of equal
texts the row with the most code points in the original text stays, then the
smallest doc_id, then one of the rows that repeat an id.

1. Every scan task keeps a table of the contents it has seen (at most
   ``memory`` bytes of them at a time) and writes one group row per content with
   the count and the best row, and one slim row per document. A content that a
   third of all rows share leaves each task once.
2. Group rows are dealt by content hash. A reduce task that gets more bytes than
   fit its memory splits them by further hash bits into spill files, and those
   again, until a bucket fits one open-addressing table (a dict keyed by the
   complete content: equal hashes alone never join two texts).
3. Group numbers return to the slim rows by a join on the task's own group.

Null texts count as empty, and all empty texts are one group. Rows without
doc_id take part and lose ties. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorespark.llm.text import WHITE, WHITE_CLASS, bounded_batches, documents_view
from scorespark.session import stage

#: Bytes of content that a task holds at a time.
MEMORY = 48 << 20
FAN_OUT = 16
_SCANNED = (
    "kind int, row_id long, doc_id long, local_id long, sha binary, points long, members long, content binary"
)
_NO_ID = 1 << 63

Record = tuple  # (sha, content, (-points, doc_id or _NO_ID, row_id), members, local groups)


def _scan(memory: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        row = local = held = 0
        table: dict[bytes, list] = {}

        def groups() -> pa.RecordBatch:
            best = [g[2] for g in table.values()]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([1] * len(table), pa.int32()),
                    pa.array([b[2] for b in best], pa.int64()),
                    pa.array([None if b[1] == _NO_ID else b[1] for b in best], pa.int64()),
                    pa.array([g[0] for g in table.values()], pa.int64()),
                    pa.array([g[1] for g in table.values()], pa.binary()),
                    pa.array([-b[0] for b in best], pa.int64()),
                    pa.array([g[3] for g in table.values()], pa.int64()),
                    pa.array(list(table), pa.binary()),
                ],
                names=names,
            )

        names = [c.split()[0] for c in _SCANNED.split(", ")]
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            points = pc.utf8_length(batch.column("text")).to_pylist()
            texts = batch.column("text").cast(pa.binary())
            locals_, shas, rows = [], [], []
            for doc_id, n, text in zip(ids, points, texts):
                content = text.as_py().translate(None, WHITE)
                row += 1
                order = (-n, _NO_ID if doc_id is None else doc_id, base + row)
                group = table.get(content)
                if group is None:
                    local += 1
                    group = table[content] = [base + local, hashlib.sha256(content).digest(), order, 0]
                    held += len(content) + 200
                elif order < group[2]:
                    group[2] = order
                group[3] += 1
                locals_.append(group[0])
                shas.append(group[1])
                rows.append(base + row)
                if held > memory:
                    yield groups()
                    table, held = {}, 0
            n = len(ids)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([0] * n, pa.int32()),
                    pa.array(rows, pa.int64()),
                    batch.column("doc_id"),
                    pa.array(locals_, pa.int64()),
                    pa.array(shas, pa.binary()),
                    pa.array(points, pa.int64()),
                    pa.array([1] * n, pa.int64()),
                    pa.nulls(n, pa.binary()),
                ],
                names=names,
            )
        if table:
            yield groups()

    return run


def _joined(table: dict[bytes, Record], record: Record) -> int:
    """Add a record to the open-addressing table; the bytes it takes up."""
    held = table.get(record[1])
    if held is None:
        table[record[1]] = record
        return len(record[1]) + 200
    sha, content, order, members, locals_ = held
    table[content] = (sha, content, min(order, record[2]), members + record[3], locals_ + record[4])
    return 16 * len(record[4])


def grace(records: Iterable[Record], memory: int, level: int = 0) -> Iterator[Record]:
    """One record per content for records in any order, with ``memory`` bytes of content held at a time."""
    table: dict[bytes, Record] = {}
    size, more = 0, iter(records)
    for record in more:
        size += _joined(table, record)
        if size > memory and len(table) > 1 and level < 40:
            break
    else:
        yield from table.values()
        return
    with tempfile.TemporaryDirectory(prefix="grace-") as folder:
        paths = [os.path.join(folder, str(k)) for k in range(FAN_OUT)]
        files = [open(p, "wb") for p in paths]
        try:
            for part in (table.values(), more):
                for record in part:
                    nibble = record[0][level // 2 + 2] >> (4 * (level % 2)) & 15
                    pickle.dump(record, files[nibble], protocol=5)
        finally:
            for f in files:
                f.close()
        table.clear()
        for path in paths:
            yield from grace(_spilled(path), memory, level + 1)


def _spilled(path: str) -> Iterator[Record]:
    with open(path, "rb") as f:
        while True:
            try:
                yield pickle.load(f)
            except EOFError:
                return


def _reduce(memory: int):
    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[Record]:
        for batch in batches:
            columns = [batch.column(c) for c in ("sha", "content", "points", "doc_id", "row_id", "members", "local_id")]
            for values in zip(*columns):
                sha, content, points, doc_id, row, members, local = (v.as_py() for v in values)
                yield sha, content, (-points, _NO_ID if doc_id is None else doc_id, row), members, (local,)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def packed() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["local_id", "keep_id", "keep_row", "group_size"]
            )

        for _, _, (_, doc_id, row), members, locals_ in grace(records(batches), memory):
            keep = None if doc_id == _NO_ID else doc_id
            out.extend((local, keep, row, members) for local in locals_)
            if len(out) >= 50_000:
                yield packed()
                out.clear()
        if out:
            yield packed()

    return run


def exact_groups(docs: DataFrame, memory: int = MEMORY) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    spark = docs.sparkSession
    bounded_batches(spark)
    scanned = stage(documents_view(docs).mapInArrow(_scan(memory), _SCANNED), "exact-scan")
    groups = (
        scanned.where("kind = 1")
        .drop("kind")
        .repartition(F.xxhash64("sha"))
        .mapInArrow(_reduce(memory), "local_id long, keep_id long, keep_row long, group_size long")
    )
    rows = scanned.where("kind = 0").select("row_id", "doc_id", "local_id", "sha")
    return rows.join(groups, "local_id").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row_id") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, memory: int = MEMORY) -> DataFrame:
    """``docs`` without the rows that :func:`exact_groups` does not keep.

    A row is told by doc_id and content; rows without doc_id stay. Of rows that
    repeat both, one stays.
    """
    groups = exact_groups(docs, memory).where("doc_id is not null")
    per_row = groups.groupBy("doc_id", "text_sha256").agg(
        F.max(F.col("kept").cast("int")).alias("_kept"), F.count("*").alias("_n")
    )
    verdict = stage(per_row.where("_kept = 0 or _n > 1"), "exact-verdict").withColumnsRenamed(
        {"doc_id": "_id", "text_sha256": "_sha"}
    )
    sha = F.sha2(F.regexp_replace(F.coalesce("text", F.lit("")), WHITE_CLASS, "").cast("binary"), 256)
    dropped, repeated = verdict.where("_kept = 0"), verdict.where("_kept = 1")
    columns = docs.columns

    def marked(of: DataFrame, how: str) -> DataFrame:
        # not an equality of hashes: only rows with a listed id have their content hashed again
        return docs.join(of, (docs["doc_id"] == of["_id"]) & (F.instr(sha, of["_sha"]) == 1), how)

    once = marked(repeated, "left_semi").withColumn("_sha", sha).dropDuplicates(["doc_id", "_sha"]).select(*columns)
    rest = marked(dropped.unionByName(repeated), "left_anti")
    return rest.unionByName(once)
