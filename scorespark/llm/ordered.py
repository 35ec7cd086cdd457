"""Places and running sums within groups, for groups of any size.

Rows are range-partitioned by (group, order) - the only shuffle of the rows -, numbered
inside their partition and written with its number. What a partition takes over from
those before it concerns only its first group, so the table of these carries has a
row per partition at most, whatever the number of groups; that table alone is collected
and broadcast. A group with most of the rows is spread over many partitions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorespark.session import stage

#: Lanes of a running digest: each 64 bits, added up modulo 2**64.
LANES = 4
DIGEST = 8 * LANES


def as_lanes(column: pa.Array) -> np.ndarray:
    """Binary values of :data:`DIGEST` bytes as rows of unsigned integers."""
    fixed = column.cast(pa.binary(DIGEST))
    data = fixed.buffers()[1]
    start = fixed.offset * DIGEST
    raw = np.frombuffer(data, dtype=np.uint8, count=len(fixed) * DIGEST, offset=start) if len(fixed) else np.zeros(0, np.uint8)
    return raw.view(">u8").reshape(-1, LANES).astype(np.uint64)


def from_lanes(lanes: np.ndarray) -> pa.Array:
    raw = np.ascontiguousarray(lanes.astype(">u8"))
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(DIGEST), len(raw), [None, pa.py_buffer(raw.tobytes())]).cast(pa.binary())


def _numbered(group: str, digest: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        last, row, inside, lead = None, 0, 0, True
        carried = np.zeros(LANES, dtype=np.uint64)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = batch.column(group)
            fresh = np.zeros(n, dtype=bool)
            fresh[1:] = np.asarray(pc.not_equal(keys.slice(1), keys.slice(0, n - 1)))
            fresh[0] = last is not None and keys[0] != last
            at = np.maximum.accumulate(np.where(fresh, np.arange(n), -1))  # first row of the row's group; -1: before the batch
            place = np.where(at >= 0, np.arange(n) - at, np.arange(n) + inside)
            leads = lead & (at < 0)
            columns = [pa.array(place), pa.array(np.arange(row, row + n)), pa.array(leads)]
            if digest:
                values = as_lanes(batch.column(digest))
                total = np.cumsum(values, axis=0, dtype=np.uint64)
                before = np.where((at >= 0)[:, None], (total - values)[np.maximum(at, 0)], np.uint64(0) - carried)
                sums = total - before
                carried = sums[-1]
                columns.append(from_lanes(sums))
            last, row, inside, lead = keys[n - 1], row + n, int(place[-1]) + 1, bool(leads[-1])
            names = ["_place", "_row", "_lead"] + ["_sum"] * bool(digest) + ["_slice"]
            columns.append(pa.array(np.full(n, number, dtype=np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *names])

    return run


def _carry(placed: DataFrame, group: str, digest: str | None) -> dict[int, tuple[int, bytes]]:
    """By partition: rows and sum that its first group has in the partitions before."""
    end = [F.col(group).alias("g"), F.col("_place").alias("p"), F.col("_lead").alias("l")] + [F.col("_sum").alias("s")] * bool(digest)
    slices = placed.groupBy("_slice").agg(
        F.min_by(group, "_row").alias("first"), F.max_by(F.struct(*end), "_row").alias("last")
    )
    out: dict[int, tuple[int, bytes]] = {}
    open_group, rows, total = None, 0, np.zeros(LANES, dtype=np.uint64)
    for s in sorted(slices.collect(), key=lambda r: r["_slice"]):
        goes_on = open_group is not None and s["first"] == open_group[0]
        if not goes_on:
            rows, total = 0, np.zeros(LANES, dtype=np.uint64)
        elif rows:
            out[s["_slice"]] = rows, total.astype(">u8").tobytes()
        end = s["last"]
        if not end["l"]:
            rows, total = 0, np.zeros(LANES, dtype=np.uint64)
        rows += end["p"] + 1
        if digest:
            total = total + np.frombuffer(bytes(end["s"]), dtype=">u8").astype(np.uint64)
        open_group = (end["g"],)
    return out


def _finished(shared, names: Sequence[str], digest: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carries = shared.value
        for batch in batches:
            slices, leads = np.asarray(batch.column("_slice")), np.asarray(batch.column("_lead"))
            place = np.array(batch.column("_place"))
            sums = as_lanes(batch.column("_sum")) if digest else None
            for number in np.unique(slices[leads]):
                if number in carries:
                    rows, total = carries[number]
                    own = leads & (slices == number)
                    place[own] += rows
                    if digest:
                        sums[own] += np.frombuffer(total, dtype=">u8").astype(np.uint64)
            columns = [batch.column(c) for c in names] + [pa.array(place)] 
            if digest:
                columns += [from_lanes(sums), from_lanes(sums - as_lanes(batch.column(digest)))]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "place"] + ["sum", "before"] * bool(digest))

    return run


def placed_rows(rows: DataFrame, group: str, order: Sequence[str], label: str, digest: str | None = None) -> DataFrame:
    """``rows`` with ``place``, the number of rows before them in their group (no nulls there).

    With ``digest``, a column of :data:`DIGEST` bytes, also ``sum`` and ``before``: the digests of the
    group up to the row, with it and without, lane by lane modulo 2**64. Rows equal in all of ``order`` are numbered
    in any order. Columns of ``rows`` must not begin with an underscore.
    """
    spark = rows.sparkSession
    kept = rows.columns
    added = [T.StructField("_place", T.LongType()), T.StructField("_row", T.LongType()), T.StructField("_lead", T.BooleanType())]
    added += [T.StructField("_sum", T.BinaryType())] * bool(digest) + [T.StructField("_slice", T.IntegerType())]
    sorted_rows = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    placed = stage(sorted_rows.mapInArrow(_numbered(group, digest), T.StructType([*rows.schema.fields, *added])), label)
    carries = spark.sparkContext.broadcast(_carry(placed, group, digest))
    sums = [T.StructField(c, T.BinaryType()) for c in ("sum", "before")] if digest else []
    schema = T.StructType([*rows.schema.fields, T.StructField("place", T.LongType()), *sums])
    return placed.mapInArrow(_finished(carries, kept, digest), schema)
