"""As-of join: each row on the left with the first row on the right at or after its time.

Both sides are put on one time line that is range-partitioned by (key, time), the only
shuffle of the rows. Inside a partition, latest first, the last right row passed is the
next one in time. What a partition takes over from those before it concerns only its
first key, so one row per partition is carried on; a key with a third of all rows is
spread over many tasks, and rows are never multiplied.
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

from scorespark.session import stage, values_table


def _passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the last right row of the same key that came earlier in the partition."""
    number = TaskContext.get().partitionId()
    last = carried = None  # key of the row before; right row of that key, one value
    row, lead, seen = 0, True, False  # seen: the partition's first key has had a right row
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        keys, right = batch.column("_key"), batch.column("_right")
        fresh = np.zeros(n, dtype=bool)
        fresh[1:] = np.asarray(pc.not_equal(keys.slice(1), keys.slice(0, n - 1)))
        fresh[0] = last is not None and keys[0] != last
        start = np.maximum.accumulate(np.where(fresh, np.arange(n), -1))  # first row of the row's key; -1: before the batch
        is_right = np.asarray(pc.equal(batch.column("_later"), 1))
        at = np.maximum.accumulate(np.where(is_right, np.arange(n), -1))
        before = pa.array([None], right.type) if carried is None else carried
        # place 0 is what the batches before leave, place 1 + k row k of this one
        source = np.where(at >= np.maximum(start, 0), at + 1, np.where(start < 0, 0, -1))
        pool = pa.concat_arrays([before, right])
        found = pool.take(pa.array(np.maximum(source, 0), mask=source < 0))
        leads = lead & (start < 0)
        has = seen | (at >= 0)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, found, pa.array(leads & ~has), pa.array(np.arange(row, row + n)), pa.array(np.full(n, number, dtype=np.int32))],
            names=[*batch.schema.names, "_found", "_open", "_row", "_slice"],
        )
        last, carried, row, lead = keys[n - 1], found.slice(n - 1, 1), row + n, bool(leads[-1])
        seen = bool(has[-1])


def asof_next(
    left: DataFrame, right: DataFrame, key: str, left_at: str, right_at: str, values: Sequence[str], slices: int | None = None
) -> DataFrame:
    """``left`` with a struct ``_found`` of ``right_at`` and ``values`` of the first right row of the key at or after ``left_at``.

    NULL where there is none, and for rows without key or time. Of right rows of one time the
    one with the largest values (in their order) counts. Both times must be of one type.
    """
    columns = left.columns
    known = left.where(F.col(key).isNotNull() & F.col(left_at).isNotNull())
    asked = known.select(F.col(key).alias("_key"), F.col(left_at).alias("_at"), F.lit(0).alias("_later"), F.struct(*columns).alias("_left"))
    ranked = right.where(F.col(key).isNotNull() & F.col(right_at).isNotNull()).groupBy(F.col(key).alias("_key"), F.col(right_at).alias("_at"))
    events = ranked.agg(F.max(F.struct(F.col(right_at), *values)).alias("_right")).withColumn("_later", F.lit(1))
    line = asked.unionByName(events, allowMissingColumns=True)
    # latest first; of one time, right rows first, so that a left row has passed them
    order = [F.col("_key"), F.col("_at").desc(), F.col("_later").desc()]
    dealt = line.repartitionByRange(*([slices] if slices else []), *order).sortWithinPartitions(*order)
    added = [
        T.StructField("_found", line.schema["_right"].dataType),
        T.StructField("_open", T.BooleanType()),
        T.StructField("_row", T.LongType()),
        T.StructField("_slice", T.IntegerType()),
    ]
    passed = stage(dealt.mapInArrow(_passed, T.StructType([*line.schema.fields, *added])), "asof")
    carry = _carried(passed)
    out = passed.where("_later = 0")
    if carry:
        kind = T.StructType([T.StructField("_from", T.IntegerType()), T.StructField("_taken", line.schema["_right"].dataType)])
        taken = F.broadcast(values_table(left.sparkSession, carry, kind))
        out = out.join(taken, out["_open"] & (out["_slice"] == taken["_from"]), "left")
        out = out.withColumn("_found", F.coalesce("_found", "_taken"))
    unknown = left.where(F.col(key).isNull() | F.col(left_at).isNull()).withColumn("_found", F.lit(None).cast(line.schema["_right"].dataType))
    return out.select(*[F.col("_left").getField(c).alias(c) for c in columns], "_found").unionByName(unknown)


def _carried(passed: DataFrame) -> list[tuple]:
    """(partition, right row that its first key takes over): at most a row per partition is collected."""
    ends = passed.groupBy("_slice").agg(
        F.min_by("_key", "_row").alias("first"),
        F.max_by(F.struct("_key", F.coalesce("_right", "_found").alias("found"), "_open"), "_row").alias("last"),
    )
    out, key, found = [], None, None
    for s in sorted(ends.collect(), key=lambda r: r["_slice"]):
        goes_on = key is not None and key == s["first"]
        if goes_on and found is not None:
            out.append((s["_slice"], found.asDict()))
        end = s["last"]
        if end["found"] is not None:
            found = end["found"]
        elif not (end["_open"] and goes_on):
            found = None
        key = end["_key"]
    return out
