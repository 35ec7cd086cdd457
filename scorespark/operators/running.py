"""Running totals over data of any size, also inside one dominant group."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorespark.session import stage


def _changes(column: pa.Array) -> np.ndarray:
    """Where a value differs from the one before it; NULL equals NULL, NaN equals NaN."""
    here, before = column.slice(1), column.slice(0, len(column) - 1)
    differs = pc.fill_null(pc.not_equal(here, before), False)
    if pa.types.is_floating(column.type):
        differs = pc.and_(differs, pc.invert(pc.fill_null(pc.and_(pc.is_nan(here), pc.is_nan(before)), False)))
    one_null = pc.xor(pc.is_null(here), pc.is_null(before))
    return np.asarray(pc.or_(differs, one_null))


def _cumulate(keys: Sequence[str], sums: Sequence[str]):
    """Totals from the start of the group or the partition, in the order of the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        last: pa.RecordBatch | None = None
        carried = dict.fromkeys(sums, 0)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            joined = pa.Table.from_batches([last, batch]).combine_chunks() if last is not None else None
            fresh = np.zeros(n, dtype=bool)
            for k in keys:
                column = joined.column(k).chunk(0) if joined is not None else batch.column(k)
                found = _changes(column)
                if joined is None:
                    fresh[1:] |= found
                else:
                    fresh |= found
            at = np.maximum.accumulate(np.where(fresh, np.arange(n), -1))  # start of the row's group, -1: before the batch
            out = list(batch.columns)
            for s in sums:
                values = np.asarray(pc.fill_null(batch.column(s), 0))
                total = np.cumsum(values)
                offset = np.where(at >= 0, (total - values)[np.maximum(at, 0)], -carried[s])
                inside = total - offset
                carried[s] = inside[-1]
                out.append(pa.array(inside, batch.column(s).type))
            out.append(pa.array(np.full(n, number, dtype=np.int32)))
            last = batch.slice(n - 1, 1)
            yield pa.RecordBatch.from_arrays(out, names=[*batch.schema.names, *[f"_{s}_inside" for s in sums], "_slice"])

    return run


def running_totals(
    counts: DataFrame, keys: Sequence[str], order: str, sums: Sequence[str], slices: int | None = None
) -> DataFrame:
    """Add ``<s>_upto`` and ``<s>_total`` per ``keys`` in the order of ``order``.

    ``counts`` holds one row per (keys, order) - aggregate first. A plain window
    over ``keys`` would put a whole group into one task. Instead the rows are
    range-partitioned by (keys, order), which is the only shuffle of the rows, summed up
    inside their partition and written with its number. The totals of the
    partitions (a small table) give each its starting value. Because the number is
    stored with the row, a lost executor cannot shift the borders between the two
    reads. Without ``slices`` the number of partitions follows the size of the data.
    """
    placed = counts.repartitionByRange(*([slices] if slices else []), *keys, order).sortWithinPartitions(*keys, order)
    added = [T.StructField(f"_{s}_inside", counts.schema[s].dataType) for s in sums]
    schema = T.StructType([*counts.schema.fields, *added, T.StructField("_slice", T.IntegerType())])
    placed = stage(placed.mapInArrow(_cumulate(keys, sums), schema), "running")
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    starts = (
        placed.groupBy(*keys, "_slice")
        .agg(*[F.sum(s).alias(s) for s in sums])
        .select(
            *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
            F.col("_slice").alias("_from"),
            *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"_{s}_start") for s in sums],
            *[F.sum(s).over(whole).alias(f"{s}_total") for s in sums],
        )
    )
    same = placed["_slice"] == starts["_from"]
    for i, k in enumerate(keys):
        same &= placed[k].eqNullSafe(starts[f"_k{i}"])
    return placed.join(starts, same).select(
        *counts.columns,
        *[f"{s}_total" for s in sums],
        *[(F.col(f"_{s}_start") + F.col(f"_{s}_inside")).alias(f"{s}_upto") for s in sums],
    )
