"""Exact linear-interpolation quantiles without a per-column value map in one task.

Spark's ``percentile`` keeps every distinct value of a group in one reducer.
Here doubles become whole numbers of the same order, and each pass counts the rows in
cells of the stretches where wanted order statistics lie, with the least and the greatest
value of each cell. A cell with one value answers its ranks; any other one that holds a
wanted rank is the next pass's stretch, between its least and greatest value. Every pass
reads all rows of the columns that are still open, so the result is exact for any data;
a stretch shrinks by the number of its cells each time, and what reaches the driver is
bounded by about ``limit`` cells a pass.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorespark.operators.running import running_totals

LIMIT = 100_000
_CELLS = "c int, s int, cell long, n long, low long, high long"


def exact_quantiles(
    df: DataFrame,
    probabilities: Mapping[str, Sequence[float]],
    accuracy: int | None = None,
    limit: float = LIMIT,
    few_values: int | None = None,
) -> dict[str, list[float | None]]:
    """Quantiles of several columns at once, NULLs ignored; an empty column gives None.

    ``df`` is scanned a few times, from the second time on only the columns that are
    still open, so stage it first if it is costly. ``accuracy`` and ``few_values`` belonged to
    an earlier search by sketches; they are still taken and change nothing.
    """
    columns = [c for c in probabilities if probabilities[c]]
    df = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    wanted: dict[str, dict[float, tuple[int, int, float]]] = {}
    values: dict[tuple[str, int], float] = {}
    stretches = {c: [(-(1 << 63), (1 << 63) - 1, 0)] for c in columns}
    ranks: dict[str, list[int]] = {}
    while stretches:
        narrower: dict[str, list] = {}
        for c, cells in _count(df, stretches, limit).items():
            if c not in wanted:
                rows = sum(n for _, n, _, _ in cells)
                wanted[c] = _wanted(probabilities[c], rows)
                ranks[c] = sorted({r for k, last, _ in wanted[c].values() for r in (k, last)})
            seen, current = 0, None
            for s, n, low, high in cells:
                if s != current:
                    seen, current = stretches[c][s][2], s
                hit = [r for r in ranks[c] if seen <= r < seen + n and (c, r) not in values]
                if hit and low == high:
                    values.update({(c, r): _value(low) for r in hit})
                elif hit:
                    narrower.setdefault(c, []).append((low, high, seen))
                seen += n
        stretches = narrower

    result: dict[str, list[float | None]] = {}
    for c in probabilities:
        result[c] = []
        for p in probabilities[c]:
            if p not in wanted.get(c, ()):
                result[c].append(None)
                continue
            k, last, share = wanted[c][p]
            low, high = values[(c, k)], values[(c, last)]
            result[c].append(low + (high - low) * share)
    return result


def _wanted(probabilities: Sequence[float], rows: int) -> dict[float, tuple[int, int, float]]:
    """Per probability the ranks next to its place, and how far it is between them."""
    found = {}
    for p in probabilities if rows else ():
        position = p * (rows - 1)
        k = math.floor(position)
        found[p] = (k, k + 1 if position > k else k, position - k)
    return found


def exact_medians(df: DataFrame, columns: Sequence[str], **options) -> dict[str, float | None]:
    found = exact_quantiles(df, {c: [0.5] for c in columns}, **options) if columns else {}
    return {c: v[0] for c, v in found.items()}


def _value(code: int) -> float:
    """The double of an ordered code."""
    bits = np.int64(code)
    return float((bits ^ ((bits >> np.int64(63)) & np.int64((1 << 63) - 1))).view(np.float64))


def _codes(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the doubles; zeros are one value, NaN is one and the greatest."""
    bits = np.where(np.isnan(values), np.nan, values + 0.0).view(np.int64)
    return bits ^ ((bits >> 63) & np.int64((1 << 63) - 1))


def _cells(plan: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
    """Counts of a task's rows by cell; ``plan`` has starts, ends and widths (as shifts) of each column's stretches.

    The cells of all stretches of a column stand in one line, so a batch adds to its cells in place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, lines = [], []
        for lows, highs, shifts in plan:
            sizes = ((highs.view(np.uint64) - lows.view(np.uint64)) >> shifts).astype(np.int64) + 1
            firsts.append(np.r_[0, np.cumsum(sizes)])
            size = firsts[-1][-1]
            lines.append((np.zeros(size, dtype=np.int64), np.full(size, np.iinfo(np.int64).max), np.full(size, np.iinfo(np.int64).min)))
        for batch in batches:
            for c, (lows, highs, shifts) in enumerate(plan):
                codes = np.sort(_codes(np.asarray(batch.column(c).drop_null(), dtype=float)))
                # sorted codes reach the stretches one after the other
                begins, ends = np.searchsorted(codes, lows, side="left"), np.searchsorted(codes, highs, side="right")
                counts, least, greatest = lines[c]
                for s in np.flatnonzero(ends > begins):
                    mine = codes[begins[s] : ends[s]]
                    cell = ((mine.view(np.uint64) - lows[s : s + 1].view(np.uint64)) >> shifts[s]).astype(np.int64) + firsts[c][s]
                    first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
                    last, at = np.r_[first[1:], len(mine)], cell[first]
                    counts[at] += last - first
                    least[at] = np.minimum(least[at], mine[first])
                    greatest[at] = np.maximum(greatest[at], mine[last - 1])
        for c, (counts, least, greatest) in enumerate(lines):
            used = np.flatnonzero(counts)
            s = np.searchsorted(firsts[c], used, side="right") - 1
            arrays = [np.full(len(used), c, dtype=np.int32), s.astype(np.int32), used - firsts[c][s], counts[used], least[used], greatest[used]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["c", "s", "cell", "n", "low", "high"])

    return run


def _count(df: DataFrame, stretches: Mapping[str, list], limit: float) -> dict[str, list[tuple[int, int, int, int]]]:
    """Per open column (stretch, rows, least, greatest) of its cells, in ascending order."""
    room = max(2, int(limit // sum(map(len, stretches.values()))))
    plan = []
    for open_ in stretches.values():
        shifts = [max(0, (high - low).bit_length() - (room.bit_length() - 1)) for low, high, _ in open_]
        lows, highs = ([s[k] for s in open_] for k in (0, 1))
        plan.append((np.array(lows, dtype=np.int64), np.array(highs, dtype=np.int64), np.array(shifts, dtype=np.uint64)))
    cells = df.select(*[F.col(c) for c in stretches]).mapInArrow(_cells(plan), _CELLS)
    added = cells.groupBy("c", "s", "cell").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    names = list(stretches)
    counted: dict[str, list] = {c: [] for c in names}
    for r in added.collect():
        counted[names[r["c"]]].append((r["s"], r["n"], r["low"], r["high"]))
    return {c: sorted(found, key=lambda t: t[2]) for c, found in counted.items()}


def grouped_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probabilities: Sequence[float], prefix: str = "p"
) -> DataFrame:
    """Exact quantiles of ``value`` per group, one column per probability.

    Works on distinct values with their counts and distributed running totals,
    so a group that holds a third of all rows is spread over many tasks.
    Columns are named ``<prefix><percent>``, e.g. ``p95``.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))
    return counted_quantiles(counts, keys, value, "n", probabilities, prefix)


def counted_quantiles(
    counts: DataFrame, keys: Sequence[str], value: str, n: str, probabilities: Sequence[float], prefix: str = "p"
) -> DataFrame:
    """:func:`grouped_quantiles` from rows ``(keys, value, n)``: each distinct value of a group and its count."""
    ranked = running_totals(counts.select(*keys, value, F.col(n).alias("n")), keys, value, ["n"])
    start = F.col("n_upto") - F.col("n")
    lows, highs, shares = {}, {}, {}
    for p in probabilities:
        name = f"{prefix}{round(p * 100)}"
        position = F.lit(float(p)) * (F.col("n_total") - 1)
        k = F.floor(position)
        last = F.least(k + 1, F.col("n_total") - 1)
        holds = lambda r: (start <= r) & (F.col("n_upto") > r)
        lows[name] = F.max(F.when(holds(k), F.col(value)))
        highs[name] = F.max(F.when(holds(last), F.col(value)))
        shares[name] = F.max(position - k)
    found = ranked.groupBy(*keys).agg(
        *[lows[m].alias(f"{m}_low") for m in lows],
        *[highs[m].alias(f"{m}_high") for m in lows],
        *[shares[m].alias(f"{m}_share") for m in lows],
    )
    return found.select(
        *keys,
        *[
            (F.col(f"{m}_low") + (F.col(f"{m}_high") - F.col(f"{m}_low")) * F.col(f"{m}_share")).alias(m)
            for m in lows
        ],
    )
