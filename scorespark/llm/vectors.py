"""Exact top-k search by inner product over a vector-approximation file.

Components x become the integers floor(256 * x). Every vector is kept twice: exact, and as
an approximation, the number of the cell of each component (``CELLS`` cells per
dimension, their borders at quantiles of all vectors). Vectors lie in groups of ``GROUP``
rows, queries in groups of ``QUERIES``; a task takes a group of each.

1. The cells are scanned. The lowest and highest value of a query's product with
   anything in a vector's cells bound its score. The k best lower bounds of all
   groups give each query a score that its kth result certainly reaches.
2. The cells are scanned again. Vectors whose upper bound reaches that score are read
   exactly, in the order of upper bounds, until the next bound is below the kth result found
   in the group. A group hands on k results a query at most; the best k of all
   groups are the answer.

Work grows with queries times vectors, spread over group pairs; no pair of vectors
is ever written. Copies of one vector, however many, only tie inside their groups.

Vectors that are null, or hold null or non-finite components, and rows without vec_id
take no part. Shorter vectors count as filled up with zeros. A query's own row, and rows
that repeat its vec_id, are no candidates for it; repeated rows are rows of their own.
Scores beyond 64 bits are given as the nearest value that fits. Vectors with components beyond
``WIDE`` have no cells and are read exactly for every query, in whole numbers of any size.
An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorespark.llm.text import bounded_batches
from scorespark.session import stage

SCALE = 256
CELLS = 16
GROUP = 2048
QUERIES = 2048
#: Bits of a query's place in its group.
PLACE_BITS = 11
#: Largest component of vectors with cells: products of two, summed over 2**13 dimensions, are exact in doubles.
WIDE = 1 << 20
#: Pairs read exactly at a time, and queries bounded at a time.
PAIRS_AT_A_TIME = 1 << 14
ROWS_AT_A_TIME = 128
#: Groups of vectors, and of queries, that a join key takes at most.
GROUPS_PER_LANE, QUERY_GROUPS_PER_LANE = 64, 16
#: Query groups for which a task holds results at a time.
HELD = 64
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
_PACKED = "grp long, wide boolean, ids binary, vectors binary, cells binary"
_FOUND = "qno long, query_id long, vec_id long, score long"


@dataclass(frozen=True)
class Cells:
    """Per dimension (rows): borders between cells, and the lowest and highest whole value in each cell."""

    borders: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def of(self, vectors: np.ndarray) -> np.ndarray:
        out = np.empty(vectors.shape, dtype=np.uint8)
        for d in range(vectors.shape[1]):
            out[:, d] = np.searchsorted(self.borders[d], vectors[:, d], side="right")
        return out

    def edges(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        each = np.arange(cells.shape[1])
        return self.low[each, cells], self.high[each, cells]


def quantised(vectors: DataFrame) -> DataFrame:
    """(vec_id, parts, wide) of the rows that take part; parts are whole numbers as doubles."""
    bad = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    # beyond 2**44 a double times SCALE is whole anyway, and may not fit what floor() returns
    whole = F.transform("x", lambda v: F.when(F.abs(v) < 2.0**44, F.floor(v * SCALE).cast("double")).otherwise(v * SCALE))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("x").isNotNull()).where(~F.coalesce(bad, F.lit(False)))
    rows = rows.select("vec_id", whole.alias("parts"))
    return rows.withColumn("wide", F.exists("parts", lambda v: F.abs(v) > WIDE))


def fit_cells(parts: DataFrame, cells: int = CELLS) -> Cells:
    """Cells at the quantiles of each dimension over all vectors but the wide ones; a row per dimension."""
    shares = [k / cells for k in range(1, cells)]
    by_dimension = (
        parts.where("not wide")
        .select(F.posexplode("parts").alias("d", "v"))
        .groupBy("d")
        .agg(F.percentile_approx("v", shares, 1000).alias("borders"), F.min("v").alias("low"), F.max("v").alias("high"))
        .orderBy("d")
        .collect()
    )
    borders = np.array([r["borders"] for r in by_dimension], dtype=np.float64).reshape(-1, cells - 1)
    # zeros stand in where a vector is shorter than others
    low = np.array([min(r["low"], 0.0) for r in by_dimension]).reshape(-1, 1)
    high = np.array([max(r["high"], 0.0) for r in by_dimension]).reshape(-1, 1)
    return Cells(borders, np.hstack([low, np.maximum(borders, low)]), np.hstack([np.minimum(borders - 1, high), high]))


def _matrix(parts: pa.Array, width: int) -> np.ndarray:
    """Lists as rows of a matrix, zeros where they end early."""
    sizes = np.asarray(parts.value_lengths(), dtype=np.int64)
    out = np.zeros((len(parts), width))
    out[np.arange(width) < sizes[:, None]] = np.asarray(parts.flatten(), dtype=np.float64)
    return out


def _pack(fitted: Cells, rows_per_group: int):
    """Groups of vectors in the order of the scan; wide ones, as they are, in groups of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        width = len(fitted.borders)
        held: dict[bool, list] = {False: [], True: []}
        made = 0

        def group(wide: bool, rows: list) -> pa.RecordBatch:
            nonlocal made
            made += 1
            ids = np.concatenate([r[0] for r in rows])
            if wide:
                longest = max(r[1].shape[1] for r in rows)
                vectors = np.concatenate([np.pad(r[1], ((0, 0), (0, longest - r[1].shape[1]))) for r in rows])
                cells = b""
            else:
                vectors = np.concatenate([r[1] for r in rows]).astype(np.int32)
                cells = fitted.of(vectors).tobytes()
            values = [number + made, wide, ids.tobytes(), vectors.tobytes(), cells]
            kinds = [pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=[c.split()[0] for c in _PACKED.split(", ")])

        for batch in batches:
            flags = np.asarray(batch.column("wide"))
            for wide in (False, True):
                own = pa.array(flags == wide)
                ids, parts = batch.column("vec_id").filter(own), batch.column("parts").filter(own)
                if not len(ids):
                    continue
                longest = int(np.max(np.asarray(parts.value_lengths()))) if wide else width
                rows, matrix = np.asarray(ids, dtype=np.int64), _matrix(parts, longest)
                while len(rows):
                    room = rows_per_group - sum(len(r[0]) for r in held[wide])
                    held[wide].append((rows[:room], matrix[:room]))
                    if len(rows) >= room:
                        yield group(wide, held[wide])
                        held[wide] = []
                    rows, matrix = rows[room:], matrix[room:]
        for wide, rows in held.items():
            if rows:
                yield group(wide, rows)

    return run


def _unpacked(ids: bytes, vectors: bytes, wide: bool) -> tuple[np.ndarray, np.ndarray]:
    numbers = np.frombuffer(ids, dtype=np.int64)
    values = np.frombuffer(vectors, dtype=np.float64 if wide else np.int32)
    return numbers, values.reshape(len(numbers), -1) if len(values) else np.zeros((len(numbers), 0), values.dtype)


def bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray, lower: bool) -> np.ndarray:
    """The lowest (or highest) product of each query with anything between ``low`` and ``high``."""
    up, down = np.maximum(queries, 0.0), np.minimum(queries, 0.0)
    return up @ low.T + down @ high.T if lower else up @ high.T + down @ low.T


def _scan_low(fitted: Cells, k: int):
    """(qno, low): the k best lower bounds of each query in the groups of a task."""

    def out(held: dict) -> Iterator[pa.RecordBatch]:
        for grp, best in held.items():
            qno = np.repeat(_numbers(grp, len(best)), k)
            values = best.ravel()
            real = values > -np.inf
            yield pa.RecordBatch.from_arrays([pa.array(qno[real]), pa.array(values[real])], names=["qno", "low"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                qids, queries = _unpacked(row["qids"], row["qvectors"], False)
                ids = np.frombuffer(row["ids"], dtype=np.int64)
                cells = np.frombuffer(row["cells"], dtype=np.uint8).reshape(len(ids), -1)
                low, high = fitted.edges(cells)
                if row["qgrp"] not in held and len(held) >= HELD:
                    yield from out(held)
                    held.clear()
                best = held.setdefault(row["qgrp"], np.full((len(qids), k), -np.inf))
                for at in range(0, len(qids), ROWS_AT_A_TIME):
                    some = slice(at, at + ROWS_AT_A_TIME)
                    found = bounds(queries[some].astype(np.float64), low, high, True)
                    found[qids[some, None] == ids] = -np.inf
                    both = np.hstack([best[some], found])
                    best[some] = np.partition(both, both.shape[1] - k, axis=1)[:, both.shape[1] - k :]
        yield from out(held)

    return run


def _numbers(grp: int, n: int) -> np.ndarray:
    """A number for each query: its group's, then its place."""
    return (grp << PLACE_BITS) + np.arange(n, dtype=np.int64)


class Best:
    """The k best candidates so far of each query of a group, by score, then vec_id."""

    def __init__(self, queries: int, k: int):
        self.scores = np.full((queries, k), _LEAST, dtype=np.int64)
        self.ids = np.full((queries, k), _MOST, dtype=np.int64)
        self.counts = np.zeros(queries, dtype=np.int64)

    def kth(self) -> tuple[np.ndarray, np.ndarray]:
        """Score and vec_id of the kth; below everything while there are fewer."""
        full = self.counts >= self.scores.shape[1]
        return np.where(full, self.scores[:, -1], -np.inf), np.where(full, self.ids[:, -1], _MOST)

    def add(self, who: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        k = self.scores.shape[1]
        touched = np.unique(who)
        old = np.repeat(touched, np.minimum(self.counts[touched], k))
        place = np.arange(len(old)) - np.searchsorted(old, old)
        who = np.concatenate([old, who])
        scores = np.concatenate([self.scores[old, place], scores])
        ids = np.concatenate([self.ids[old, place], ids])
        order = np.lexsort((ids, ~scores, who))
        who, scores, ids = who[order], scores[order], ids[order]
        place = np.arange(len(who)) - np.searchsorted(who, who)
        kept = place < k
        self.scores[who[kept], place[kept]], self.ids[who[kept], place[kept]] = scores[kept], ids[kept]
        self.counts[touched] = np.minimum(np.bincount(np.searchsorted(touched, who), minlength=len(touched)), k)


def read_exactly(best: Best, first: int, queries: np.ndarray, upper: np.ndarray, reach: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
    """Score the vectors that may be among the k best, highest upper bound first, until the rest cannot be.

    ``upper`` holds the bounds of queries ``first`` and on (rows) with the vectors; only bounds of ``reach`` or above count.
    """
    who, what = np.nonzero(upper >= reach[:, None])
    bound = upper[who, what]
    order = np.lexsort((ids[what], -bound, who))
    who, what, bound = who[order], what[order], bound[order]
    step = 2 * best.scores.shape[1]
    while len(who):
        place = np.arange(len(who)) - np.searchsorted(who, who)
        now = np.flatnonzero(place < step)
        for at in range(0, len(now), PAIRS_AT_A_TIME):
            some = now[at : at + PAIRS_AT_A_TIME]
            products = np.einsum("ij,ij->i", queries[who[some]], vectors[what[some]].astype(np.float64))
            best.add(first + who[some], products.astype(np.int64), ids[what[some]])
        score, number = best.kth()
        kth, tie = score[first + who], number[first + who]
        open_ = (place >= step) & ((bound > kth) | ((bound == kth) & (ids[what] < tie)))
        who, what, bound = who[open_], what[open_], bound[open_]
        step *= 2


def _read_all(best: Best, qids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
    """Score every pair in whole numbers of any size, for wide vectors or queries."""
    width = min(queries.shape[1], vectors.shape[1])
    wholes = [[int(v) for v in row[:width]] for row in vectors]
    for q, query in enumerate(queries):
        mine = [int(v) for v in query[:width]]
        scored = (
            (-min(max(sum(a * b for a, b in zip(mine, own)), _LEAST), _MOST), int(i)) for own, i in zip(wholes, ids) if i != qids[q]
        )
        top = heapq.nsmallest(best.scores.shape[1], scored)
        if top:
            best.add(np.full(len(top), q), np.array([-s for s, _ in top], dtype=np.int64), np.array([i for _, i in top], dtype=np.int64))


def _scan_high(fitted: Cells, k: int):
    """(qno, query_id, vec_id, score): the k best candidates of each query in the groups of a task."""

    def out(held: dict) -> Iterator[pa.RecordBatch]:
        for grp, (qids, best) in held.items():
            real = np.arange(k) < best.counts[:, None]
            who = np.nonzero(real)[0]
            columns = [_numbers(grp, len(qids))[who], qids[who], best.ids[real], best.scores[real]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[c.split()[0] for c in _FOUND.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, Best]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                qids, queries = _unpacked(row["qids"], row["qvectors"], row["qwide"])
                ids, vectors = _unpacked(row["ids"], row["vectors"], row["wide"])
                if row["qgrp"] not in held and len(held) >= HELD:
                    yield from out(held)
                    held.clear()
                _, best = held.setdefault(row["qgrp"], (qids, Best(len(qids), k)))
                if row["wide"] or row["qwide"]:
                    _read_all(best, qids, queries, ids, vectors)
                    continue
                reach = np.full(len(qids), -np.inf)
                for certain in row["certain"] or ():
                    reach[certain["qno"] & (1 << PLACE_BITS) - 1] = certain["low"]
                low, high = fitted.edges(np.frombuffer(row["cells"], dtype=np.uint8).reshape(len(ids), -1))
                for at in range(0, len(qids), ROWS_AT_A_TIME):
                    some = slice(at, at + ROWS_AT_A_TIME)
                    own = queries[some].astype(np.float64)
                    upper = bounds(own, low, high, False)
                    upper[qids[some, None] == ids] = np.nan  # its own row
                    read_exactly(best, at, own, upper, np.maximum(reach[some], best.kth()[0][some]), ids, vectors)
        yield from out(held)

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int, cells: int = CELLS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of ``vectors`` for each row of ``queries``."""
    spark = vectors.sparkSession
    bounded_batches(spark, rows=4096)
    every, asked = quantised(vectors), quantised(queries)
    fitted = fit_cells(every.unionByName(asked), cells)
    groups = stage(every.mapInArrow(_pack(fitted, GROUP), _PACKED), "va-file")
    renamed = {c.split()[0]: "q" + c.split()[0] for c in _PACKED.split(", ")}
    query_groups = stage(asked.mapInArrow(_pack(fitted, QUERIES), _PACKED).drop("cells").withColumnsRenamed(renamed), "va-queries")
    n, q = groups.count(), query_groups.count()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lanes = max(1, min(n, max(-(-n // GROUPS_PER_LANE), tasks)))
    query_lanes = -(-q // QUERY_GROUPS_PER_LANE) or 1

    def met(of: DataFrame, asking: DataFrame) -> DataFrame:
        """Every group beside every query group; groups repeat once a query lane and query groups once a lane.

        The optimiser knows the size of neither side after it is repeated, so it must not send one through the driver.
        """
        left = of.withColumns({"lane": F.pmod(F.xxhash64("grp"), F.lit(lanes)), "qlane": F.explode(F.sequence(F.lit(0), F.lit(query_lanes - 1)))})
        right = asking.withColumns({"lane": F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))), "qlane": F.pmod(F.xxhash64("qgrp"), F.lit(query_lanes))})
        return left.join(right.withColumn("lane", F.col("lane").cast("long")).hint("merge"), ["lane", "qlane"]).drop("lane", "qlane")

    lows = met(groups.where("not wide").select("grp", "ids", "cells"), query_groups.where("not qwide").select("qgrp", "qids", "qvectors"))
    lows = lows.mapInArrow(_scan_low(fitted, k), "qno long, low double")
    kth = Window.partitionBy("qno").orderBy(F.desc("low"))
    reached = lows.withColumn("n", F.row_number().over(kth)).where(F.col("n") <= k).groupBy("qno").agg(F.min("low").alias("low"), F.count("*").alias("n"))
    certain = reached.where(F.col("n") == k).groupBy(F.shiftright("qno", PLACE_BITS).alias("qgrp")).agg(F.collect_list(F.struct("qno", "low")).alias("certain"))
    found = met(groups, query_groups.join(stage(certain, "va-certain"), "qgrp", "left"))
    found = found.mapInArrow(_scan_high(fitted, k), _FOUND)
    order = Window.partitionBy("qno").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
