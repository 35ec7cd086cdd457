"""Exact stratified splits and folds as per-row comparisons with a cut-off hash.

Rows of a class are ordered by ``md5(key:seed)``. Fitting finds, per class, the
hash at each cut of that order from counts of hash prefixes; applying compares a
row's hash with those literals. Assigning a split therefore needs no shuffle,
does not depend on partitioning, works on streams, and keeps rows of one key
together.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorespark.functions.hashing import order_key
from scorespark.spec import DEFAULT_SPEC, RANDOM_STATE, FeatureSpec

PREFIX_STEP = 3
HASH_LENGTH = 32
BUCKET_LIMIT = 100_000

ClassSizes = Mapping[object, int]
CutRanks = Mapping[object, list[int]]


@dataclass(frozen=True)
class StratifiedCuts:
    """Fitted split: per class, the last hash of every part but the final one."""

    key: str
    label: str
    seed: int
    names: tuple
    cuts: tuple[tuple[object, tuple[str, ...]], ...]

    def apply(self, df: DataFrame, column: str = "split") -> DataFrame:
        row_hash = order_key(self.key, self.seed)
        whole = None
        for klass, cutoffs in self.cuts:
            part = None
            for name, cutoff in zip(self.names, cutoffs):
                test = row_hash <= F.lit(cutoff)
                part = F.when(test, F.lit(name)) if part is None else part.when(test, F.lit(name))
            part = part.otherwise(F.lit(self.names[-1]))
            same = F.col(self.label) == F.lit(klass)
            whole = F.when(same, part) if whole is None else whole.when(same, part)
        return df.withColumn(column, whole)


def largest_remainder(sizes: ClassSizes, draws: int) -> dict:
    """Share ``draws`` among the classes in proportion; ties go to the lower class."""
    total = sum(sizes.values())
    exact = {c: n * draws / total for c, n in sizes.items()}
    quota = {c: math.floor(x) for c, x in exact.items()}
    by_rest = sorted(exact, key=lambda c: (-(exact[c] - quota[c]), c))
    for c in by_rest[: draws - sum(quota.values())]:
        quota[c] += 1
    return quota


def holdout_quota(sizes: ClassSizes, fraction: float) -> dict:
    """Rows per class that leave the training part when ``fraction`` is held out."""
    total = sum(sizes.values())
    kept = largest_remainder(sizes, total - math.ceil(fraction * total))
    return {c: n - kept[c] for c, n in sizes.items()}


def two_way(test_size: float = 0.3) -> tuple[tuple[str, ...], Callable[[ClassSizes], CutRanks]]:
    """test / train."""

    def ranks(sizes):
        test = holdout_quota(sizes, test_size)
        return {c: [test[c]] for c in sizes}

    return ("test", "train"), ranks


def holdout_then_test(holdout: float = 0.3, test_share: float = 0.67):
    """Hold out ``holdout`` of the rows, then give ``test_share`` of those to test."""

    def ranks(sizes):
        held = holdout_quota(sizes, holdout)
        test = holdout_quota(held, test_share)
        return {c: [test[c], held[c]] for c in sizes}

    return ("test", "val", "train"), ranks


def shares_of_all(test_size: float = 0.2, val_size: float = 0.1):
    """Test and validation sizes are shares of the full table."""

    def ranks(sizes):
        test = holdout_quota(sizes, test_size)
        rest = {c: sizes[c] - test[c] for c in sizes}
        val = holdout_quota(rest, val_size / (1 - test_size))
        return {c: [test[c], test[c] + val[c]] for c in sizes}

    return ("test", "val", "train"), ranks


def equal_folds(folds: int = 3):
    """Folds that differ by at most one row per class."""

    def ranks(sizes):
        return {
            c: [sum(n // folds + (j < n % folds) for j in range(i + 1)) for i in range(folds - 1)]
            for c, n in sizes.items()
        }

    return tuple(range(folds)), ranks


def fit_cuts(
    df: DataFrame,
    scheme: tuple[tuple, Callable[[ClassSizes], CutRanks]],
    spec: FeatureSpec = DEFAULT_SPEC,
    seed: int = RANDOM_STATE,
    limit: int = BUCKET_LIMIT,
    unlabelled: str = "raise",
) -> StratifiedCuts:
    """Find the cut-off hashes of ``scheme`` on ``df`` (key and label are scanned).

    Rows without a label belong to no class and so to no part: they are an error,
    unless ``unlabelled="leave"`` asks for the part NULL.
    """
    names, ranks_of = scheme
    if unlabelled not in ("raise", "leave"):
        raise ValueError(f"unknown treatment of unlabelled rows '{unlabelled}'")
    if unlabelled == "raise":
        missing = df.where(F.col(spec.target).isNull()).count()
        if missing:
            raise ValueError(f"{missing} rows have no label '{spec.target}'; drop them or pass unlabelled='leave'")
    hashed = df.where(F.col(spec.target).isNotNull()).select(
        F.col(spec.target).alias("klass"), order_key(spec.key, seed).alias("h")
    )
    counts = _prefix_counts(hashed, PREFIX_STEP)
    sizes: dict = {}
    for klass, per_prefix in counts.items():
        sizes[klass] = sum(per_prefix.values())
    wanted = {
        (klass, i): rank for klass, ranks in ranks_of(sizes).items() for i, rank in enumerate(ranks)
    }

    cutoffs: dict = {w: "" for w, rank in wanted.items() if rank == 0}
    open_cuts = {w: ("", rank) for w, rank in wanted.items() if rank > 0}
    length = PREFIX_STEP
    while True:
        buckets = {}
        for w, (prefix, rank) in open_cuts.items():
            for p in sorted(k for k in counts[w[0]] if k.startswith(prefix)):
                if rank <= counts[w[0]][p]:
                    buckets[w] = (p, rank)
                    break
                rank -= counts[w[0]][p]
        cutoffs.update({w: p for w, (p, _) in buckets.items() if len(p) == HASH_LENGTH})
        open_cuts = {w: v for w, v in buckets.items() if w not in cutoffs}
        crowded = {(w[0], p) for w, (p, _) in open_cuts.items() if counts[w[0]][p] > limit}
        if not crowded:
            break
        length = min(length + PREFIX_STEP, HASH_LENGTH)
        within = hashed.where(_in_buckets({(w[0], p) for w, (p, _) in open_cuts.items()}))
        counts = _prefix_counts(within, length)
    cutoffs.update(_ranked_hashes(hashed, open_cuts))
    cut_count = len(names) - 1
    return StratifiedCuts(
        spec.key,
        spec.target,
        seed,
        names,
        tuple((k, tuple(cutoffs[(k, i)] for i in range(cut_count))) for k in sorted(sizes)),
    )


def _prefix_counts(hashed: DataFrame, length: int) -> dict:
    """Rows per class and hash prefix; at most 16**3 rows per class or open bucket."""
    rows = hashed.groupBy("klass", F.substring("h", 1, length).alias("prefix")).count().collect()
    counts: dict = {}
    for r in rows:
        counts.setdefault(r["klass"], {})[r["prefix"]] = r["count"]
    return counts


def _in_buckets(buckets):
    condition = F.lit(False)
    for klass, prefix in sorted(buckets):
        condition = condition | ((F.col("klass") == klass) & F.col("h").startswith(prefix))
    return condition


def _ranked_hashes(hashed: DataFrame, cuts: Mapping) -> dict:
    """The hash of the given rank in each bucket (every bucket is within the limit)."""
    if not cuts:
        return {}
    bucket = None
    for klass, prefix in sorted({(w[0], p) for w, (p, _) in cuts.items()}):
        test = (F.col("klass") == klass) & F.col("h").startswith(prefix)
        bucket = F.when(test, prefix) if bucket is None else bucket.when(test, prefix)
    place = F.row_number().over(Window.partitionBy("klass", "prefix").orderBy("h"))
    picks = F.lit(False)
    for w, (prefix, rank) in cuts.items():
        picks = picks | (
            (F.col("klass") == w[0]) & (F.col("prefix") == prefix) & (F.col("place") == rank)
        )
    rows = (
        hashed.where(_in_buckets({(w[0], p) for w, (p, _) in cuts.items()}))
        .withColumn("prefix", bucket)
        .withColumn("place", place)
        .where(picks)
        .collect()
    )
    by_place = {(r["klass"], r["prefix"], r["place"]): r["h"] for r in rows}
    return {w: by_place[(w[0], prefix, rank)] for w, (prefix, rank) in cuts.items()}


def split_data(
    df: DataFrame,
    test_size: float = 0.2,
    val_size: float = 0.1,
    spec: FeatureSpec = DEFAULT_SPEC,
    random_state: int = RANDOM_STATE,
) -> DataFrame:
    """Add ``split``: an exact stratified 70/10/20 assignment by default."""
    return fit_cuts(df, shares_of_all(test_size, val_size), spec, random_state).apply(df)


def split_balance(df: DataFrame, spec: FeatureSpec = DEFAULT_SPEC, tolerance: float = 0.01) -> DataFrame:
    """Rows and bad rate per split, and whether the rate is within ``tolerance`` of the whole."""
    per_split = df.groupBy("split").agg(
        F.count("*").alias("n"), F.sum(spec.target).cast("bigint").alias("bads")
    )
    everything = Window.partitionBy()
    overall = F.sum("bads").over(everything) / F.sum("n").over(everything)
    rate = F.col("bads") / F.col("n")
    return per_split.select(
        "split",
        "n",
        rate.alias("bad_rate"),
        overall.alias("overall_rate"),
        (F.abs(rate - overall) <= tolerance).alias("within_tolerance"),
    )


def split_overlap(assigned: DataFrame, source: DataFrame, spec: FeatureSpec = DEFAULT_SPEC) -> DataFrame:
    """Keys in more than one split, keys without a split and keys that are not in the source.

    All three numbers are 0 for a sound split.
    """
    per_key = (
        assigned.select(spec.key, "split", F.lit(1).alias("placed"))
        .unionByName(
            source.select(spec.key, F.lit(None).cast("string").alias("split"), F.lit(0).alias("placed"))
        )
        .groupBy(spec.key)
        .agg(
            F.min("split").alias("first_split"),
            F.max("split").alias("last_split"),
            F.max(1 - F.col("placed")).alias("in_source"),
        )
    )
    return per_key.agg(
        F.count_if(F.col("first_split") != F.col("last_split")).alias("in_two_splits"),
        F.count_if(F.col("first_split").isNull()).alias("in_no_split"),
        F.count_if(F.col("in_source") == 0).alias("not_in_source"),
    )
