"""Exact discrimination and calibration measures of a score against a 0/1 label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorespark.functions.intervals import left_closed_bin, right_closed_bin
from scorespark.operators.running import running_totals
from scorespark.session import values_table
from scorespark.spec import DEFAULT_SPEC, FeatureSpec

AUC_HIGH, AUC_LOW, AUC_SUSPICIOUS = 0.90, 0.10, 0.85
MAX_SERIES = 1000


def class_counts(
    df: DataFrame, score: str = "pd", label: str = "bad", keys: Sequence[str] = ()
) -> DataFrame:
    """Goods and bads per distinct score; equal scores collapse before any shuffle."""
    return (
        df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(*keys, score)
        .agg(
            F.sum(1 - F.col(label)).cast("bigint").alias("goods"),
            F.sum(label).cast("bigint").alias("bads"),
        )
    )


def class_curve(
    df: DataFrame, score: str = "pd", label: str = "bad", keys: Sequence[str] = ()
) -> DataFrame:
    """Cumulative class counts by ascending score, one row per distinct score."""
    return running_totals(class_counts(df, score, label, keys), keys, score, ["goods", "bads"])


def discrimination(
    df: DataFrame,
    score: str = "pd",
    label: str = "bad",
    keys: Sequence[str] = (),
    brier: bool = True,
) -> DataFrame:
    """AUC, Gini, both KS statistics and the Brier score, one row per group of ``keys``.

    ``ks`` is the two-sample statistic (absolute distance), ``ks_one_sided`` the
    maximum of tpr - fpr, which is 0 for a score that ranks the wrong way round.
    Measures that need both classes are NULL when one is absent.
    """
    goods, bads = F.col("goods"), F.col("bads")
    good_share = F.try_divide(F.col("goods_upto"), F.col("goods_total"))
    bad_share = F.try_divide(F.col("bads_upto"), F.col("bads_total"))
    pairs = F.first("goods_total").cast("double") * F.first("bads_total")
    won = F.sum(bads * (F.col("goods_upto") - goods / 2))
    measures = [
        F.sum(goods + bads).alias("n"),
        F.sum(bads).alias("n_bad"),
        F.try_divide(won, pairs).alias("auc"),
        F.max(F.abs(bad_share - good_share)).alias("ks"),
        F.max(good_share - bad_share).alias("best_gap"),
    ]
    if brier:
        p = F.col(score)
        error = goods * p * p + bads * (1 - p) * (1 - p)
        measures.append((F.sum(error) / F.sum(goods + bads)).alias("brier"))
    return class_curve(df, score, label, keys).groupBy(*keys).agg(*measures).select(
        *keys,
        "n",
        "n_bad",
        "auc",
        (2 * F.col("auc") - 1).alias("gini"),
        "ks",
        F.when(F.col("best_gap").isNotNull(), F.greatest(F.col("best_gap"), F.lit(0.0))).alias(
            "ks_one_sided"
        ),
        *(["brier"] if brier else []),
    )


def roc_points(
    df: DataFrame, score: str = "pd", label: str = "bad", keys: Sequence[str] = (), places: int | None = None
) -> DataFrame:
    """(threshold, fpr, tpr) for "score at or above threshold", plus the origin (NULL threshold).

    With ``places``, scores equal to that many decimal places are one threshold.
    """
    if places is not None:
        df = df.withColumn(score, F.round(score, places))
    curve = class_curve(df, score, label, keys)
    above = lambda c: F.try_divide(
        F.col(f"{c}_total") - F.col(f"{c}_upto") + F.col(c), F.col(f"{c}_total")
    )
    points = curve.select(
        *keys, F.col(score).alias("threshold"), above("goods").alias("fpr"), above("bads").alias("tpr")
    )
    origin = points.groupBy(*keys).agg(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(origin)


def single_feature_auc(
    df: DataFrame, columns: Sequence[str], label: str = "bad"
) -> DataFrame:
    """AUC of each column taken alone as a score, all columns in one job.

    Rows where the column is NULL are left out for that column.
    """
    long = df.select(label, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        label, list(columns), "feature", "value"
    )
    return discrimination(long, "value", label, ["feature"], brier=False).select("feature", "n", "auc")


def check_single_feature_auc(
    df: DataFrame, spec: FeatureSpec = DEFAULT_SPEC, columns: Sequence[str] | None = None
) -> DataFrame:
    """Single-column AUCs with a flag on those outside 0.10 - 0.90."""
    found = single_feature_auc(df, columns or spec.numeric(df), spec.target)
    return found.withColumn(
        "extreme", F.coalesce((F.col("auc") > AUC_HIGH) | (F.col("auc") < AUC_LOW), F.lit(False))
    )


def leakage_check(
    df: DataFrame,
    threshold: float = AUC_SUSPICIOUS,
    spec: FeatureSpec = DEFAULT_SPEC,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Columns whose own AUC is above ``threshold``, highest first."""
    found = single_feature_auc(df, columns or spec.numeric(df), spec.target)
    return found.where(F.col("auc") > threshold).orderBy(F.desc("auc"), "feature")


def reliability_table(
    df: DataFrame, pd: str = "pd", label: str = "bad", bins: int = 10, keys: Sequence[str] = ()
) -> DataFrame:
    """Mean predicted and observed rate per equal-width bin of [0, 1]; empty bins are absent."""
    step = 1.0 / bins
    edges = [i * step for i in range(bins)] + [1.0]
    return (
        df.withColumn("bin", right_closed_bin(pd, edges))
        .groupBy(*keys, "bin")
        .agg(
            F.count("*").alias("n"),
            F.avg(pd).alias("mean_predicted"),
            F.avg(label).alias("observed_rate"),
        )
    )


def histogram(df: DataFrame, column: str, bins: int = 50, by: str | None = None) -> DataFrame:
    """Counts in equal-width bins over each series' own range; bins without rows are absent.

    The ranges of up to ``MAX_SERIES`` series are broadcast; beyond that they are
    joined like any other table.
    """
    rows = df.where(F.col(column).isNotNull())
    if by is None:
        low, high = rows.agg(F.min(column), F.max(column)).first()
        if low is None:
            low = high = 0.0
        return (
            rows.groupBy(left_closed_bin(F.col(column), low, high, bins).alias("bin"))
            .agg(F.count("*").alias("n"))
        )
    spans = rows.groupBy(by).agg(F.min(column).alias("_low"), F.max(column).alias("_high"))
    few = spans.take(MAX_SERIES + 1)
    if len(few) <= MAX_SERIES:
        spans = F.broadcast(values_table(df.sparkSession, few, spans.schema))
    position = F.floor(
        F.try_divide(F.col(column) - F.col("_low"), F.col("_high") - F.col("_low")) * bins
    ).cast("int")
    number = F.least(F.lit(bins), F.coalesce(position, F.lit(0)) + 1)
    return rows.join(spans, by).groupBy(by, number.alias("bin")).agg(F.count("*").alias("n"))


def column_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean, population deviation, minimum and maximum per column (one wide pass)."""
    stats = []
    for c in columns:
        stats += [
            F.count(c).alias(f"{c}|n"),
            F.avg(c).alias(f"{c}|mean"),
            F.stddev_pop(c).alias(f"{c}|std"),
            F.min(c).cast("double").alias(f"{c}|min"),
            F.max(c).cast("double").alias(f"{c}|max"),
        ]
    parts = ("n", "mean", "std", "min", "max")
    rows = [
        F.struct(F.lit(c).alias("feature"), *[F.col(f"{c}|{p}").alias(p) for p in parts])
        for c in columns
    ]
    return df.agg(*stats).select(F.inline(F.array(*rows)))


def class_balance(df: DataFrame, label: str = "bad") -> DataFrame:
    return df.agg(
        F.count(label).alias("n"),
        F.sum(label).cast("bigint").alias("bads"),
        F.avg(label).alias("bad_rate"),
    )


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact number of distinct values per column, NULL not counted.

    Two-step on (feature, value) pairs: no reducer holds a column's value set.
    """
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "feature", "value"
    )
    return (
        long.groupBy("feature", "value")
        .agg(F.lit(1).alias("one"))
        .groupBy("feature")
        .agg(F.count("value").alias("n_distinct"))
    )
