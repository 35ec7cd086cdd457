"""Quantile and equal-width bins, risk bands, weight of evidence and information value."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scorespark.functions.intervals import bin_text, even_edges, right_closed_bin
from scorespark.operators.preparing import fit_rows
from scorespark.operators.quantiles import exact_quantiles
from scorespark.session import values_table
from scorespark.spec import DEFAULT_SPEC, FeatureSpec

BANDS = ("A", "B", "C", "D", "E")  # safest first
BINS = 10
IV_STRONG, IV_MEDIUM = 0.3, 0.1


@dataclass(frozen=True)
class BinEdges:
    """Edges per column; bins are right-closed and the first holds the minimum."""

    edges: Mapping[str, tuple[float, ...]]

    def count(self, column: str) -> int:
        return max(1, len(self.edges[column]) - 1)

    def table(self, spark: SparkSession) -> DataFrame:
        """All bins, also empty ones: (feature, bin, lo, hi)."""
        rows = []
        for c, e in self.edges.items():
            for i in range(self.count(c)):
                rows.append((c, i + 1, float(e[i]), float(e[min(i + 1, len(e) - 1)])))
        return values_table(spark, rows, "feature string, bin int, lo double, hi double")


def fit_quantile_bins(
    df: DataFrame, columns: Sequence[str], bins: int = BINS, fit_on: str = "all"
) -> BinEdges:
    """Edges at equally spaced quantiles; equal edges are merged."""
    marks = [i / bins for i in range(bins + 1)]
    found = exact_quantiles(fit_rows(df, fit_on), {c: marks for c in columns})
    return BinEdges({c: tuple(sorted(set(v))) for c, v in found.items() if None not in v})


def fit_equal_width_bins(
    df: DataFrame, columns: Sequence[str], bins: int = BINS, fit_on: str = "all"
) -> BinEdges:
    """``min(bins, distinct values)`` equally wide bins between minimum and maximum.

    Only whether a column has fewer than ``bins`` distinct values matters, so the
    distinct values are counted from (column, value) pairs, not in one set.
    """
    rows = fit_rows(df, fit_on)
    spans = rows.agg(
        *[F.min(c).cast("double").alias(f"lo:{c}") for c in columns],
        *[F.max(c).cast("double").alias(f"hi:{c}") for c in columns],
        *[F.approx_count_distinct(c).alias(f"d:{c}") for c in columns],
    ).first()
    few = [c for c in columns if spans[f"d:{c}"] <= 2 * bins]
    exact = rows.agg(*[F.count_distinct(c).alias(c) for c in few]).first() if few else {}
    edges = {}
    for c in columns:
        low, high = spans[f"lo:{c}"], spans[f"hi:{c}"]
        if low is None:
            continue
        width = min(bins, exact[c]) if c in few else bins
        edges[c] = (low,) if low == high else tuple(even_edges(low, high, width))
    return BinEdges(edges)


def bin_columns(df: DataFrame, edges: BinEdges, keep: Sequence[str] = ()) -> DataFrame:
    """The kept columns, and every binned column replaced by its bin number."""
    return df.select(
        *keep, *[right_closed_bin(c, e).alias(c) for c, e in edges.edges.items()]
    )


def bin_counts(df: DataFrame, edges: BinEdges, label: str = "bad") -> DataFrame:
    """Rows, bads and goods per (feature, bin), with a row for each empty bin.

    Columns are binned side by side first; only the small bin numbers are turned
    into long form and they are counted before the shuffle.
    """
    long = bin_columns(df, edges, [label]).unpivot(label, list(edges.edges), "feature", "bin")
    counted = (
        long.where(F.col("bin").isNotNull())
        .groupBy("feature", "bin")
        .agg(F.count(label).alias("total"), F.sum(label).cast("bigint").alias("bads"))
    )
    every = edges.table(df.sparkSession)
    return every.join(counted, ["feature", "bin"], "left").select(
        "feature",
        "bin",
        "lo",
        "hi",
        F.coalesce("total", F.lit(0)).alias("total"),
        F.coalesce("bads", F.lit(0)).alias("bads"),
        F.coalesce(F.col("total") - F.col("bads"), F.lit(0)).alias("goods"),
    )


def woe_iv_table(df: DataFrame, edges: BinEdges, label: str = "bad") -> DataFrame:
    """Weight of evidence per bin (half a case added to each) and IV per feature."""
    feature = Window.partitionBy("feature")
    k = F.count("*").over(feature)
    dist = lambda c: (F.col(c) + 0.5) / (F.sum(c).over(feature) + 0.5 * k)
    shares = bin_counts(df, edges, label).withColumns(
        {"dist_good": dist("goods"), "dist_bad": dist("bads")}
    )
    woe = F.ln(F.col("dist_good") / F.col("dist_bad"))
    scored = shares.withColumn("woe", woe).withColumn(
        "iv_bin", (F.col("dist_good") - F.col("dist_bad")) * F.col("woe")
    )
    return scored.withColumn("iv_total", F.sum("iv_bin").over(feature))


def compute_iv_all(
    df: DataFrame, columns: Sequence[str], bins: int = BINS, label: str = "bad"
) -> DataFrame:
    """Information value of every column, highest first."""
    table = woe_iv_table(df, fit_quantile_bins(df, columns, bins), label)
    return (
        table.groupBy("feature")
        .agg(F.sum("iv_bin").alias("iv"))
        .orderBy(F.desc("iv"), "feature")
    )


def strongest_features(iv: DataFrame, top_n: int = 20) -> DataFrame:
    """The ``top_n`` features by IV with a strength class."""
    strength = (
        F.when(F.col("iv") > IV_STRONG, "strong").when(F.col("iv") > IV_MEDIUM, "medium").otherwise("weak")
    )
    return iv.orderBy(F.desc("iv"), "feature").limit(top_n).withColumn("strength", strength)


@dataclass(frozen=True)
class ScoreBands:
    """Fitted score edges; the highest bin is band A and labels run down from there."""

    edges: tuple[float, ...]

    def apply(self, df: DataFrame, score: str = "score", column: str = "band") -> DataFrame:
        top = max(1, len(self.edges) - 1)
        label = bin_text(score, self.edges, lambda number: f"'{BANDS[top - number]}'")
        return df.withColumn(column, F.expr(label))


def fit_bands(df: DataFrame, score: str = "score", fit_on: str = "all") -> ScoreBands:
    """Five equally filled bands of ``score``; tied edges merge and leave bands empty."""
    fitted = fit_quantile_bins(df, [score], len(BANDS), fit_on)
    return ScoreBands(fitted.edges.get(score, ()))


def band_summary(
    df: DataFrame, score: str = "score", pd: str = "pd", label: str = "bad", band: str = "band"
) -> DataFrame:
    """Rows, mean score, mean PD and bad rate for each of the five bands, empty ones included."""
    found = df.groupBy(band).agg(
        F.count(label).alias("n"),
        F.avg(score).alias("avg_score"),
        F.avg(pd).alias("avg_pd"),
        F.avg(label).alias("bad_rate"),
    )
    every = values_table(df.sparkSession, 
        [(name, i + 1) for i, name in enumerate(BANDS)], f"{band} string, band_rank int"
    )
    return every.join(found, band, "left").withColumn("n", F.coalesce("n", F.lit(0)))


def bands_monotone(summary: DataFrame) -> DataFrame:
    """One row: does the bad rate rise strictly from A to E (empty bands skipped)?"""
    filled = summary.where(F.col("n") > 0)
    previous = F.lag("bad_rate").over(Window.orderBy("band_rank"))
    rises = F.coalesce(F.col("bad_rate") > previous, F.lit(True))
    return filled.select(rises.alias("rises"), "band").agg(
        F.count("*").alias("n_bands"), F.bool_and("rises").alias("monotone")
    )
