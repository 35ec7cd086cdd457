"""Stability, drift, outcome and champion/challenger reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorespark.functions.intervals import right_closed_bin
from scorespark.operators.asof import asof_next
from scorespark.operators.bands import BANDS, BinEdges, bin_columns
from scorespark.session import values_table


def psi_term(expected: Column, actual: Column) -> Column:
    return (actual - expected) * F.ln(actual / expected)


def _psi(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """PSI per ``keys`` of (expected, actual) counts, half a case added to each bin."""
    group = Window.partitionBy(*keys)
    k = F.count("*").over(group)
    share = lambda c: (F.col(c) + 0.5) / (F.sum(c).over(group) + 0.5 * k)
    shares = counts.select(*keys, "bin", share("expected").alias("e"), share("actual").alias("a"))
    return shares.groupBy(*keys).agg(F.sum(psi_term(F.col("e"), F.col("a"))).alias("psi"))


def population_stability(baseline: DataFrame, current: DataFrame, edges: BinEdges) -> DataFrame:
    """PSI of every binned column between two populations; bins come from the baseline."""
    columns = list(edges.edges)
    both = bin_columns(baseline, edges, [F.lit(1).alias("is_base")]).unionByName(
        bin_columns(current, edges, [F.lit(0).alias("is_base")])
    )
    counted = (
        both.unpivot("is_base", columns, "feature", "bin")
        .where(F.col("bin").isNotNull())
        .groupBy("feature", "bin")
        .agg(
            F.sum("is_base").alias("expected"),
            F.sum(1 - F.col("is_base")).alias("actual"),
        )
    )
    every = edges.table(baseline.sparkSession).select("feature", "bin")
    full = every.join(counted, ["feature", "bin"], "left").na.fill(0, ["expected", "actual"])
    return _psi(full, ["feature"])


def psi_from_period_counts(counts: DataFrame, edges: BinEdges, column: str, baseline: DataFrame) -> DataFrame:
    """PSI per period of ``counts(period, bin, n)`` against ``baseline(bin, n)``."""
    every = edges.table(counts.sparkSession).where(F.col("feature") == column).select("bin")
    expected = every.join(baseline.select("bin", F.col("n").alias("expected")), "bin", "left")
    # one row per bin and period: the periods are spread over the (ten) bins as an array
    periods = counts.groupBy("period").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("by_bin")
    )
    bins = [r["bin"] for r in every.collect()]
    long = periods.select(
        "period",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(b).alias("bin"),
                        F.coalesce(F.try_element_at("by_bin", F.lit(b)), F.lit(0)).alias("actual"),
                    )
                    for b in bins
                ]
            )
        ),
    )
    full = long.join(expected, "bin").na.fill(0, ["expected"])
    return _psi(full, ["period"])


def period_bin_counts(df: DataFrame, column: str, edges: BinEdges, period: Column) -> DataFrame:
    """Rows per period and bin of ``column``."""
    number = right_closed_bin(column, edges.edges[column])
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(period.alias("period"), number.alias("bin"))
        .agg(F.count("*").alias("n"))
    )


def drift_alerts(psi: DataFrame, threshold: float = 0.2) -> DataFrame:
    """Periods or features whose PSI is above ``threshold``: retraining is due."""
    return psi.where(F.col("psi") > threshold)


def validation_gate(
    metrics: DataFrame,
    monotone: DataFrame,
    psi: DataFrame,
    auc_floor: float = 0.60,
    auc_ceiling: float = 0.95,
    ks_floor: float = 0.20,
    psi_ceiling: float = 0.25,
) -> DataFrame:
    """One row of pass/fail columns from one-row inputs; ``passed`` needs all of them."""
    numbers = metrics.select("auc", "ks").first()
    bands = monotone.select("monotone").first()
    worst = psi.agg(F.max("psi").alias("psi")).first()
    spark = metrics.sparkSession
    row = values_table(spark, 
        [(numbers["auc"], numbers["ks"], worst["psi"], bands["monotone"])],
        "auc double, ks double, max_psi double, bands_monotone boolean",
    )
    return row.withColumns(
        {
            "auc_ok": (F.col("auc") > auc_floor) & (F.col("auc") < auc_ceiling),
            "ks_ok": F.col("ks") >= ks_floor,
            "psi_ok": F.col("max_psi") <= psi_ceiling,
        }
    ).withColumn(
        "passed", F.col("auc_ok") & F.col("ks_ok") & F.col("psi_ok") & F.col("bands_monotone")
    )


def value_ranges(df: DataFrame, columns: Sequence[str], period: Column) -> DataFrame:
    """Minimum and maximum of each column per period, long form, one wide aggregate."""
    measures = []
    for c in columns:
        measures += [F.min(c).cast("double").alias(f"{c}|lo"), F.max(c).cast("double").alias(f"{c}|hi")]
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(f"{c}|lo").alias("min_value"),
            F.col(f"{c}|hi").alias("max_value"),
        )
        for c in columns
    ]
    return df.groupBy(period.alias("period")).agg(*measures).select("period", F.inline(F.array(*rows)))


def retraining_rows(
    audit: DataFrame, outcomes: DataFrame, window_days: int, key: str = "applicant_id"
) -> DataFrame:
    """Scored requests with the first outcome observed in their performance window.

    An applicant may have any number of requests and outcomes, a third of all rows too:
    the as-of join splits the time line inside an applicant. A request has at most one
    row and rows are never multiplied. Of outcomes at the same time the larger label counts.
    """
    columns = [c for c in audit.columns if c != key]
    found = asof_next(audit, outcomes, key, "scored_at", "observed_at", ["bad"])
    until = F.col("scored_at") + F.make_dt_interval(F.lit(window_days))
    matured = found.where(F.col("_found.observed_at") < until)
    return matured.select(key, *columns, "_found.observed_at", "_found.bad")


def realised_vs_predicted(audit: DataFrame, outcomes: DataFrame, key: str = "applicant_id") -> DataFrame:
    """Mean PD and realised bad rate per band, with the applicants not yet observed."""
    known = outcomes.groupBy(key).agg(F.max("bad").alias("bad"))  # bad once is bad
    joined = audit.join(known, key, "left")
    return joined.groupBy("band").agg(
        F.count("*").alias("n_scored"),
        F.count("bad").alias("n_observed"),
        F.avg("pd").alias("avg_pd"),
        F.avg(F.when(F.col("bad").isNotNull(), F.col("pd"))).alias("avg_pd_observed"),
        F.avg("bad").alias("realised_rate"),
    )


def pending_outcomes(audit: DataFrame, outcomes: DataFrame, key: str = "applicant_id") -> DataFrame:
    """Scored applicants without any outcome yet."""
    return audit.join(outcomes.select(key).distinct(), key, "left_anti")


def shadow_pairs(audit: DataFrame, champion: int, challenger: int, key: str = "request_id") -> DataFrame:
    """Both models' answers to the same request side by side.

    Grouping by request instead of a self-join reads the log once.
    """
    of = lambda version, c: F.max(F.when(F.col("model_version") == version, F.col(c)))
    return (
        audit.where(F.col("model_version").isin(champion, challenger))
        .groupBy(key)
        .agg(
            of(champion, "pd").alias("champion_pd"),
            of(challenger, "pd").alias("challenger_pd"),
            of(champion, "band").alias("champion_band"),
            of(challenger, "band").alias("challenger_band"),
        )
        .where(F.col("champion_pd").isNotNull() & F.col("challenger_pd").isNotNull())
    )


def band_migration(pairs: DataFrame) -> DataFrame:
    """Champion band by challenger band counts, one column per challenger band."""
    return (
        pairs.groupBy("champion_band")
        .agg(
            *[
                F.count_if(F.col("challenger_band") == b).alias(f"to_{b.lower()}")
                for b in BANDS
            ]
        )
    )


def band_agreement(pairs: DataFrame) -> DataFrame:
    return pairs.agg(
        F.count("*").alias("n"),
        F.avg((F.col("champion_band") == F.col("challenger_band")).cast("int")).alias("same_band_share"),
        F.avg(F.col("challenger_pd") - F.col("champion_pd")).alias("mean_pd_change"),
        F.max(F.abs(F.col("challenger_pd") - F.col("champion_pd"))).alias("max_pd_change"),
    )


def recent_scores(audit: DataFrame, n: int = 50, ts: str = "ts", tie: str = "request_id") -> DataFrame:
    """The ``n`` most recent scores (a top-k report)."""
    return audit.orderBy(F.desc(ts), F.desc(tie)).limit(n)


def window_features(
    events: DataFrame, key: str, ts: str, value: str, start: Column, days: int
) -> DataFrame:
    """Features before ``start`` (assessment) and in the ``days`` after it (performance)."""
    before = F.col(ts) < start
    after = (F.col(ts) >= start) & (F.col(ts) < start + F.make_dt_interval(F.lit(days)))
    columns = []
    for name, test in (("assess", before), ("perf", after)):
        columns += [
            F.count_if(test).alias(f"n_{name}"),
            F.max(F.when(test, F.col(value))).alias(f"worst_{name}"),
            F.min(F.when(test, F.col(ts))).alias(f"oldest_{name}"),
        ]
    return events.groupBy(key).agg(*columns)
