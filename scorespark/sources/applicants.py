"""The applicant, audit and outcome tables, derived from order data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorespark.sources.readers import table


def _percent(c: str) -> Column:
    """Whole percent of a non-negative rate (``round`` would go through decimals)."""
    return F.floor(F.col(c) * 100 + 0.5).cast("int")


def _flagged(flag: str) -> Column:
    return F.sum(F.when(F.col("l_returnflag") == flag, 1).otherwise(0))


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items rolled up to one row per order (counted before the shuffle)."""
    quantity = F.col("l_quantity")
    return (
        table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count("*").cast("double").alias("n_lines"),
            F.sum(quantity).alias("sum_qty"),
            F.max(quantity).alias("max_qty"),
            F.min(quantity).alias("min_qty"),
            F.sum(_percent("l_discount")).cast("double").alias("sum_disc"),
            F.max(_percent("l_discount")).cast("double").alias("max_disc"),
            F.sum(_percent("l_tax")).cast("double").alias("sum_tax"),
            F.max(_percent("l_tax")).cast("double").alias("max_tax"),
            F.datediff(F.max("l_shipdate"), F.min("l_shipdate")).cast("double").alias("ship_span"),
            _flagged("R").cast("double").alias("r_lines"),
            _flagged("N").cast("double").alias("n_flag_lines"),
            F.max(F.when(F.col("l_returnflag") == "R", quantity)).alias("r_max_qty"),
        )
    )


def applicants(spark: SparkSession, folder: str) -> DataFrame:
    """One applicant per order, in the shape of a credit-application table.

    Orders and line totals meet on the order key, by which the totals are
    already partitioned. The customer side is left to the optimiser, which
    broadcasts it only while it is small.
    """
    lines = order_lines(spark, folder)
    customers = table(spark, folder, "customer")
    orders = table(spark, folder, "orders")
    joined = orders.join(customers, orders.o_custkey == customers.c_custkey, "left").join(
        lines, orders.o_orderkey == lines.l_orderkey, "left"
    )
    return joined.select(
        F.col("o_orderkey").alias("dummy_id"),
        F.when(F.col("l_orderkey").isNotNull(), F.col("c_mktsegment")).alias("product_type"),
        F.col("sum_qty").alias("total_risk_score"),
        F.col("sum_disc").alias("risk_drivers"),
        F.col("sum_tax").alias("risk_mitigators"),
        F.col("c_acctbal").alias("dim_judgement"),
        F.col("o_totalprice").alias("dim_core_traits"),
        F.col("max_disc").alias("dim_emotional_understanding"),
        F.col("c_nationkey").cast("double").alias("dim_principles"),
        F.col("max_qty").alias("r_ho_em2_co"),
        F.col("min_qty").alias("r_ho_vi4_st"),
        F.col("n_lines").alias("num_accounts_assess"),
        F.col("max_tax").alias("worst_arrears_assess"),
        F.col("ship_span").alias("age_oldest_assess"),
        F.col("o_totalprice").alias("income"),
        F.col("c_acctbal").alias("expenses"),
        F.col("n_flag_lines").alias("num_accounts_perf"),
        F.col("r_lines").alias("highest_arrears_perf"),
        F.col("r_max_qty").alias("age_oldest_perf"),
        F.when(F.coalesce("r_lines", F.lit(0.0)) >= 2, 1).otherwise(0).alias("bad"),
    )


def applicant_columns() -> dict[str, str]:
    """Declared column types of :func:`applicants`."""
    names = (
        "total_risk_score",
        "risk_drivers",
        "risk_mitigators",
        "dim_judgement",
        "dim_core_traits",
        "dim_emotional_understanding",
        "dim_principles",
        "r_ho_em2_co",
        "r_ho_vi4_st",
        "num_accounts_assess",
        "worst_arrears_assess",
        "age_oldest_assess",
        "income",
        "expenses",
        "num_accounts_perf",
        "highest_arrears_perf",
        "age_oldest_perf",
    )
    return {"dummy_id": "bigint", "product_type": "string", **{c: "double" for c in names}, "bad": "int"}


def application_times(spark: SparkSession, folder: str) -> DataFrame:
    """When each applicant was scored."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("applicant_id"), F.col("o_orderdate").alias("scored_at")
    )


def outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """Observed outcome per applicant: bad when two or more lines came back."""
    return (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("applicant_id"))
        .agg(
            F.max("l_shipdate").alias("observed_at"),
            F.when(_flagged("R") >= 2, 1).otherwise(0).alias("bad"),
        )
    )


def request_log(spark: SparkSession, folder: str) -> DataFrame:
    """The scoring requests of ``events``: model version and latency per request."""
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, folder, "events").select(
        F.col("event_id").alias("request_id"),
        "ts",
        F.col("user_id").alias("applicant_id"),
        F.col("value"),
        k.alias("k"),
        (k % 2).alias("model_version"),
        "event_type",
    )
