"""Whole runs as queries; the preparation run has a SQL twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorespark.plans import flows
from scorespark.plans.model_queries import measured, measured_sql
from scorespark.plans.registry import query, rounded
from scorespark.plans.sql import NUMERIC, imputed_cte, split_cte
from scorespark.session import scratch_path
from scorespark.sources.applicants import applicants

_MADE = ["affordability_ratio", "risk_ratio", "net_risk", "risk_x_dim_emo"]
_ALL = NUMERIC + _MADE
_PARAMS = ", ".join(f"AVG({c}) AS m_{c}, STDDEV_POP({c}) AS s_{c}" for c in _ALL)
_SCALED = ", ".join(
    f"ROUND(AVG((i.{c} - par.m_{c}) / CASE WHEN par.s_{c} = 0 THEN 1 ELSE par.s_{c} END), 6) + 0e0 AS {c}" for c in _ALL
)


@query(
    f"""WITH {split_cte('holdout')}, e AS (SELECT *, income / NULLIF(expenses + 1, 0) AS affordability_ratio,
  risk_drivers / NULLIF(risk_mitigators + 1, 0) AS risk_ratio, risk_drivers - risk_mitigators AS net_risk,
  total_risk_score * dim_emotional_understanding AS risk_x_dim_emo FROM s),
{imputed_cte('e', _ALL, "split = 'train'")}, par AS (SELECT {_PARAMS} FROM i WHERE split = 'train')
SELECT split, COUNT(*) AS n, CAST(SUM(bad) AS BIGINT) AS bads,
  COUNT(*) FILTER (product_type = 'MACHINERY') AS machinery, {_SCALED} FROM i CROSS JOIN par GROUP BY split"""
)
def prepare_run(spark, d):
    """The saved splits of a preparation run: means of the scaled features per split."""
    done = flows.prepare_run(applicants(spark, d), scratch_path(spark, "prepare-run"))
    found = done.rows.groupBy("split").agg(
        F.count("*").alias("n"),
        F.sum("bad").alias("bads"),
        (F.count_if(F.col("product_type_MACHINERY") > 0)).alias("machinery"),
        *[F.avg(c).alias(c) for c in _ALL],
    )
    return rounded(found, *_ALL).withColumns({c: F.col(c) + 0.0 for c in _ALL})


@query(measured_sql("two", ("scorecard", "random_forest")))
def scorecard_run(spark, d):
    metrics, _ = flows.scorecard_run(applicants(spark, d), scratch_path(spark, "scorecard-run"))
    return measured(metrics, "model")


@query(measured_sql("shares", tuple(f"{m}_{v}" for m in ("logistic", "forest", "boosting") for v in ("base", "calibrated"))))
def evaluation_run(spark, d):
    done = flows.evaluation_run(applicants(spark, d), scratch_path(spark, "evaluation-run"))
    return measured(done.metrics, "model")
