"""Linear scorecards: probabilities, points, decisions and the scoring report."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorespark.functions.scoring import (
    BAND_SCALE,
    POINTS_SCALE,
    ScoreScale,
    decision,
    linear_form,
    margin_to_points,
    pd_to_score,
    sigmoid,
)
from scorespark.session import values_table


@dataclass(frozen=True)
class LinearModel:
    """Coefficients by feature name; scoring is one generated-code expression."""

    coefficients: Mapping[str, float]
    intercept: float

    def margin(self) -> Column:
        return linear_form(self.coefficients, self.intercept)

    def pd(self) -> Column:
        return sigmoid(self.margin())

    def on_scaled(self, deviations: Mapping[str, float]) -> LinearModel:
        """The same model for features divided by ``deviations`` (slopes only)."""
        return LinearModel(
            {c: w * deviations[c] for c, w in self.coefficients.items()}, self.intercept
        )

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(c, float(w)) for c, w in self.coefficients.items()]
        return values_table(spark, rows, "feature string, coefficient double")


# fixed values: the frozen scorecard (features after median imputation)
FROZEN_MODEL = LinearModel(
    {
        "num_accounts_assess": 0.62,
        "risk_drivers": 0.001,
        "risk_mitigators": -0.001,
        "r_ho_em2_co": 0.004,
        "dim_judgement": -0.00001,
    },
    -3.1,
)


def score_population(df: DataFrame, pd: Column, scale: ScoreScale = BAND_SCALE) -> DataFrame:
    """Add ``pd`` and ``score``."""
    return df.withColumn("pd", pd).withColumn("score", pd_to_score(F.col("pd"), scale))


def score_dataset(df: DataFrame, model: LinearModel, scale: ScoreScale = POINTS_SCALE) -> DataFrame:
    """Add whole-number ``points``."""
    return df.withColumn("points", margin_to_points(model.margin(), scale))


def assign_decisions(
    df: DataFrame, score: str = "points", approve_cutoff: float = 620, decline_cutoff: float = 560
) -> DataFrame:
    return df.withColumn("decision", decision(F.col(score), approve_cutoff, decline_cutoff))


def decision_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("decision").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "decision")


def build_scorecard(coefficients: DataFrame, scale: ScoreScale = POINTS_SCALE) -> DataFrame:
    """Points per unit of each (scaled) feature and the feature's share of the offset.

    ``coefficients`` has one row per feature; the intercept plays no part.
    """
    n = coefficients.count()
    points = F.bround(-F.col("coefficient") * F.lit(scale.factor), 2)
    return coefficients.select(
        "feature",
        "coefficient",
        points.alias("points_per_unit"),
        F.bround(F.lit(scale.offset / n), 2).alias("base_score_share"),
    ).orderBy("points_per_unit", "feature")


def scoring_report(
    df: DataFrame,
    model: LinearModel,
    key: str = "dummy_id",
    label: str = "bad",
    approve_cutoff: float = 620,
    decline_cutoff: float = 560,
) -> DataFrame:
    """Score, decision and what happened, one row per applicant."""
    scored = assign_decisions(score_dataset(df, model), "points", approve_cutoff, decline_cutoff)
    return scored.select(
        key, F.col("points").alias("score"), "decision", F.col(label).alias("actual_bad")
    )
