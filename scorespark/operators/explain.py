"""Exact attributions of a linear model, samples to explain, and rankings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorespark.functions.hashing import order_key
from scorespark.operators.scorecard import LinearModel
from scorespark.spec import RANDOM_STATE


def head_rows(df: DataFrame, key: str, n: int = 2000) -> DataFrame:
    """The first ``n`` rows by key."""
    return df.orderBy(key).limit(n)


def sample_rows(df: DataFrame, key: str, n: int = 100, seed: int = RANDOM_STATE) -> DataFrame:
    """A reproducible random sample of at most ``n`` rows."""
    return df.orderBy(order_key(key, seed), key).limit(n)


def feature_means(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    row = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
    return {c: row[c] for c in columns}


def _phi(model: LinearModel, means: Mapping[str, float], feature: str) -> Column:
    return F.lit(float(model.coefficients[feature])) * (F.col(feature) - F.lit(means[feature]))


def linear_shap(
    df: DataFrame,
    model: LinearModel,
    means: Mapping[str, float],
    key: str = "dummy_id",
    features: Sequence[str] | None = None,
) -> DataFrame:
    """Attribution of every feature to the log-odds: ``coef * (x - mean)``, in long form."""
    chosen = list(features or model.coefficients)
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(c).cast("double").alias("value"),
            _phi(model, means, c).alias("phi"),
        )
        for c in chosen
    ]
    return df.select(key, F.inline(F.array(*rows)))


def shap_importance(df: DataFrame, model: LinearModel, means: Mapping[str, float]) -> DataFrame:
    """Mean absolute attribution per feature, from one wide aggregate."""
    names = list(model.coefficients)
    rows = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("mean_abs_shap")) for c in names]
    return (
        df.agg(*[F.avg(F.abs(_phi(model, means, c))).alias(c) for c in names])
        .select(F.inline(F.array(*rows)))
        .orderBy(F.desc("mean_abs_shap"), "feature")
    )


def importance_of(attributions: DataFrame) -> DataFrame:
    """Mean absolute attribution per feature of a long attribution table."""
    return (
        attributions.groupBy("feature")
        .agg(F.avg(F.abs("phi")).alias("mean_abs_shap"))
        .orderBy(F.desc("mean_abs_shap"), "feature")
    )


def shap_dependence(
    df: DataFrame, model: LinearModel, means: Mapping[str, float], key: str = "dummy_id", top: int = 4
) -> DataFrame:
    """(value, attribution) pairs of the ``top`` features by mean absolute attribution."""
    best = [r["feature"] for r in shap_importance(df, model, means).limit(top).collect()]
    return linear_shap(df, model, means, key, best)


def top_coefficients(coefficients: DataFrame, top_n: int = 20) -> DataFrame:
    """Features by absolute coefficient."""
    return (
        coefficients.select("feature", F.abs("coefficient").alias("importance"))
        .orderBy(F.desc("importance"), "feature")
        .limit(top_n)
    )
