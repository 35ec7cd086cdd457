"""Column expressions of scorecard arithmetic; all of them stay in generated code."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from scorespark.functions.intervals import double_literal, quoted


@dataclass(frozen=True)
class ScoreScale:
    """Points scale: ``base`` points at ``odds``:1, ``pdo`` points double the odds."""

    base: float = 600.0
    pdo: float = 50.0
    odds: float = 20.0

    @property
    def factor(self) -> float:
        return self.pdo / math.log(2)

    @property
    def offset(self) -> float:
        return self.base - self.factor * math.log(self.odds)


BAND_SCALE = ScoreScale()
POINTS_SCALE = ScoreScale(base=600.0, pdo=20.0, odds=50.0)
PD_FLOOR = 1e-6


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def clip_pd(pd: Column) -> Column:
    return F.least(F.greatest(pd, F.lit(PD_FLOOR)), F.lit(1.0 - PD_FLOOR))


def pd_to_score(pd: Column, scale: ScoreScale = BAND_SCALE) -> Column:
    """Points of a default probability; higher is safer."""
    p = clip_pd(pd)
    return F.lit(scale.offset) + F.lit(scale.factor) * F.ln((F.lit(1.0) - p) / p)


def build_score(pd: Column, base_score: float = 600, pdo: float = 50, base_odds: float = 20) -> Column:
    return pd_to_score(pd, ScoreScale(base_score, pdo, base_odds))


def linear_form(coefficients: Mapping[str, float], intercept: float) -> Column:
    """``intercept + sum(coef * column)`` in the mapping's order."""
    terms = [f"{double_literal(w)} * {quoted(name)}" for name, w in coefficients.items()]
    return F.expr(" + ".join([double_literal(intercept), *terms]))


def margin_to_points(margin: Column, scale: ScoreScale = POINTS_SCALE) -> Column:
    """Whole points of a log-odds margin, halves to even."""
    return F.bround(F.lit(scale.offset) - F.lit(scale.factor) * margin, 0).cast("int")


def decision(score: Column, approve: float = 620, decline: float = 560) -> Column:
    """APPROVE at or above ``approve``, DECLINE below ``decline``, else REFER."""
    return (
        F.when(score >= F.lit(approve), "APPROVE")
        .when(score < F.lit(decline), "DECLINE")
        .otherwise("REFER")
    )


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient that is NULL on a zero denominator instead of failing."""
    return F.try_divide(numerator, denominator)
