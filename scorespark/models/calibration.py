"""Sigmoid and isotonic calibration of default probabilities."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorespark.functions.scoring import sigmoid
from scorespark.models.logistic import NEWTON_WIDTH, fit_logistic, newton_fits
from scorespark.operators.preparing import Scaler, grouped_scaling
from scorespark.operators.scorecard import LinearModel
from scorespark.operators.splitting import equal_folds, fit_cuts
from scorespark.session import stage
from scorespark.spec import DEFAULT_SPEC, FeatureSpec


#: Probabilities are kept this far from 0 and 1 before their log odds are taken.
CLIP = 1e-6


@dataclass(frozen=True)
class Sigmoid:
    slope: float
    intercept: float

    def apply(self, margin: Column) -> Column:
        return sigmoid(F.lit(self.slope) * margin + F.lit(self.intercept))


def fit_sigmoid(df: DataFrame, margin: str = "margin", label: str = "bad") -> Sigmoid:
    """Platt's fit: logistic regression of smoothed targets on the margin.

    A smoothed target is one number between 0 and 1 per row, which the fit takes as it is.
    """
    sizes = df.agg(F.sum(label), F.sum(1 - F.col(label))).first()
    fitted = newton_fits(df, [margin], [_smoothed(label, *sizes)], [[0.0]], max_iter=200)[0]
    return Sigmoid(fitted.coefficients[margin], fitted.intercept)


def _smoothed(label: str, n_bad: int, n_good: int) -> Column:
    return F.when(F.col(label) == 1, (n_bad + 1.0) / (n_bad + 2.0)).otherwise(1.0 / (n_good + 2.0))


def _fold_sigmoids(folded: DataFrame, models: Sequence[LinearModel], label: str) -> list[Sigmoid]:
    """:func:`fit_sigmoid` of each fold under its own model, side by side."""
    margin = F.lit(None).cast("double")
    for k, model in enumerate(models):
        margin = F.when(F.col("fold") == k, model.margin()).otherwise(margin)
    rows = folded.select("fold", label, margin.alias("margin"))
    sizes = {r[0]: r[1:] for r in folded.groupBy("fold").agg(F.sum(label), F.sum(1 - F.col(label))).collect()}
    targets = [F.when(F.col("fold") == k, _smoothed(label, *sizes[k])) for k in range(len(models))]
    fitted = newton_fits(rows, ["margin"], targets, [[0.0]] * len(models), max_iter=200)
    return [Sigmoid(f.coefficients["margin"], f.intercept) for f in fitted]


@dataclass(frozen=True)
class CalibratedEnsemble:
    """Mean of the calibrated probabilities of one model per fold."""

    members: tuple[tuple[LinearModel, Sigmoid], ...]

    def pd(self) -> Column:
        total = None
        for model, curve in self.members:
            p = curve.apply(model.margin())
            total = p if total is None else total + p
        return total / F.lit(float(len(self.members)))


def _scalers(folded: DataFrame, features: Sequence[str]) -> dict[int, Scaler]:
    """The scaler of the rows outside each fold, all from one pass."""
    found: dict[int, tuple[dict, dict]] = {}
    for row in grouped_scaling(folded, "fold", features).collect():
        means, deviations = found.setdefault(int(row["fold"]), ({}, {}))
        means[row["feature"]] = 0.0 if row["mean"] is None else row["mean"]
        deviations[row["feature"]] = row["deviation"] or 1.0
    return {k: Scaler(*both) for k, both in found.items()}


def fit_calibrated(
    train: DataFrame,
    features: Sequence[str],
    spec: FeatureSpec = DEFAULT_SPEC,
    folds: int = 3,
    c: float = 1.0,
    scale: bool = False,
) -> CalibratedEnsemble:
    """Cross-fitted logistic regression with a sigmoid per fold.

    Each member is fitted on the other folds and calibrated on its own fold. With
    ``scale`` the features are standardised inside the fit, per fold; the scaling
    is folded into the coefficients, so scoring reads raw columns either way. The fits
    of all folds take their steps in the same passes over the rows.
    """
    columns = [spec.key, spec.target, *features]
    assigned = fit_cuts(train, equal_folds(folds), spec).apply(train.select(*columns), "fold")
    folded = stage(assigned, "folds")
    scalers = _scalers(folded, features) if scale else {}
    models = _fold_models(folded, features, spec, folds, c, scalers)
    return CalibratedEnsemble(tuple(zip(models, _fold_sigmoids(folded, models, spec.target))))


def _fold_models(
    folded: DataFrame, features: Sequence[str], spec: FeatureSpec, folds: int, c: float, scalers: dict[int, Scaler]
) -> list[LinearModel]:
    """The logistic model of the rows outside each fold; penalties are those of scaled features where there are scalers."""
    if len(features) <= NEWTON_WIDTH:
        targets = [F.when(F.col("fold") != k, F.col(spec.target)) for k in range(folds)]
        penalties = [[scalers[k].deviations[f] ** 2 / c if scalers else 1 / c for f in features] for k in range(folds)]
        return newton_fits(folded, features, targets, penalties)
    models = []
    for k in range(folds):
        rest = folded.where(F.col("fold") != k)
        if scalers:
            scaler = scalers[k]
            inner = fit_logistic(scaler.apply(rest), features, spec.target, c)
            slopes = {f: w / scaler.deviations[f] for f, w in inner.coefficients.items()}
            shift = sum(slopes[f] * scaler.means[f] for f in features)
            models.append(LinearModel(slopes, inner.intercept - shift))
        else:
            models.append(fit_logistic(rest, features, spec.target, c))
    return models


@dataclass(frozen=True)
class Isotonic:
    """A rising curve through ``values`` at ``borders``, straight in between and level beyond."""

    borders: tuple[float, ...]
    values: tuple[float, ...]

    def of(self, score: Column) -> Column:
        """Calibrated value by binary search among the borders; expressions only, also on streams."""
        # literals that the optimiser folds into one array each
        borders, values = (F.from_json(F.lit(json.dumps(x)), "array<double>") for x in (self.borders, self.values))
        n = len(self.borders)
        # borders before low are <= x
        start = F.struct(F.lit(0).alias("low"), F.lit(n).alias("high"), score.alias("x"))

        def halve(at: Column, _: Column) -> Column:
            middle = F.floor((at["low"] + at["high"]) / 2).cast("int")
            beyond = F.get(borders, middle) <= at["x"]
            going = at["low"] < at["high"]
            return F.struct(
                F.when(going & beyond, middle + 1).otherwise(at["low"]).alias("low"),
                F.when(going & ~beyond, middle).otherwise(at["high"]).alias("high"),
                at["x"].alias("x"),
            )

        steps = F.sequence(F.lit(0), F.lit(n.bit_length()))
        place = F.aggregate(steps, start, halve, lambda at: at["low"])
        low, high = F.get(borders, place - 1), F.get(borders, place)
        below, above = F.get(values, place - 1), F.get(values, place)
        between = F.when(low == score, below).otherwise(below + (above - below) * (score - low) / (high - low))
        ends = F.when(place == 0, self.values[0]).when(place == n, self.values[-1])
        return F.when(score.isNotNull(), ends.otherwise(between))

    def apply(self, df: DataFrame, score: str = "pd", column: str = "pd_calibrated") -> DataFrame:
        """Interpolated calibrated value; scores beyond the fitted range take the end values."""
        return df.withColumn(column, self.of(F.col(score).cast("double")))


@dataclass(frozen=True)
class OnLogOdds:
    """A sigmoid over the log odds of finished probabilities, which are kept off 0 and 1."""

    curve: Sigmoid

    def of(self, score: Column) -> Column:
        return self.curve.apply(_log_odds(score))

    def apply(self, df: DataFrame, score: str = "pd", column: str = "pd_calibrated") -> DataFrame:
        return df.withColumn(column, self.of(F.col(score)))


def _log_odds(score: Column) -> Column:
    near = F.least(F.greatest(score, F.lit(CLIP)), F.lit(1 - CLIP))
    return F.ln(near / (1 - near))


@dataclass(frozen=True)
class Calibrated:
    """A fitted model with a curve over its probabilities; saved and scored like any model."""

    model: object
    curve: Isotonic | OnLogOdds

    def pd(self) -> Column:
        return self.curve.of(self.model.pd())


def fit_isotonic(df: DataFrame, score: str = "pd", label: str = "bad") -> Isotonic:
    """Monotone step fit of the label on the score.

    Equal scores are merged to one weighted point before the fit, which leaves
    the solution unchanged and shrinks what the pooling has to look at.
    """
    points = df.groupBy(F.col(score).cast("double").alias("_score")).agg(
        F.avg(F.col(label).cast("double")).alias("y"), F.count("*").cast("double").alias("weight")
    )
    estimator = IsotonicRegression(featuresCol="_score", labelCol="y", weightCol="weight")
    fitted = estimator.fit(points)
    return Isotonic(tuple(map(float, fitted.boundaries)), tuple(map(float, fitted.predictions)))


def fit_curve(df: DataFrame, method: str = "isotonic", score: str = "pd", label: str = "bad") -> Isotonic | OnLogOdds:
    """A curve from probabilities to calibrated ones, learned on held-out rows."""
    if method == "isotonic":
        return fit_isotonic(df, score, label)
    if method == "sigmoid":
        # on the log odds for every model; probabilities of exactly 0 or 1 are moved off the
        # border, in the fit as in use, so no row is left out
        return OnLogOdds(fit_sigmoid(df.select(label, _log_odds(F.col(score)).alias("margin")), "margin", label))
    raise ValueError(f"unknown calibration method '{method}'")


def calibrate_model(df: DataFrame, method: str = "isotonic", score: str = "pd", label: str = "bad"):
    """:func:`fit_curve` as a function DataFrame -> DataFrame that adds ``pd_calibrated``."""
    curve = fit_curve(df, method, score, label)
    return lambda other: curve.apply(other, score)
