"""Penalised logistic regression on wide columns."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorespark.operators.explain import top_coefficients
from scorespark.operators.scorecard import LinearModel


#: Features up to which fits go side by side by Newton's method; their tasks return a square of them.
NEWTON_WIDTH = 100
#: Expected fall of the mean loss below which a Newton step is the last.
LAST_STEP = 1e-10


def assemble(df: DataFrame, features: Sequence[str], *keep: str) -> DataFrame:
    """``keep`` and the features as one vector column ``x``."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="x", handleInvalid="error")
    return assembler.transform(df).select(*keep, "x")


def fit_logistic(
    df: DataFrame,
    features: Sequence[str],
    label: str = "bad",
    c: float = 1.0,
    max_iter: int = 1000,
    rows: int | None = None,
) -> LinearModel:
    """L2-penalised fit with inverse penalty ``c`` and a free intercept.

    The penalty is stated for a sum of losses; Spark averages the losses, hence
    ``1 / (c * rows)``. Pass a cached or staged frame: every iteration scans it.
    """
    rows = rows or df.count()
    estimator = LogisticRegression(
        featuresCol="x",
        labelCol=label,
        regParam=1.0 / (c * rows),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=max_iter,
        tol=1e-7,
    )
    fitted = estimator.fit(assemble(df, features, label))
    return LinearModel(
        dict(zip(features, (float(w) for w in fitted.coefficients.toArray()))), float(fitted.intercept)
    )


def newton_fits(
    df: DataFrame, features: Sequence[str], targets: Sequence[Column], penalties: Sequence[Sequence[float]], max_iter: int = 1000
) -> list[LinearModel]:
    """Logistic regressions on ``targets`` (0 to 1) by Newton's method; all of them take a step in one pass.

    A row takes part in the fits whose target is not NULL. ``penalties`` times half the squared coefficients are
    added to the sum of losses of each fit; the intercept is free. A pass adds up losses, slopes and
    curvatures of the standardised columns in the tasks, so the driver sees a few numbers per pair of
    features. A step that does not lower the loss is halved. Rows of one class only give an infinite
    intercept, constant columns a coefficient of 0.
    """
    names, aims = ([f"{x}{k}" for k in range(len(some))] for x, some in (("f", features), ("t", targets)))
    values = [F.col(c).cast("double").alias(n) for c, n in zip(features, names)]
    plain = df.select(*[t.cast("double").alias(n) for t, n in zip(targets, aims)], *values)
    found = plain.agg(
        F.count("*").alias("n"),
        *[F.count(c).alias(f"n{c}") for c in aims + names],
        *[F.avg(c).alias(f"m{c}") for c in aims + names],
        *[F.stddev_pop(c).alias(f"s{c}") for c in names],
        *[low(c).alias(f"{x}{c}") for c in aims for x, low in (("low", F.min), ("high", F.max))],
    ).first()
    if not all(found[f"n{t}"] for t in aims):
        raise ValueError("no rows to fit")
    means, deviations = (np.array([found[f"{x}{c}"] for c in names], dtype=float) for x in "ms")
    if any(found[f"n{c}"] < found["n"] for c in names) or not np.isfinite([*means, *deviations]).all():
        raise ValueError("missing or non-finite features")
    deviations[deviations == 0] = 1.0
    fits = {}
    intercepts = {}
    for k, (t, penalty) in enumerate(zip(aims, penalties)):
        low, high, rate = (found[f"{x}{t}"] for x in ("low", "high", "m"))
        if not 0 <= low <= high <= 1:
            raise ValueError("labels outside 0 and 1")
        if low == high and low in (0.0, 1.0):
            intercepts[k] = float("inf") if low else float("-inf")
        else:
            ridge = np.r_[np.array(penalty, dtype=float) / deviations**2, 0.0]
            fits[k] = _Newton(found[f"n{t}"], ridge, np.r_[np.zeros(len(names)), np.log(rate / (1 - rate))])
    for _ in range(max_iter):
        still = [k for k, fit in fits.items() if not fit.done]
        if not still:
            break
        run = _curvature([fits[k].at for k in still], means, deviations)
        sums = plain.select(*[aims[k] for k in still], *names).mapInArrow(run, "sums array<double>").collect()
        for k, total in zip(still, np.sum([r["sums"] for r in sums], axis=0).reshape(len(still), -1)):
            fits[k].move(total)
    models = []
    for k in range(len(targets)):
        at = fits[k].at if k in fits else np.zeros(len(names) + 1)
        slopes = at[:-1] / deviations
        models.append(LinearModel(dict(zip(features, map(float, slopes))), intercepts.get(k, float(at[-1] - slopes @ means))))
    return models


class _Newton:
    """Where a fit has come to: coefficients of the standardised columns and the intercept."""

    def __init__(self, n: int, ridge: np.ndarray, at: np.ndarray):
        self.n, self.ridge, self.at = n, ridge, at
        self.best, self.step, self.done = None, None, False

    def move(self, total: np.ndarray) -> None:
        """One step by the sums of a pass at the present place."""
        width = len(self.at)
        loss = total[0] + self.ridge @ self.at**2 / 2
        # a hair of rounding is no rise
        if self.best is not None and not loss <= self.best * (1 + 1e-12):
            self.step = self.step / 2
            self.at = self.at - self.step
            self.done = bool(np.abs(self.step).max() < 1e-12)
            return
        slope = total[1 : width + 1] + self.ridge * self.at
        curvature = total[width + 1 :].reshape(width, width) + np.diag(self.ridge)
        self.best, self.step = loss, _newton_step(slope, curvature)
        self.at = self.at + self.step
        self.done = bool(-slope @ self.step / 2 <= LAST_STEP * self.n)


def _newton_step(slope: np.ndarray, curvature: np.ndarray) -> np.ndarray:
    """The step to the lowest point of the parabola; directions without curvature are left out, as of equal columns."""
    size = np.sqrt(np.diag(curvature))
    size[size == 0] = 1.0
    return -(np.linalg.pinv(curvature / np.outer(size, size), rcond=1e-12, hermitian=True) @ (slope / size)) / size


def _curvature(places: Sequence[np.ndarray], means: np.ndarray, deviations: np.ndarray):
    """Loss, slopes and curvatures of a task's rows at the place of each fit, as one list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, fits = len(means) + 1, len(places)
        loss, slope, curvature = np.zeros((fits, 1)), np.zeros((fits, width)), np.zeros((fits, width, width))
        for batch in batches:
            x = np.ones((width, batch.num_rows))
            for k in range(width - 1):
                x[k] = (np.asarray(batch.column(fits + k)) - means[k]) / deviations[k]
            for k, at in enumerate(places):
                y, mine = np.asarray(batch.column(k), dtype=float), x
                if batch.column(k).null_count:
                    has = ~np.isnan(y)
                    y, mine = y[has], x[:, has]
                margin = at @ mine
                falls = np.exp(-np.abs(margin))
                p = np.where(margin >= 0, 1.0, falls) / (1 + falls)
                loss[k] += np.sum(np.maximum(margin, 0) + np.log1p(falls) - y * margin)
                slope[k] += mine @ (p - y)
                curvature[k] += (mine * (p * (1 - p))) @ mine.T
        sums = np.concatenate([loss, slope, curvature.reshape(fits, -1)], axis=1).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([sums], pa.list_(pa.float64()))], names=["sums"])

    return run


def feature_importance(
    spark: SparkSession, df: DataFrame, features: Sequence[str], label: str = "bad", top_n: int = 20
) -> DataFrame:
    """Features by absolute coefficient of a logistic fit."""
    return top_coefficients(fit_logistic(df, features, label).table(spark), top_n)
