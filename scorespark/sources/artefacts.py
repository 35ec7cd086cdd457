"""Fitted parts of a scorecard, and the whole scorer, as JSON documents on shared storage."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, fields, is_dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorespark.models.calibration import Calibrated, CalibratedEnsemble, Isotonic, OnLogOdds, Sigmoid
from scorespark.models.trees import Trees
from scorespark.operators.bands import BinEdges, ScoreBands
from scorespark.operators.preparing import Imputer, OneHot, Scaler
from scorespark.operators.scorecard import LinearModel, score_population
from scorespark.session import values_table


@dataclass(frozen=True)
class Scorer:
    """Everything from a raw applicant row to probability, score and band."""

    imputer: Imputer
    model: LinearModel | CalibratedEnsemble | Trees | Calibrated
    bands: ScoreBands
    encoder: OneHot | None = None
    scaler: Scaler | None = None

    def apply(self, df: DataFrame) -> DataFrame:
        """Rows with ``pd``, ``score`` and ``band``; row-wise expressions only, also on streams."""
        df = self.imputer.apply(df)
        for step in (self.encoder, self.scaler):
            df = step.apply(df) if step else df
        return self.bands.apply(score_population(df, self.model.pd()))


_KINDS = {
    c.__name__: c
    for c in (
        Imputer, OneHot, Scaler, LinearModel, Sigmoid, CalibratedEnsemble, Isotonic, OnLogOdds, Calibrated, Trees, BinEdges, ScoreBands, Scorer
    )
}


def _plain(value):
    if is_dataclass(value):
        return {"is": type(value).__name__, "of": {f.name: _plain(getattr(value, f.name)) for f in fields(value)}}
    if isinstance(value, Mapping):
        return {"is": "map", "of": [[k, _plain(v)] for k, v in value.items()]}
    if isinstance(value, list | tuple):
        return [_plain(v) for v in value]
    return value


def _fitted(value):
    if isinstance(value, list):
        return tuple(_fitted(v) for v in value)
    if not isinstance(value, dict):
        return value
    if value["is"] == "map":
        return {k: _fitted(v) for k, v in value["of"]}
    return _KINDS[value["is"]](**{k: _fitted(v) for k, v in value["of"].items()})


def save_artefact(spark: SparkSession, fitted, path: str) -> None:
    """Write a fitted part; an existing folder is an error."""
    if type(fitted).__name__ not in _KINDS:
        raise TypeError(f"cannot save a {type(fitted).__name__}")
    values_table(spark, [(json.dumps(_plain(fitted)),)], "value string").coalesce(1).write.text(path)


def load_artefact(spark: SparkSession, path: str):
    """Inverse of :func:`save_artefact`."""
    return _fitted(json.loads("\n".join(r[0] for r in spark.read.text(path).collect())))


def load_isotonic(path: str) -> Isotonic:
    """A saved isotonic curve."""
    return load_artefact(SparkSession.active(), path)


def scored(df: DataFrame, scorer: Scorer, version: int) -> DataFrame:
    """Batch or stream of applicants scored by one version of the scorer."""
    return scorer.apply(df).withColumn("model_version", F.lit(version))
