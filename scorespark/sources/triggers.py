"""Retrains that alerts start exactly once.

An alert is named by its period and column. The first to see it reserves a version and writes
that number into the alert's file, which can be made only once; the retrained model is
then committed under that number. A run that breaks off in between is taken up by the next one
with the same number, and alerts whose version is committed start nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession

from scorespark.session import values_table
from scorespark.sources.commits import create_once, names, read_once
from scorespark.sources.registry import register_model, reserve_version, versions

TRIGGERS = "name string, version int"


@dataclass(frozen=True)
class Retrained:
    """What a retrain hands to the registry."""

    model: object
    auc: float
    ks: float
    data_hash: str
    gate: DataFrame | None = None


def trigger_name(period: str, column: str) -> str:
    return quote(f"{period}|{column}", safe="")


def retrain_on(spark: SparkSession, root: str, alerts: DataFrame, retrain: Callable[[str, str], Retrained]) -> list[int]:
    """Register one new version for every alert ``(period, column)`` that has none; the new versions.

    Alerts are one row per closed period and monitored column. A model that its gate refuses
    leaves the alert open.
    """
    new = []
    done = {r["version"] for r in versions(spark, root).select("version").collect()}
    for period, column in sorted(set(map(tuple, alerts.select("period", "column").collect()))):
        place = f"{root}/triggers/{trigger_name(period, column)}"
        told = read_once(spark, place)
        if told is None:
            create_once(spark, place, str(reserve_version(spark, root)))
            told = read_once(spark, place)
        number = int(told)
        if number in done:
            continue
        found = retrain(period, column)
        register_model(
            found.model, root, found.auc, found.ks, found.data_hash, trigger_name(period, column), gate=found.gate, number=number
        )
        new.append(number)
    return new


def triggers(spark: SparkSession, root: str) -> DataFrame:
    """(name, version) of all alerts that have started a retrain."""
    folder = f"{root}/triggers"
    return values_table(spark, [(n, int(read_once(spark, f"{folder}/{n}"))) for n in names(spark, folder)], TRIGGERS)
