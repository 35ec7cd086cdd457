"""Versioned models: a folder per attempt and append-only commit records.

A number is claimed by creating its claim file, which only one process can. The model is
saved into a folder of its own, and one commit record, again created once, makes the
version known and names that folder. An attempt that breaks off leaves a claim and
perhaps a folder, never a version. ``promotions`` are numbered records of the same kind;
the current model is the version of the latest one, so promoting - or going back - only
adds a record.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from scorespark.session import values_table
from scorespark.sources.artefacts import load_artefact, save_artefact
from scorespark.sources.commits import create_once, names

VERSIONS = (
    "version int, trained_at timestamp, code_revision string, data_hash string, auc double, ks double, folder string"
)
PROMOTIONS = "version int, promoted_at timestamp"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return values_table(spark, [], schema)


def versions(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, f"{root}/versions", VERSIONS)


def promotions(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, f"{root}/promotions", PROMOTIONS)


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


def _numbered(spark: SparkSession, folder: str, text: str, ending: str = "") -> int:
    """Create the file of the next free number in ``folder``."""
    taken = [int(n.removesuffix(ending)) for n in names(spark, folder)]
    number = max(taken, default=0) + 1
    while not create_once(spark, f"{folder}/{number}{ending}", text):
        number += 1
    return number


def reserve_version(spark: SparkSession, root: str) -> int:
    """A version number that nobody else has or will get, also not another process at the same time."""
    return _numbered(spark, f"{root}/claims", _now())


def register_model(
    model,
    root: str,
    auc: float,
    ks: float,
    data_hash: str,
    code_revision: str = "",
    gate: DataFrame | None = None,
    number: int | None = None,
) -> int:
    """Save ``model`` under a new version and record its figures.

    ``model`` is a :class:`PipelineModel` or any fitted part or scorer that
    :mod:`scorespark.sources.artefacts` can save. With ``gate``, a one-row table with
    ``passed``, a model that fails is refused and nothing is written. ``number`` is a
    version reserved before; if it has been committed meanwhile, that record stands.
    """
    spark = SparkSession.active()
    if gate is not None and not gate.first()["passed"]:
        raise ValueError("the model does not pass the validation gate")
    number = reserve_version(spark, root) if number is None else number
    kind = "pipeline" if isinstance(model, PipelineModel) else "artefact"
    folder = f"v{number}/{kind}-{uuid.uuid4().hex}"
    if kind == "pipeline":
        model.write().save(f"{root}/{folder}")
    else:
        save_artefact(spark, model, f"{root}/{folder}")
    record = {
        "version": number,
        "trained_at": _now(),
        "code_revision": code_revision,
        "data_hash": data_hash,
        "auc": float(auc),
        "ks": float(ks),
        "folder": folder,
    }
    create_once(spark, f"{root}/versions/{number}.json", json.dumps(record))
    return number


def promote(spark: SparkSession, root: str, version: int) -> None:
    """Make a registered version the current one."""
    if versions(spark, root).where(F.col("version") == version).isEmpty():
        raise LookupError(f"version {version} is not registered")
    record = json.dumps({"version": version, "promoted_at": _now()})
    _numbered(spark, f"{root}/promotions", record, ".json")


def current_version(promoted: DataFrame) -> DataFrame:
    """The version of the latest promotion; at equal times the higher version."""
    return promoted.agg(
        F.max_by("version", F.struct("promoted_at", "version")).alias("version"),
        F.max("promoted_at").alias("promoted_at"),
    )


def promoted_version(spark: SparkSession, root: str) -> int:
    version = current_version(promotions(spark, root)).first()["version"]
    if version is None:
        raise LookupError("no model has been promoted")
    return version


def load_version(spark: SparkSession, root: str, version: int):
    """A registered model: a pipeline, or the fitted part or scorer that was registered."""
    found = versions(spark, root).where(F.col("version") == version).first()
    if found is None:
        raise LookupError(f"version {version} is not registered")
    path = f"{root}/{found['folder']}"
    return PipelineModel.load(path) if "/pipeline-" in path else load_artefact(spark, path)


def load_current(spark: SparkSession, root: str):
    """The promoted model."""
    return load_version(spark, root, promoted_version(spark, root))
