"""Writing splits, report tables, metrics and dataset fingerprints."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorespark.functions.hashing import canonical_text, digest60
from scorespark.session import values_table

FORMATS = ("parquet", "orc", "json", "csv")


def save_splits(df: DataFrame, path: str, kind: str = "parquet", mode: str = "error") -> None:
    """One folder per split, so that reading one split prunes the others."""
    _writer(df.write.partitionBy("split"), kind, mode).save(path)


def write_report(df: DataFrame, path: str, kind: str = "csv", mode: str = "error") -> None:
    """A report table; csv gets a header line in each part file."""
    _writer(df.write, kind, mode).save(path)


def _writer(writer, kind, mode):
    if kind not in FORMATS:
        raise ValueError(f"unknown format '{kind}', expected one of {FORMATS}")
    if kind == "csv":
        writer = writer.option("header", True)
    return writer.format(kind).mode(mode)


def metrics_json(metrics: DataFrame, model: str = "model", values: Sequence[str] = ("auc", "gini", "ks")) -> DataFrame:
    """One JSON document ``{model: {measure: value}}`` from one row per model.

    The number of models is the number of names, so gathering them is bounded.
    """
    entries = F.collect_list(F.struct(F.col(model), F.struct(*values)))
    return metrics.agg(F.to_json(F.map_from_entries(F.array_sort(entries))).alias("json"))


def write_metrics_json(metrics: DataFrame, path: str, mode: str = "error", **names) -> None:
    metrics_json(metrics, **names).write.mode(mode).text(path)


def dataset_hash(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Fingerprint of the rows in any order: count, xor and sum of row digests.

    The xor alone would not see a row that is present twice; the sum does.
    """
    digest = digest60(canonical_text(df, columns or df.columns))
    return df.select(digest.alias("d")).agg(
        F.count("*").alias("n_rows"),
        F.bit_xor("d").alias("xor_digest"),
        F.sum(F.col("d").cast("decimal(28,0)")).cast("string").alias("sum_digest"),
    )


def save_parameters(params: Mapping[str, Mapping[str, float]], spark, path: str, mode: str = "error") -> None:
    """Fitted parameters as a table ``(kind, name, value)``."""
    rows = [
        (kind, name, None if value is None else float(value))
        for kind, values in params.items()
        for name, value in values.items()
    ]
    values_table(spark, rows, "kind string, name string, value double").write.mode(mode).parquet(path)


def load_parameters(spark, path: str) -> dict[str, dict[str, float]]:
    """Inverse of :func:`save_parameters` (a few rows per feature)."""
    params: dict[str, dict[str, float]] = {}
    for r in spark.read.parquet(path).collect():
        params.setdefault(r["kind"], {})[r["name"]] = r["value"]
    return params
