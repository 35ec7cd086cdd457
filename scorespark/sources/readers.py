"""Reading raw applicant tables and checking them on arrival."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorespark.operators.schema import clean_column_names, nan_to_null
from scorespark.session import values_table


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def load_credit_data(
    spark: SparkSession, path: str, kind: str = "parquet", schema: T.StructType | None = None
) -> DataFrame:
    """Raw applicants with clean names and NULL as the only marker of a missing value.

    ``kind`` is parquet, orc, json or csv. CSV needs a declared ``schema``;
    inferring one would read the files twice.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    elif kind == "csv":
        raise ValueError("reading csv needs a declared schema")
    if kind == "csv":
        reader = reader.option("header", True)
    return nan_to_null(clean_column_names(reader.format(kind).load(path)))


def load_profile(df: DataFrame) -> DataFrame:
    """Rows and columns of a table."""
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def contract_violations(
    df: DataFrame,
    schema: T.StructType,
    min_rows: int = 1,
    key: str | None = None,
    allowed: Mapping[str, tuple] | None = None,
) -> DataFrame:
    """(rule, subject, found) for every broken rule; an empty table is a clean load.

    Schema rules are checked on the driver. Row rules - row count, key present,
    values within an ``allowed`` list - are one aggregate over the data. That a
    key is unique is checked by a distributed count per key.
    """
    spark = df.sparkSession
    actual = {f.name: f.dataType for f in df.schema.fields}
    broken = []
    for f in schema.fields:
        if f.name not in actual:
            broken.append(("column missing", f.name, 1))
        elif actual[f.name] != f.dataType:
            broken.append(("column type", f.name, 1))
    expected = {f.name for f in schema.fields}
    broken += [("column unexpected", c, 1) for c in actual if c not in expected]

    checks = {("too few rows", "table"): F.greatest(F.lit(min_rows) - F.count("*"), F.lit(0))}
    if key:
        checks[("key missing", key)] = F.count_if(F.col(key).isNull())
    for c, values in (allowed or {}).items():
        checks[("value not allowed", c)] = F.count_if(~F.col(c).isin(*values))
    rows = [
        F.struct(
            F.lit(rule).alias("rule"), F.lit(subject).alias("subject"), F.col(f"v{i}").alias("found")
        )
        for i, (rule, subject) in enumerate(checks)
    ]
    out = df.agg(
        *[v.cast("bigint").alias(f"v{i}") for i, v in enumerate(checks.values())]
    ).select(F.inline(F.array(*rows)))
    if key:
        repeated = (
            df.groupBy(key)
            .agg(F.count("*").alias("copies"))
            .agg(F.count_if(F.col("copies") > 1).alias("found"))
            .select(F.lit("key repeated").alias("rule"), F.lit(key).alias("subject"), "found")
        )
        out = out.unionByName(repeated)
    if broken:
        out = out.unionByName(
            values_table(spark, broken, "rule string, subject string, found bigint")
        )
    return out.where(F.col("found") > 0)
