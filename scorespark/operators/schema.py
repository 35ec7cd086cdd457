"""Column names, column roles and type checks (schema-only, no job is run)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorespark.spec import DEFAULT_SPEC, FeatureSpec


def tidy_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def clean_column_names(df: DataFrame) -> DataFrame:
    """Trim and lower-case names, blanks to underscores; two equal results are an error."""
    names = [tidy_name(c) for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"column names collide after cleaning: {twice}")
    return df.toDF(*names)


def remove_ids(df: DataFrame, spec: FeatureSpec = DEFAULT_SPEC) -> DataFrame:
    """Drop the identifier columns by exact name."""
    return df.drop(*spec.ids)


def remove_leakage(df: DataFrame, spec: FeatureSpec = DEFAULT_SPEC) -> DataFrame:
    """Drop the columns that were observed after the decision."""
    return df.drop(*spec.leakage)


def drop_ids_and_leakage(df: DataFrame, spec: FeatureSpec = DEFAULT_SPEC) -> DataFrame:
    return df.drop(*spec.ids, *spec.leakage)


def split_xy(df: DataFrame, spec: FeatureSpec = DEFAULT_SPEC) -> DataFrame:
    """Key, label and features of each row, with the features in one struct."""
    return df.select(spec.key, spec.target, F.struct(*spec.features(df)).alias("features"))


def select_numeric(
    df: DataFrame, spec: FeatureSpec = DEFAULT_SPEC, max_features: int | None = None
) -> DataFrame:
    """Key, label and the numeric features; ``max_features`` keeps the first ones."""
    names = spec.numeric(df)
    if not names:
        raise ValueError("no numeric features available")
    keep = [c for c in (*spec.ids, spec.target, *spec.reserved) if c in df.columns]
    return df.select(*keep, *names[:max_features])


def ensure_numeric(df: DataFrame, spec: FeatureSpec = DEFAULT_SPEC) -> DataFrame:
    """Return ``df`` if all its features are numeric, else raise with the offenders."""
    offenders = spec.categorical(df)
    if offenders:
        raise ValueError(f"columns that are not numeric: {offenders}")
    return df


def ensure_target(df: DataFrame, spec: FeatureSpec = DEFAULT_SPEC) -> DataFrame:
    if spec.target not in df.columns:
        raise ValueError(f"label column '{spec.target}' is missing")
    return df


def coerce_numeric(df: DataFrame, columns: Sequence[str], fill: float = 0.0) -> DataFrame:
    """Read the columns as doubles; what is not a number, or missing, becomes ``fill``."""
    return df.withColumns(
        {c: F.coalesce(F.expr(f"try_cast(`{c}` AS double)"), F.lit(fill)) for c in columns}
    )


def fill_constant(df: DataFrame, columns: Sequence[str], value: float = 0.0) -> DataFrame:
    return df.na.fill(value, subset=list(columns))


def reindex_columns(
    df: DataFrame, columns: Mapping[str, T.DataType] | T.StructType, keep: Iterable[str] = ()
) -> DataFrame:
    """Exactly the named columns: missing ones are 0, further ones are dropped."""
    if isinstance(columns, T.StructType):
        columns = {f.name: f.dataType for f in columns.fields}
    present = set(df.columns)
    aligned = [
        (F.col(c) if c in present else F.lit(0)).cast(kind).alias(c) for c, kind in columns.items()
    ]
    return df.select(*keep, *aligned)


def nan_to_null(df: DataFrame) -> DataFrame:
    """One marker for a missing value: NaN becomes NULL in every fractional column."""
    fractional = [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    ]
    if not fractional:
        return df
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in fractional})
