"""Order keys and row digests that do not depend on partitioning or engine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def order_key(key: str | Column, seed: int) -> Column:
    """Pseudo-random but reproducible sort key of a row: hex md5 of ``key:seed``."""
    column = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat_ws(":", column.cast("string"), F.lit(str(seed))).cast("binary"))


def double_text(column: Column) -> Column:
    """All bits of a double as ``sign mantissa p exponent``; zero has one sign and NaN one form."""
    size = F.abs(column)
    power = F.floor(F.log2(size))
    scale = F.lit(52) - power
    half = F.floor(scale / 2)
    raw = size * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), scale - half)
    # the logarithm may be off by one next to a power of two
    up, down = raw >= 2.0**53, raw < 2.0**52
    mantissa = F.when(up, raw / 2).when(down, raw * 2).otherwise(raw)
    exponent = power + F.when(up, 1).when(down, -1).otherwise(0)
    sign = F.when(column < 0, "-").otherwise("")
    finite = F.concat(sign, mantissa.cast("bigint").cast("string"), F.lit("p"), exponent.cast("bigint").cast("string"))
    return (
        F.when(column == 0, "0")
        .when(F.isnan(column), "nan")
        .when(size == float("inf"), F.concat(sign, F.lit("inf")))
        .otherwise(finite)
    )


def canonical_text(df: DataFrame, columns: Sequence[str]) -> Column:
    """One string per row that no other row content has.

    Every field is written as its length, a colon and its text; NULL is ``n``.
    Fractions are written with all their bits.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    parts = []
    for name in columns:
        column = F.col(name)
        if isinstance(kinds[name], (T.DoubleType, T.FloatType)):
            column = double_text(column.cast("double"))
        text = column.cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("n")))
    return F.concat(*parts)


def digest60(text: Column) -> Column:
    """First 60 bits of the md5 as a non-negative bigint."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")
