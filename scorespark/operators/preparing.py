"""Imputing, one-hot encoding and scaling: fitted on chosen rows, applied to all.

``fit_on`` names the split the parameters are learned from ("train" by default);
``fit_on="all"`` uses every row. Fitted parameters are a few numbers per column,
so they become literals of the plan and applying them needs no join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorespark.functions.intervals import double_literal, quoted
from scorespark.operators.quantiles import exact_medians
from scorespark.operators.running import running_totals
from scorespark.session import stage, values_table
from scorespark.spec import DEFAULT_SPEC, FeatureSpec

MISSING = "missing"
MAX_LEVELS = 1000


def fit_rows(df: DataFrame, fit_on: str) -> DataFrame:
    return df if fit_on == "all" else df.where(F.col("split") == fit_on)


@dataclass(frozen=True)
class Imputer:
    medians: Mapping[str, float | None]
    categorical: tuple[str, ...] = ()

    def apply(self, df: DataFrame) -> DataFrame:
        filled = {
            c: F.expr(f"coalesce({quoted(c)}, {double_literal(m)})")
            for c, m in self.medians.items()
            if m is not None and c in df.columns
        }
        filled.update(
            {c: F.coalesce(F.col(c), F.lit(MISSING)) for c in self.categorical if c in df.columns}
        )
        return df.withColumns(filled) if filled else df


def fit_imputer(
    df: DataFrame,
    spec: FeatureSpec = DEFAULT_SPEC,
    fit_on: str = "train",
    columns: Sequence[str] | None = None,
    categorical: bool = True,
) -> Imputer:
    """Exact medians of the numeric features; text features get a level of their own."""
    numeric = spec.numeric(df) if columns is None else list(columns)
    names = tuple(spec.categorical(df)) if categorical else ()
    return Imputer(exact_medians(fit_rows(df, fit_on), numeric), names)


@dataclass(frozen=True)
class OneHot:
    """Levels that become 0/1 columns, per source column (first level left out)."""

    levels: Mapping[str, tuple[str, ...]]

    def names(self) -> list[str]:
        return [f"{c}_{level}" for c, kept in self.levels.items() for level in kept]

    def apply(self, df: DataFrame) -> DataFrame:
        dummies = {
            f"{c}_{level}": F.coalesce((F.col(c) == F.lit(level)).cast("int"), F.lit(0))
            for c, kept in self.levels.items()
            for level in kept
        }
        return df.withColumns(dummies).drop(*self.levels)


def fit_onehot(
    df: DataFrame,
    spec: FeatureSpec = DEFAULT_SPEC,
    fit_on: str = "train",
    columns: Sequence[str] | None = None,
    max_levels: int = MAX_LEVELS,
) -> OneHot:
    """Levels seen in the fitting rows, in lexicographic order, without the first.

    Rows with an unseen level or NULL get zeros everywhere. A column with more
    than ``max_levels`` levels is refused: every level becomes a column.
    """
    names = spec.categorical(df) if columns is None else list(columns)
    rows = fit_rows(df, fit_on)
    levels = {}
    for c in names:
        found = rows.where(F.col(c).isNotNull()).select(c).distinct().limit(max_levels + 1).collect()
        if len(found) > max_levels:
            raise ValueError(f"column '{c}' has more than {max_levels} levels; use fit_sparse_onehot")
        levels[c] = tuple(sorted(r[0] for r in found)[1:])
    return OneHot(levels)


@dataclass(frozen=True)
class SparseOneHot:
    """Level numbers as a table ``(column, level, number)``; number 0 is the level left out."""

    columns: tuple[str, ...]
    sizes: tuple[int, ...]
    dictionary: DataFrame
    output: str

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with all columns' levels side by side in one sparse vector.

        Each column is joined with its part of the dictionary, which the optimiser broadcasts only
        while it is small; a level with most of the rows is split like any skewed join.
        """
        names, encoded, out = df.columns, [], df
        for k, (c, size) in enumerate(zip(self.columns, self.sizes)):
            if not size:
                continue
            own = self.dictionary.where(F.col("column") == k).select(F.col("level").alias(f"_{k}_level"), F.col("number").alias(f"_{k}_number"))
            out = out.join(own, out[c].cast("string") == own[f"_{k}_level"], "left")
            # the place behind the last one stands for unseen levels, NULL and the level left out
            place = F.when(F.col(f"_{k}_number") > 0, F.col(f"_{k}_number")).otherwise(size).cast("double")
            out = out.withColumn(f"_{k}_at", place).drop(f"_{k}_level", f"_{k}_number")
            encoded.append((k, size))
        if not encoded:
            return out.withColumn(self.output, F.lit(None))
        # the encoder learns the width of a column from one row that holds its last place
        widths = values_table(df.sparkSession, [[float(n) for _, n in encoded]], ", ".join(f"_{k}_at double" for k, _ in encoded))
        at, vectors = [f"_{k}_at" for k, _ in encoded], [f"_{k}_vector" for k, _ in encoded]
        encoder = OneHotEncoder(inputCols=at, outputCols=vectors, dropLast=True).fit(widths)
        joined = VectorAssembler(inputCols=vectors, outputCol=self.output).transform(encoder.transform(out))
        return joined.select(*names, self.output)


def fit_sparse_onehot(
    df: DataFrame, columns: Sequence[str], fit_on: str = "train", output: str = "onehot"
) -> SparseOneHot:
    """One-hot encoding of columns with any number of levels, as one sparse vector.

    Levels are numbered in lexicographic order; a level's number is its place in its column's part
    of the vector. The first one is left out (place 0 is always 0); unseen levels and NULL
    are zeros everywhere. The numbers come from range partitions of the
    distinct levels and the offsets of the partitions; no list of levels is on the
    driver and no column per level is made.
    """
    parts = [F.struct(F.lit(k).alias("column"), F.col(c).cast("string").alias("level")) for k, c in enumerate(columns)]
    levels = fit_rows(df, fit_on).select(F.inline(F.array(*parts))).where(F.col("level").isNotNull()).distinct()
    placed = running_totals(levels.withColumn("one", F.lit(1).cast("long")), ["column"], "level", ["one"])
    numbered = placed.select("column", "level", (F.col("one_upto") - 1).alias("number"), F.col("one_total").alias("size"))
    dictionary = stage(numbered, "levels")
    sizes = {r["column"]: r["size"] for r in dictionary.groupBy("column").agg(F.max("size").alias("size")).collect()}
    return SparseOneHot(tuple(columns), tuple(sizes.get(k, 0) for k in range(len(columns))), dictionary, output)


@dataclass(frozen=True)
class Scaler:
    means: Mapping[str, float]
    deviations: Mapping[str, float]

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                c: F.expr(
                    f"({quoted(c)} - {double_literal(self.means[c])}) / {double_literal(self.deviations[c])}"
                )
                for c in self.means
                if c in df.columns
            }
        )


def fit_scaler(
    df: DataFrame,
    spec: FeatureSpec = DEFAULT_SPEC,
    fit_on: str = "train",
    columns: Sequence[str] | None = None,
) -> Scaler:
    """Mean and population standard deviation; a constant column keeps deviation 1."""
    names = spec.numeric(df) if columns is None else list(columns)
    row = (
        fit_rows(df, fit_on)
        .agg(
            *[F.avg(c).alias(f"m:{c}") for c in names],
            *[F.stddev_pop(c).alias(f"s:{c}") for c in names],
        )
        .first()
    )
    return Scaler(
        {c: 0.0 if row[f"m:{c}"] is None else row[f"m:{c}"] for c in names},
        {c: row[f"s:{c}"] or 1.0 for c in names},
    )


def grouped_scaling(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """Mean and deviation per column of the rows *outside* each group (``group, column``).

    These are the scalers a cross-validated model fits, one per fold, from one
    pass over the data: sums per fold are subtracted from the overall sums.
    """
    measures = []
    for c in columns:
        measures += [
            F.avg(c).alias(f"{c}|mean"),
            F.var_pop(c).alias(f"{c}|var"),
            F.count(c).alias(f"{c}|n"),
        ]
    per_fold = df.groupBy(group).agg(*measures)
    long = per_fold.select(
        group,
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("feature"),
                        F.col(f"{c}|mean").alias("mean"),
                        F.col(f"{c}|var").alias("var"),
                        F.col(f"{c}|n").alias("n"),
                    )
                    for c in columns
                ]
            )
        ),
    )
    # centred moments of the other groups are merged, never squares of means subtracted
    every = Window.partitionBy("feature")
    others = long.withColumn("parts", F.collect_list(F.struct(group, "mean", "var", "n")).over(every)).withColumn(
        "parts", F.filter("parts", lambda x: (x[group] != F.col(group)) & (x["n"] > 0))
    )
    zero = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def merged(acc, x):
        n = acc["n"] + x["n"]
        step = x["mean"] - acc["mean"]
        return F.struct(
            n.alias("n"),
            (acc["mean"] + step * x["n"] / n).alias("mean"),
            (acc["m2"] + x["var"] * x["n"] + step * step * acc["n"] * x["n"] / n).alias("m2"),
        )

    long = others.withColumn("rest", F.aggregate("parts", zero, merged))
    rest_mean = F.when(F.col("rest.n") > 0, F.col("rest.mean"))
    variance = F.col("rest.m2") / F.col("rest.n")
    return long.select(
        group,
        "feature",
        rest_mean.alias("mean"),
        F.when(variance > 0, F.sqrt(variance)).otherwise(1.0).alias("deviation"),
    )
