"""Exact tree attributions for forests and boosted trees.

A leaf depends on a row only through which of its path's features satisfy all
their tests. For every such pattern the attributions come from one polynomial per
feature, whose coefficients group the feature subsets by size. Where a path has fewer
patterns than the batch has rows, all of them are worked out and rows look theirs up;
longer paths take only the patterns that occur, so any depth works. The driver
only reads the fitted trees.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorespark.session import scratch_path

#: Features of a path up to which the attributions of all patterns are listed.
TABLE = 8


@dataclass(frozen=True)
class Leaf:
    """Interval tests per path feature, the share of rows that pass each, and the leaf's value."""

    features: np.ndarray  # m feature numbers
    low: np.ndarray  # value > low ...
    high: np.ndarray  # ... and value <= high
    cover: np.ndarray
    value: float


def pattern_attributions(holds: np.ndarray, cover: np.ndarray, value: float) -> np.ndarray:
    """Attribution of each path feature (columns) for rows of tests that hold or not.

    The product of ``cover + holds * t`` over the other features has, as the
    coefficient of ``t ** s``, the sum over all subsets of size s.
    """
    rows, m = holds.shape
    out = np.empty((rows, m))
    weights = np.array([factorial(s) * factorial(m - 1 - s) / factorial(m) for s in range(m)])
    for j in range(m):
        sums = np.zeros((rows, m))
        sums[:, 0] = 1.0
        for k in range(m):
            if k != j:
                sums[:, 1:] = sums[:, 1:] * cover[k] + sums[:, :-1] * holds[:, k, None]
                sums[:, 0] *= cover[k]
        out[:, j] = value * (holds[:, j] - cover[j]) * (sums @ weights)
    return out


def _leaves_of(nodes: dict, value_of, count_of, weight: float) -> Iterator[Leaf]:
    """Leaves of one tree; a path maps feature -> (low, high, cover)."""
    waiting: list[tuple[int, dict]] = [(0, {})]
    while waiting:
        number, path = waiting.pop()
        node = nodes[number]
        if node["leftChild"] < 0:
            names = sorted(path)
            low, high, cover = (np.array([path[f][i] for f in names]) for i in range(3))
            yield Leaf(np.array(names, dtype=int), low, high, cover, value_of(node) * weight)
            continue
        feature, threshold = node["split"]["featureIndex"], node["split"]["leftCategoriesOrThreshold"][0]
        low, high, cover = path.get(feature, (-np.inf, np.inf, 1.0))
        for child, bounds in (
            (node["leftChild"], (low, min(high, threshold))),
            (node["rightChild"], (max(low, threshold), high)),
        ):
            share = count_of(nodes[child]) / count_of(node)
            waiting.append((child, {**path, feature: (*bounds, cover * share)}))


def explain_leaves(spark, model) -> tuple[list[Leaf], float]:
    """All leaves of the ensemble and the base value.

    A forest is explained on the class-1 probability, boosted trees on the raw
    margin. The trees are read from the saved model, one row per node.
    """
    path = scratch_path(spark, "trees")
    model.write().save(path)
    trees: dict[int, dict] = {}
    for row in spark.read.parquet(f"{path}/data").select("treeID", "nodeData").toLocalIterator():
        node = row["nodeData"].asDict(recursive=True)
        trees.setdefault(row["treeID"], {})[node["id"]] = node
    weights = list(model.treeWeights)
    if type(model).__name__.startswith("GBT"):
        value_of, count_of = lambda n: n["prediction"], lambda n: n["impurityStats"][0]
    else:
        weights = [w / sum(weights) for w in weights]
        value_of, count_of = lambda n: n["impurityStats"][1] / sum(n["impurityStats"]), lambda n: sum(n["impurityStats"])
    leaves = [leaf for k in sorted(trees) for leaf in _leaves_of(trees[k], value_of, count_of, weights[k])]
    return leaves, float(sum(leaf.value * np.prod(leaf.cover) for leaf in leaves))


def attributions(values: np.ndarray, leaves: Sequence[Leaf]) -> np.ndarray:
    """Attribution matrix of a batch of rows."""
    out = np.zeros(values.shape)
    for leaf in leaves:
        if not len(leaf.features):
            continue
        x = values[:, leaf.features]
        holds = (x > leaf.low) & (x <= leaf.high)
        m = len(leaf.features)
        if m <= TABLE and 2**m <= len(values):
            every = (np.arange(2**m)[:, None] >> np.arange(m)) & 1
            found = pattern_attributions(every.astype(float), leaf.cover, leaf.value)
            out[:, leaf.features] += found[holds @ (1 << np.arange(m))]
            continue
        code = np.packbits(holds, axis=1).astype(np.int64)
        key = code @ (256 ** np.arange(code.shape[1]))
        _, first, which = np.unique(key, return_index=True, return_inverse=True)
        found = pattern_attributions(holds[first].astype(float), leaf.cover, leaf.value)
        out[:, leaf.features] += found[which]
    return out


def tree_shap(model, df: DataFrame, features: Sequence[str], key: str = "dummy_id") -> DataFrame:
    """Long attributions ``(key, feature, value, phi)`` and the base value as ``base``."""
    names = list(features)
    leaves, base = explain_leaves(df.sparkSession, model)
    shared = df.sparkSession.sparkContext.broadcast(leaves)
    schema = f"`{key}` {df.schema[key].dataType.simpleString()}, value array<double>, phi array<double>"

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = batch[names].to_numpy(dtype=float)
            phi = attributions(values, shared.value)
            yield pd.DataFrame({key: batch[key], "value": list(values), "phi": list(phi)})

    wide = df.select(key, *[F.col(c).cast("double").alias(c) for c in names]).mapInPandas(explain, schema)
    zipped = F.arrays_zip(F.array(*[F.lit(c) for c in names]).alias("feature"), F.col("value"), F.col("phi"))
    return (
        wide.select(key, F.explode(zipped).alias("z"))
        .select(key, F.col("z.feature"), F.col("z.value"), F.col("z.phi"))
        .withColumn("base", F.lit(base))
    )
