"""Fitted tree ensembles as plain arrays: saved as JSON, scored on batches and streams."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from scorespark.session import scratch_path


@dataclass(frozen=True)
class Trees:
    """A forest or boosted trees over named columns.

    Nodes of all trees stand in one list; ``at`` is the feature a node tests, -1 in leaves. Values up
    to the threshold go left. Leaf values carry the tree's weight, so a row's leaves are summed
    up: to the probability (``logit`` False) or to half its log odds (True).
    """

    features: tuple[str, ...]
    roots: tuple[int, ...]
    at: tuple[int, ...]
    threshold: tuple[float, ...]
    left: tuple[int, ...]
    right: tuple[int, ...]
    value: tuple[float, ...]
    logit: bool

    def total(self, rows: np.ndarray) -> np.ndarray:
        """Sum of the leaves of each row; all rows go down a tree level by level."""
        at, left, right = (np.array(x, dtype=np.int32) for x in (self.at, self.left, self.right))
        threshold, value = np.array(self.threshold), np.array(self.value)
        every, out = np.arange(len(rows)), np.zeros(len(rows))
        for root in self.roots:
            node = np.full(len(rows), root)
            while True:
                feature = at[node]
                inner = feature >= 0
                if not inner.any():
                    break
                goes_left = rows[every, np.maximum(feature, 0)] <= threshold[node]
                node = np.where(inner, np.where(goes_left, left[node], right[node]), node)
            out += value[node]
        return out

    def pd(self) -> Column:
        """Probability of class 1; a row with a missing feature has none."""
        trees = self

        @F.pandas_udf("double")
        def score(*columns: pd.Series) -> pd.Series:
            rows = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            found = trees.total(rows)
            return pd.Series(np.where(np.isnan(rows).any(axis=1), np.nan, found)).where(lambda x: x.notna(), None)

        total = score(*[F.col(c).cast("double") for c in self.features])
        # worked out as Spark's boosted model does, to the last digit: steps of a curve stand at its values
        return 1 - 1 / (1 + F.exp(2 * total)) if self.logit else total


def trees_of(spark: SparkSession, model, features: Sequence[str]) -> Trees:
    """The arrays of a fitted forest or boosted classifier; its nodes are read on the driver."""
    path = scratch_path(spark, "trees")
    model.write().save(path)
    by_tree: dict[int, dict] = {}
    for row in spark.read.parquet(f"{path}/data").select("treeID", "nodeData").toLocalIterator():
        by_tree.setdefault(row["treeID"], {})[row["nodeData"]["id"]] = row["nodeData"]
    logit = type(model).__name__.startswith("GBT")
    weights = list(model.treeWeights)
    weights = weights if logit else [w / sum(weights) for w in weights]
    roots, at, threshold, left, right, value = [], [], [], [], [], []
    for number in sorted(by_tree):
        nodes = by_tree[number]
        place = {k: len(at) + n for n, k in enumerate(sorted(nodes))}
        roots.append(place[0])
        for k in sorted(nodes):
            node = nodes[k]
            leaf = node["leftChild"] < 0
            at.append(-1 if leaf else node["split"]["featureIndex"])
            threshold.append(0.0 if leaf else node["split"]["leftCategoriesOrThreshold"][0])
            left.append(-1 if leaf else place[node["leftChild"]])
            right.append(-1 if leaf else place[node["rightChild"]])
            share = node["prediction"] if logit else node["impurityStats"][1] / sum(node["impurityStats"])
            value.append(share * weights[number] if leaf else 0.0)
    return Trees(tuple(features), *map(tuple, (roots, at, threshold, left, right, value)), logit)
