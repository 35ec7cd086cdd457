"""Forests grown in shared passes: the same trees however the rows lie, cuts at rare values, odd rows refused."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from scorespark.models import benchmarks as bm
from scorespark.models import forests as fo
from scorespark.models import together as tg
from scorespark.models.trees import trees_of
from scorespark.operators.quantiles import exact_quantiles


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(11)
    a, b, c = rng.normal(size=4000), rng.integers(0, 6, 4000).astype(float), (rng.random(4000) < 0.99).astype(float)
    bad = ((a + b > 3) | (c == 0)).astype(int)
    pdf = pd.DataFrame({"dummy_id": range(4000), "a": a, "b": b, "c": c, "bad": bad})
    return pdf, spark.createDataFrame(pdf)


def test_trees_do_not_depend_on_partitions_or_order(spark, rows):
    _, df = rows
    some = trees_of(spark, bm.fit_forest(df.repartition(3, "a"), list("abc"), trees=6, depth=4), list("abc"))
    other = trees_of(spark, bm.fit_forest(df.orderBy("b", F.desc("a")).repartition(7), list("abc"), trees=6, depth=4), list("abc"))
    assert some == other


def test_a_group_of_trees_is_that_of_all_trees(spark, rows, monkeypatch):
    _, df = rows
    together = trees_of(spark, bm.fit_forest(df, list("abc"), trees=5, depth=3), list("abc"))
    monkeypatch.setattr(fo, "CELLS", 1)
    monkeypatch.setattr(fo, "COLLECTED", 0)
    monkeypatch.setattr(fo, "ROWS_A_TASK", 500)
    assert trees_of(spark, bm.fit_forest(df, list("abc"), trees=5, depth=3), list("abc")) == together


def test_tasks_that_hold_the_rows_grow_the_trees_of_passes(spark, rows, monkeypatch):
    _, df = rows
    fit = lambda: trees_of(spark, bm.fit_forest(df.repartition(5), list("abc"), trees=6, depth=4, min_leaf=3), list("abc"))
    passes, made = fo._grow, []
    monkeypatch.setattr(fo, "_grow", lambda *x: made.append(1) or passes(*x))
    monkeypatch.setattr(fo, "PIECE", 256)
    monkeypatch.setattr(tg, "ROWS_A_TASK", 1000)
    held = fit()
    assert not made  # all trees in one job
    monkeypatch.setattr(tg, "HELD_BYTES", 1 << 10)
    assert fit() == held and made == [1]


def test_nodes_hold_the_drawn_rows(spark, rows):
    """Every node's counts are those of the rows that a plain walk brings there, weighed by their draws."""
    pdf, df = rows
    model = bm.fit_forest(df, list("abc"), trees=2, depth=3, min_leaf=40)
    h = np.array([r[0] for r in df.select(F.xxhash64("dummy_id", "a", "b", "c")).collect()])
    words = fo.row_words(h, 0, 42).view(np.uint16).reshape(-1, 4)
    for k, tree in enumerate(model.trees):
        drawn = fo._DRAWS[words[:, k]].astype(int)
        waiting = [(tree._call_java("rootNode"), np.ones(len(pdf), dtype=bool))]
        while waiting:
            node, here = waiting.pop()
            bad = int(drawn[here & (pdf.bad == 1).to_numpy()].sum())
            n = int(drawn[here].sum())
            assert list(node.impurityStats().stats()) == [n - bad, bad] and n >= 40
            if node.subtreeDepth():
                left = (pdf[list("abc")].to_numpy()[:, node.split().featureIndex()] <= node.split().threshold()) & here
                waiting += [(node.leftChild(), left), (node.rightChild(), here & ~left)]


def test_rare_values_can_be_cut_off(spark, rows):
    """c is 0 in a hundredth of the rows, which no quantile but the least shows."""
    _, df = rows
    tree = trees_of(spark, bm.fit_forest(df, ["c"], trees=1, depth=1), ["c"])
    assert tree.at[0] == 0 and tree.threshold[0] == 0.5


def test_odd_rows(spark, rows):
    _, df = rows
    with pytest.raises(Exception, match="missing values"):
        bm.fit_forest(df.withColumn("a", F.when(F.col("dummy_id") != 5, F.col("a"))), list("abc"), trees=1)
    with pytest.raises(Exception, match="other than 0 and 1"):
        bm.fit_forest(df.withColumn("bad", F.when(F.col("dummy_id") != 5, F.col("bad"))), list("abc"), trees=1)
    with pytest.raises(ValueError, match="no rows"):
        bm.fit_forest(df.where("bad > 1"), list("abc"), trees=1)
    # one class, no key, repeated rows
    one = bm.fit_forest(df.where("bad = 1").drop("dummy_id").union(df.where("bad = 1").drop("dummy_id")), list("abc"), trees=2)
    assert [t.numNodes for t in one.trees] == [1, 1]
    assert {r.pd for r in bm.predict_pd(one, df, list("abc")).collect()} == {1.0}


def test_quantiles_over_several_stretches(spark):
    """Cells of several stretches of a column in one pass, negative numbers and ties, against numpy."""
    rng = np.random.default_rng(3)
    x = np.r_[rng.normal(size=3000), -rng.random(2000) * 1e6, np.zeros(500), np.full(700, 2.5)]
    df = spark.createDataFrame(pd.DataFrame({"x": x})).repartition(5)
    places = [k / 40 for k in range(41)]
    assert exact_quantiles(df, {"x": places}, limit=64)["x"] == pytest.approx(list(np.quantile(x, places)), rel=1e-12)
