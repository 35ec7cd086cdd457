"""Boosting by passes over binned rows: Spark's trees where both see the same cuts, and the same trees however the rows lie."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from scorespark.models import benchmarks as bm
from scorespark.models import boosted as bo
from scorespark.models import forests
from scorespark.models import together as tg
from scorespark.models.logistic import assemble
from scorespark.models.trees import trees_of
from scorespark.session import scratch_path


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(12)
    a, b, c = rng.integers(0, 30, 3000) / 7, rng.integers(0, 9, 3000) - 4.0, rng.integers(0, 3, 3000) * 1.0
    bad = (rng.random(3000) < 1 / (1 + np.exp(-(a - 2 + 0.4 * b * c)))).astype(int)
    pdf = pd.DataFrame({"dummy_id": range(3000), "a": a, "b": b, "c": c, "bad": bad})
    return pdf, spark.createDataFrame(pdf)


def test_all_rows_give_the_trees_of_spark(spark, rows):
    """Few values a feature and no sampling: cuts, splits and leaves are those of Spark's own fit."""
    pdf, df = rows
    estimator = GBTClassifier(featuresCol="x", labelCol="bad", maxIter=10, maxDepth=3, stepSize=0.1, subsamplingRate=1.0, seed=1)
    ours, theirs = (trees_of(spark, m, list("abc")) for m in (bo.fit_boosted(df, list("abc"), estimator), estimator.fit(assemble(df, list("abc"), "bad"))))
    x = pdf[list("abc")].to_numpy()
    assert ours.at == theirs.at and ours.threshold == pytest.approx(theirs.threshold)
    np.testing.assert_allclose(ours.total(x), theirs.total(x), atol=1e-4)


def test_trees_do_not_depend_on_partitions_or_margins(spark, rows, monkeypatch):
    _, df = rows
    some = trees_of(spark, bm.fit_boosting(df.repartition(3, "a"), list("abc"), trees=5, depth=3), list("abc"))
    monkeypatch.setattr(bo, "MARGINS_EVERY", 2)
    monkeypatch.setattr(bo, "TASKS", 0)
    other = trees_of(spark, bm.fit_boosting(df.orderBy("b").repartition(7), list("abc"), trees=5, depth=3), list("abc"))
    assert some == other


def test_tasks_that_hold_the_rows_grow_the_trees_of_passes(spark, rows, monkeypatch):
    _, df = rows
    fit = lambda: trees_of(spark, bm.fit_boosting(df.repartition(5), list("abc"), trees=4, depth=3), list("abc"))
    passes, made = bo._grow, []
    monkeypatch.setattr(bo, "_grow", lambda *x: made.append(1) or passes(*x))
    monkeypatch.setattr(forests, "PIECE", 256)
    monkeypatch.setattr(tg, "ROWS_A_TASK", 1000)
    held = fit()
    assert not made  # all trees in one job
    monkeypatch.setattr(tg, "HELD_BYTES", 1 << 10)
    assert fit() == held and len(made) == 4


def test_rows_are_binned_once_for_forest_and_boosting(spark, rows, monkeypatch):
    _, df = rows
    small = ({"trees": 3, "depth": 3}, {"trees": 3, "depth": 2})
    alone = bm.fit_forest(df, list("abc"), **small[0]), bm.fit_boosting(df, list("abc"), **small[1])
    binned, made = bm.binned_table, []
    for module in (bm, bo, forests):
        monkeypatch.setattr(module, "binned_table", lambda *x: made.append(1) or binned(*x))
    for bytes_held in (tg.HELD_BYTES, 1 << 10):
        monkeypatch.setattr(tg, "HELD_BYTES", bytes_held)
        monkeypatch.setattr(bo, "MARGINS_EVERY", 2)
        both = bm.fit_both(df, list("abc"), "bad", "dummy_id", *small)
        assert [trees_of(spark, m, list("abc")) for m in both] == [trees_of(spark, m, list("abc")) for m in alone]
    assert len(made) == 2


def test_sums_go_by_the_driver_where_tasks_do_not_see_files(spark):
    def run(folder):
        def inner(batches):
            own = sum(np.asarray(b.column("id")).sum() for b in batches)
            exchange = tg.Exchange(folder)
            totals = [int(exchange.added(np.array([own, k]))[0]) for k in range(2)]
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (totals, exchange.by_files)], names=["totals", "files"])

        return inner

    for folder, files in ((f"file://{scratch_path(spark, 'sums')}", True), ("hdfs://nowhere/sums", False)):
        found = spark.range(100).repartition(3).mapInArrow(run(folder), "totals array<long>, files boolean", barrier=True).collect()
        assert [tuple(r) for r in found] == [([4950, 4950], files)] * 3


def test_saved_model_scores_like_its_trees(spark, rows):
    pdf, df = rows
    model = bm.fit_boosting(df, list("abc"), trees=4, depth=3)
    assert model.getNumTrees == 4 and model.treeWeights == [1.0] * 4
    got = bm.predict_pd(model, df, list("abc"), "dummy_id").toPandas().set_index("dummy_id").pd.sort_index()
    total = trees_of(spark, model, list("abc")).total(pdf[list("abc")].to_numpy())
    np.testing.assert_allclose(got, 1 / (1 + np.exp(-2 * total)), atol=1e-12)
    assert model.featureImportances.toArray().sum() == pytest.approx(1.0)


def test_odd_rows(spark, rows):
    _, df = rows
    with pytest.raises(Exception, match="missing values"):
        bm.fit_boosting(df.withColumn("a", F.when(F.col("dummy_id") != 5, F.col("a"))), list("abc"), trees=1)
    with pytest.raises(ValueError, match="no rows"):
        bm.fit_boosting(df.where("bad > 1"), list("abc"), trees=1)
    one = bm.fit_boosting(df.where("bad = 1"), list("abc"), trees=2)
    assert [t.numNodes for t in one.trees] == [1, 1]
