"""Model fits against direct solutions, attributions, registry, whole runs, streams."""

import json
from itertools import combinations
from math import factorial

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from scorespark.models import benchmarks as bm
from scorespark.models.calibration import fit_calibrated, fit_isotonic, fit_sigmoid
from scorespark.models.logistic import fit_logistic, newton_fits
from scorespark.models.tree_shap import explain_leaves, tree_shap
from scorespark.plans import flows
from scorespark.session import scratch_path
from scorespark.sources import registry
from scorespark.sources.applicants import applicants
from scorespark.streaming import runs

RNG = np.random.default_rng(3)


@pytest.fixture(scope="module")
def data(spark):
    n = 600
    x = RNG.normal(size=(n, 3)).round(3)
    y = (RNG.random(n) < 1 / (1 + np.exp(-(0.8 * x[:, 0] - 0.5 * x[:, 1])))).astype(int)
    pdf = pd.DataFrame(x, columns=list("abc")).assign(bad=y, dummy_id=range(n))
    return pdf, spark.createDataFrame(pdf).cache()


def newton(x, y, penalty, weight=None):
    design = np.c_[x, np.ones(len(x))]
    weight = np.ones(len(x)) if weight is None else weight
    ridge = np.diag([penalty] * x.shape[1] + [0.0])
    w = np.zeros(design.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ w))
        grad = design.T @ (weight * (p - y)) + ridge @ w
        w -= np.linalg.solve(design.T * (weight * p * (1 - p)) @ design + ridge, grad)
    return w


def test_logistic_matches_newton(data):
    pdf, df = data
    model = fit_logistic(df, list("abc"))
    w = newton(pdf[list("abc")].to_numpy(), pdf.bad.to_numpy(), 1.0)
    np.testing.assert_allclose([*model.coefficients.values(), model.intercept], w, atol=1e-4)


def test_fits_side_by_side_match_newton_on_their_own_rows(data):
    pdf, df = data
    df = df.withColumn("a", F.col("a") * 1000 + 5e4).withColumn("same", F.col("a") * 1).withColumn("fixed", F.lit(2))
    names = ["a", "b", "c", "same", "fixed"]
    targets = [F.when(F.col("dummy_id") % 3 != k, F.col("bad")) for k in range(2)]
    for k, model in enumerate(newton_fits(df, names, targets, [[1e6, 1.0, 1.0, 1e6, 1.0]] * 2)):
        own = pdf[pdf.dummy_id % 3 != k]
        # two equal columns with the penalty of one share its slope; twice the curvature is half the penalty
        x = np.c_[own.a, own.b, own.c] * [1, 1, 1]
        design = np.c_[x, np.ones(len(x))]
        w = np.zeros(4)
        for _ in range(50):
            p = 1 / (1 + np.exp(-design @ w))
            ridge = np.diag([0.5, 1.0, 1.0, 0.0])
            w -= np.linalg.solve(design.T * (p * (1 - p)) @ design + ridge, design.T @ (p - own.bad) + ridge @ w)
        found = model.coefficients
        np.testing.assert_allclose([2000 * found["a"], found["b"], found["c"]], w[:3], rtol=1e-6)
        np.testing.assert_allclose(model.intercept, w[3] - w[0] * 50, rtol=1e-6)
        assert found["same"] == pytest.approx(found["a"]) and found["fixed"] == 0.0


def test_fits_side_by_side_refuse_and_mark_odd_rows(spark):
    rows = spark.createDataFrame([(1, 0.5), (1, 1.5), (0, None)], "bad int, a double")
    (one,) = newton_fits(rows.na.drop(), ["a"], [F.col("bad")], [[1.0]])
    assert one.coefficients == {"a": 0.0} and one.intercept == float("inf")
    with pytest.raises(ValueError, match="missing"):
        newton_fits(rows, ["a"], [F.col("bad")], [[1.0]])
    with pytest.raises(ValueError, match="no rows"):
        newton_fits(rows.na.drop(), ["a"], [F.when(F.col("bad") == 0, 1)], [[1.0]])


def test_cross_fitting_passes_do_not_grow_with_the_folds(data, monkeypatch):
    from scorespark.models import calibration, logistic

    passes, plain = [], logistic._curvature
    monkeypatch.setattr(logistic, "_curvature", lambda places, *rest: passes.append(len(places)) or plain(places, *rest))
    calibration.fit_calibrated(data[1], list("abc"), folds=5, scale=True)
    # about five steps of the models and five of the sigmoids, each for all folds at once
    assert passes[0] == 5 and len(passes) <= 20


def test_sigmoid_matches_newton(data):
    pdf, df = data
    curve = fit_sigmoid(df.select("bad", F.col("a").alias("margin")))
    bads = pdf.bad.sum()
    t = np.where(pdf.bad == 1, (bads + 1) / (bads + 2), 1 / (len(pdf) - bads + 2))
    w = newton(pdf[["a"]].to_numpy(), t, 0.0)
    np.testing.assert_allclose([curve.slope, curve.intercept], w, atol=1e-4)


def test_calibrated_ensemble_is_a_probability(data):
    _, df = data
    plain = fit_calibrated(df, list("abc"))
    scaled = fit_calibrated(df, list("abc"), scale=True)
    assert len(plain.members) == 3
    got = df.select(plain.pd().alias("p"), scaled.pd().alias("q"), "bad").agg(
        F.min("p"), F.max("p"), F.avg("p"), F.avg("bad"), F.max(F.abs(F.col("p") - F.col("q")))
    ).first()
    assert 0 < got[0] < got[1] < 1 and got[2] == pytest.approx(got[3], abs=0.02) and got[4] < 0.02


def pava(x, y):
    blocks = []
    for v, g in pd.DataFrame({"x": x, "y": y}).groupby("x").y:
        blocks.append([g.mean(), len(g), [v]])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            n = a[1] + b[1]
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / n, n, a[2] + b[2]])
    return {v: m for m, _, vs in blocks for v in vs}


def test_isotonic_matches_pooling(data):
    pdf, df = data
    s = pdf.a.round(1)
    rows = df.withColumn("pd", F.round("a", 1))
    fitted = fit_isotonic(rows).apply(rows).select("pd", "pd_calibrated").distinct().collect()
    expected = pava(s, pdf.bad)
    for r in fitted:
        near = min(expected, key=lambda v: abs(v - r["pd"]))
        assert r["pd_calibrated"] == pytest.approx(expected[near], abs=1e-9)


def leaf_value(node, row, known, positive):
    """Expected value when only the features in ``known`` are given."""
    if node.subtreeDepth() == 0:
        return positive(node)
    f, t = node.split().featureIndex(), node.split().threshold()
    left, right = node.leftChild(), node.rightChild()
    if f in known:
        return leaf_value(left if row[f] <= t else right, row, known, positive)
    share = left.impurityStats().count() / node.impurityStats().count()
    return share * leaf_value(left, row, known, positive) + (1 - share) * leaf_value(right, row, known, positive)


@pytest.mark.parametrize("kind", ["forest", "boosting"])
def test_tree_attributions_match_the_definition(data, kind):
    pdf, df = data
    names = list("abc")
    if kind == "forest":
        model = bm.fit_forest(df, names, trees=3, depth=3)
        share = lambda n: n.impurityStats().stats()[1] / sum(n.impurityStats().stats())
        weights = [1 / 3] * 3
        positive = share
    else:
        model = bm.fit_boosting(df, names, trees=3, depth=3)
        weights, positive = list(model.treeWeights), lambda n: n.prediction()
    roots = [t._call_java("rootNode") for t in model.trees]
    got = tree_shap(model, df.where("dummy_id < 4"), names).toPandas()
    for i in range(4):
        row = pdf.loc[i, names].to_numpy()
        value = lambda known: sum(w * leaf_value(r, row, known, positive) for w, r in zip(weights, roots))
        mine = got[got.dummy_id == i].set_index("feature").phi
        for j, name in enumerate(names):
            others = [k for k in range(3) if k != j]
            phi = sum(
                factorial(len(s)) * factorial(2 - len(s)) / 6 * (value({*s, j}) - value(set(s)))
                for size in range(3)
                for s in combinations(others, size)
            )
            assert mine[name] == pytest.approx(phi, abs=1e-9)
        assert mine.sum() + got.base.iloc[0] == pytest.approx(value({0, 1, 2}), abs=1e-9)
    assert explain_leaves(df.sparkSession, model)[1] == pytest.approx(got.base.iloc[0])


def test_forest_beats_chance_and_compare_has_three_rows(data):
    _, df = data
    rows = {r.model: r.auc for r in bm.compare_models(df, df, list("abc"), forest={"trees": 5}, boosting={"trees": 3}).collect()}
    assert set(rows) == {"logistic", "forest", "boosting"} and min(rows.values()) > 0.6


def test_registry_promotes_and_rolls_back(spark, data, tmp_path):
    _, df = data
    root = str(tmp_path / "models")
    assembler = VectorAssembler(inputCols=list("abc"), outputCol="x")
    fitted = bm.fit_forest(df, list("abc"), trees=2, depth=2)
    model = PipelineModel([assembler, fitted])
    with pytest.raises(LookupError):
        registry.load_current(spark, root)
    assert [registry.register_model(model, root, 0.7, 0.3, "h") for _ in range(2)] == [1, 2]
    registry.promote(spark, root, 2)
    registry.promote(spark, root, 1)
    assert registry.current_version(registry.promotions(spark, root)).first()["version"] == 1
    assert registry.load_current(spark, root).transform(df).count() == 600


def test_scorecard_run_writes_reports(spark, folder, tmp_path):
    out = str(tmp_path / "run")
    metrics, summary = flows.scorecard_run(applicants(spark, folder), out, forest={"trees": 5})
    found = {r.model: r for r in metrics.collect()}
    assert 0.60 < found["scorecard"].auc < 0.95
    written = json.loads(spark.read.text(f"{out}/metrics.json").first()[0])
    assert written["scorecard"]["auc"] == pytest.approx(found["scorecard"].auc)
    assert sum(r.n for r in summary.collect()) == found["scorecard"].n
    assert spark.read.option("header", True).csv(f"{out}/scorecard_band_summary").count() == 5


def test_late_rows_do_not_change_a_closed_week(spark):
    """The stream closes a week once the watermark has passed it; what comes later is dropped."""
    folder = scratch_path(spark, "late")
    schema = "ts timestamp, value double"
    first = [("2024-01-02", 1.0), ("2024-01-03", 3.0), ("2024-01-20", 5.0)]
    second = [("2024-01-21", 6.0)]
    late = [("2024-01-04", 100.0), ("2024-02-20", 7.0)]
    for batch in (first, second, late):
        spark.createDataFrame(batch, "d string, value double").selectExpr(
            "CAST(d AS timestamp) AS ts", "value"
        ).coalesce(1).write.mode("append").parquet(folder)
    stream = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(folder)
    )
    out = scratch_path(spark, "late-out")
    runs.drain(runs.window_value_counts(stream, "value"), out)
    weeks = {r.period: (r.n, r.avg_value) for r in runs.window_summary(spark.read.parquet(out)).collect()}
    assert weeks["2024-01-01"] == (2, 2.0) and weeks["2024-01-15"] == (2, 5.5)


def test_every_fitted_part_survives_saving(spark, tmp_path):
    from scorespark.models.calibration import CalibratedEnsemble, Sigmoid
    from scorespark.operators.bands import BinEdges, ScoreBands
    from scorespark.operators.preparing import Imputer, OneHot, Scaler
    from scorespark.operators.scorecard import FROZEN_MODEL, LinearModel
    from scorespark.sources.artefacts import Scorer, load_artefact, load_isotonic, save_artefact

    ensemble = CalibratedEnsemble(((LinearModel({"a": 0.1, "b": 1 / 3}, -2.0), Sigmoid(1.5, -0.2)), (FROZEN_MODEL, Sigmoid(1.0, 0.0))))
    parts = [
        Imputer({"a": 1.0, "b": None}, ("p",)), OneHot({"p": ("x", "y")}), Scaler({"a": 0.0}, {"a": 2.0}), FROZEN_MODEL, Sigmoid(0.1, 0.2),
        ensemble, ScoreBands((1.0, 2.5, float("inf"))), BinEdges({"a": (0.0, 1.0)}), Scorer(Imputer({"a": 1.0}), ensemble, ScoreBands((0.0, 1.0))),
    ]
    for k, part in enumerate(parts):
        save_artefact(spark, part, str(tmp_path / str(k)))
        assert load_artefact(spark, str(tmp_path / str(k))) == part
    points = spark.createDataFrame([(0.1, 0), (0.4, 1), (0.6, 0), (0.9, 1)], "pd double, bad int")
    curve = fit_isotonic(points)
    save_artefact(spark, curve, str(tmp_path / "curve"))
    assert load_isotonic(str(tmp_path / "curve")).apply(points).collect() == curve.apply(points).collect()
    with pytest.raises(TypeError):
        save_artefact(spark, object(), str(tmp_path / "x"))


def test_registration_is_gated_and_numbers_are_not_reused(spark, data, tmp_path):
    from scorespark.operators.scorecard import FROZEN_MODEL

    root = str(tmp_path / "models")
    gate = spark.createDataFrame([(False,)], "passed boolean")
    with pytest.raises(ValueError, match="gate"):
        registry.register_model(FROZEN_MODEL, root, 0.5, 0.1, "h", gate=gate)
    assert registry.versions(spark, root).count() == 0
    assert registry.reserve_version(spark, root) == 1  # broken off before its row was written
    assert registry.register_model(FROZEN_MODEL, root, 0.7, 0.3, "h") == 2
    with pytest.raises(LookupError):
        registry.promote(spark, root, 1)
    registry.promote(spark, root, 2)
    assert registry.load_current(spark, root) == FROZEN_MODEL


def test_large_forests_are_prepared_quickly(spark, data):
    import time

    _, df = data
    model = bm.fit_forest(df, list("abc"), trees=60, depth=6)
    started = time.time()
    leaves, _ = explain_leaves(spark, model)
    assert len(leaves) > 500 and time.time() - started < 20


def test_listed_patterns_are_those_that_occur(monkeypatch):
    from scorespark.models import tree_shap as ts

    rng = np.random.default_rng(5)
    leaves = [ts.Leaf(np.arange(m), np.full(m, -0.5), np.full(m, 0.7), rng.uniform(0.1, 0.9, m), 0.3) for m in range(1, 7)]
    values = rng.normal(size=(500, 6))
    listed = ts.attributions(values, leaves)
    monkeypatch.setattr(ts, "TABLE", 0)
    np.testing.assert_allclose(listed, ts.attributions(values, leaves), atol=1e-14)
