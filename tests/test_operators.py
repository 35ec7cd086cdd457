"""Invariants and awkward inputs of the relational operators."""

import glob
import math
import os
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorespark import spec as sp
from scorespark.functions.scoring import build_score, decision
from scorespark.operators import bands as bn
from scorespark.operators import features as fe
from scorespark.operators import metrics as mt
from scorespark.operators import monitoring as mo
from scorespark.operators import schema as sc
from scorespark.operators import splitting as sl
from scorespark.operators.preparing import fit_imputer, fit_onehot, fit_scaler
from scorespark.operators.quantiles import exact_quantiles, grouped_quantiles
from scorespark.operators.running import running_totals
from scorespark.operators.scorecard import LinearModel, build_scorecard, score_dataset
from scorespark.session import CHECKPOINT_CONF, shared_dir, values_table
from scorespark.sources import sinks
from scorespark.sources.readers import contract_violations, load_credit_data

RNG = np.random.default_rng(7)


def frame(spark, **columns):
    return spark.createDataFrame(pd.DataFrame(columns))


# --- configuration ---------------------------------------------------------------


def test_spec_roles():
    assert sp.TARGET == "bad" and isinstance(sp.RANDOM_STATE, int)
    assert set(sp.LEAKAGE_COLUMNS) == {"num_accounts_perf", "highest_arrears_perf", "age_oldest_perf"}
    assert sp.ID_COLUMNS == ("dummy_id",)
    assert "worst_arrears_assess" not in sp.LEAKAGE_COLUMNS + sp.ID_COLUMNS
    assert len(sp.BASE_FEATURES) == 53 and len(sp.applicant_schema().fields) == 58


def test_package_keeps_to_safe_operations():
    root = os.path.join(os.path.dirname(__file__), "..", "scorespark")
    for path in glob.glob(f"{root}/**/*.py", recursive=True):
        text = open(path).read()
        for word in ("localCheckpoint", ".crossJoin(", ".toPandas(", "sc.parallelize"):
            assert word not in text, (path, word)


def session_like(master, configured=None):
    conf = SimpleNamespace(get=lambda name, default: configured if name == CHECKPOINT_CONF else default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId="x"))


def test_shared_dir_follows_the_session(spark):
    assert shared_dir(session_like("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    with pytest.raises(RuntimeError, match=CHECKPOINT_CONF):
        shared_dir(session_like("yarn"))
    assert os.path.isdir(shared_dir(spark))


# --- names, types, sources ---------------------------------------------------------


def test_clean_names_is_idempotent_and_refuses_collisions(spark):
    df = spark.createDataFrame([(1, 2)], [" Dummy ID ", "num_accounts_assess"])
    once = sc.clean_column_names(df)
    assert once.columns == ["dummy_id", "num_accounts_assess"]
    assert sc.clean_column_names(once).columns == once.columns
    assert sc.remove_ids(once).columns == ["num_accounts_assess"]
    with pytest.raises(ValueError, match="collide"):
        sc.clean_column_names(spark.createDataFrame([(1, 2)], ["A b", "a_b "]))


def test_type_checks(spark):
    df = spark.createDataFrame([(1, 0, "x", 2.0)], "dummy_id long, bad int, product_type string, v double")
    with pytest.raises(ValueError, match="product_type"):
        sc.ensure_numeric(df)
    with pytest.raises(ValueError, match="bad"):
        sc.ensure_target(df.drop("bad"))
    with pytest.raises(ValueError, match="no numeric"):
        sc.select_numeric(df.drop("v"))
    assert sc.ensure_numeric(df.drop("product_type")).columns == ["dummy_id", "bad", "v"]


def test_bad_strings_become_null_then_zero(spark):
    df = spark.createDataFrame([("abc",), ("1.5",), (None,)], "v string")
    assert sorted(r.v for r in sc.coerce_numeric(df, ["v"]).collect()) == [0.0, 0.0, 1.5]


def test_nan_is_missing_on_load(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame([(1, float("nan")), (2, 3.0)], "`Dummy ID` long, v double").write.parquet(path)
    loaded = load_credit_data(spark, path)
    assert loaded.columns == ["dummy_id", "v"]
    assert loaded.where("v IS NULL").count() == 1
    with pytest.raises(ValueError, match="declared schema"):
        load_credit_data(spark, path, "csv")


def test_contract(spark):
    df = spark.createDataFrame([(1, 0), (1, 5), (None, 1)], "dummy_id long, bad int")
    found = contract_violations(df, df.schema, min_rows=5, key="dummy_id", allowed={"bad": (0, 1)})
    assert {(r.rule, r.found) for r in found.collect()} == {
        ("too few rows", 2),
        ("key missing", 1),
        ("key repeated", 1),
        ("value not allowed", 1),
    }
    assert contract_violations(df.limit(0), df.schema, min_rows=0).count() == 0


def test_dataset_hash_sees_repeated_rows_but_not_order(spark):
    df = frame(spark, a=[1, 2, 3], b=["x", "y", None])
    first = sinks.dataset_hash(df).first()
    assert sinks.dataset_hash(df.orderBy(F.desc("a")).repartition(3)).first() == first
    doubled = sinks.dataset_hash(df.unionByName(df).unionByName(df)).first()
    assert doubled["xor_digest"] == first["xor_digest"] and doubled["sum_digest"] != first["sum_digest"]


# --- splits ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, int(i % 4 == 0), float(i % 13)) for i in range(1003)]
    return spark.createDataFrame(rows, "dummy_id long, bad int, v double").cache()


@pytest.mark.parametrize("scheme", [sl.two_way(), sl.holdout_then_test(), sl.shares_of_all(), sl.equal_folds(3)])
def test_split_is_exact_and_independent_of_partitioning(labelled, scheme):
    names, ranks = scheme
    cuts = sl.fit_cuts(labelled, scheme)
    assert sl.fit_cuts(labelled.repartition(17), scheme, limit=3) == cuts
    got = {
        (r["bad"], r["split"]): r["count"]
        for r in cuts.apply(labelled).groupBy("bad", "split").count().collect()
    }
    sizes = {0: 752, 1: 251}
    for klass, bounds in ranks(sizes).items():
        edges = [0, *bounds, sizes[klass]]
        for name, low, high in zip(names, edges, edges[1:]):
            assert got.get((klass, name), 0) == high - low


def test_split_sizes_of_the_known_table():
    sizes = {0: 34113, 1: 10885}
    _, ranks = sl.holdout_then_test()
    cut = ranks(sizes)
    assert sum(c[1] for c in cut.values()) == 44998 - 31498 and sum(c[0] for c in cut.values()) == 9045
    _, ranks = sl.shares_of_all()
    assert sum(c[0] for c in ranks(sizes).values()) == 9000


def test_split_keeps_rows_of_a_dominant_key_together(spark):
    rows = [(7 if i % 3 == 0 else 1000 + i, i % 2) for i in range(900)]
    df = spark.createDataFrame(rows, "dummy_id long, bad int")
    cuts = sl.fit_cuts(df, sl.two_way(), limit=50)
    per_key = cuts.apply(df).groupBy("dummy_id", "bad").agg(F.count_distinct("split").alias("n"))
    assert per_key.where("n > 1").count() == 0


def test_split_balance_and_overlap(labelled):
    assigned = sl.split_data(labelled)
    assert all(r.within_tolerance for r in sl.split_balance(assigned).collect())
    assert tuple(sl.split_overlap(assigned, labelled).first()) == (0, 0, 0)
    broken = assigned.unionByName(assigned.limit(1).withColumn("split", F.lit("other")))
    assert sl.split_overlap(broken, labelled).first()["in_two_splits"] == 1


# --- quantiles and running totals ----------------------------------------------------


@pytest.fixture(scope="module")
def numbers(spark):
    n = 4000
    pdf = pd.DataFrame(
        {
            "smooth": RNG.normal(size=n),
            "spiky": np.where(RNG.random(n) < 0.4, 1.0, RNG.normal(size=n)),
            "steps": RNG.integers(0, 5, n).astype(float),
            "gaps": np.where(RNG.random(n) < 0.3, np.nan, RNG.exponential(size=n)),
            "same": 2.5,
        }
    )
    df = sc.nan_to_null(spark.createDataFrame(pdf)).withColumn("empty", F.lit(None).cast("double"))
    return pdf, df.cache()


@pytest.mark.parametrize(
    "options", [{}, {"few_values": 0}, {"few_values": 0, "limit": 20, "accuracy": 50}, {"few_values": 0, "limit": 0.5, "accuracy": 10}]
)
def test_quantiles_are_exact_on_every_path(numbers, options):
    pdf, df = numbers
    marks = [0, 0.1, 0.3, 0.5, 0.7, 0.99, 1]
    if options.get("limit") == 0.5:  # list nothing: only edges may answer
        marks = [0.25, 0.5]
        options = {**options, "limit": 9}
    found = exact_quantiles(df, {c: marks for c in df.columns}, **options)
    for c in pdf.columns:
        np.testing.assert_allclose(found[c], pdf[c].quantile(marks).to_list(), rtol=1e-12, atol=1e-12)
    assert found["empty"] == [None] * len(marks)


def test_grouped_quantiles_with_a_dominant_group(spark):
    pdf = pd.DataFrame({"g": np.where(RNG.random(3000) < 0.6, "hot", "cold"), "v": RNG.normal(size=3000).round(2)})
    found = grouped_quantiles(spark.createDataFrame(pdf), ["g"], "v", [0.05, 0.5, 0.95]).collect()
    for r in found:
        expected = pdf[pdf.g == r["g"]].v.quantile([0.05, 0.5, 0.95])
        np.testing.assert_allclose([r["p5"], r["p50"], r["p95"]], expected.to_list(), atol=1e-12)


@pytest.mark.parametrize("slices", [1, 3, 40])
def test_running_totals_do_not_depend_on_slices(spark, slices):
    pdf = pd.DataFrame({"k": ["a"] * 90 + ["b"] * 10, "o": list(range(90)) + list(range(10)), "n": RNG.integers(0, 9, 100)})
    got = running_totals(spark.createDataFrame(pdf), ["k"], "o", ["n"], slices).toPandas()
    got = got.sort_values(["k", "o"]).reset_index(drop=True)
    assert (got.n_upto == pdf.groupby("k").n.cumsum()).all()
    assert (got.n_total == pdf.groupby("k").n.transform("sum")).all()


# --- preparation and features ---------------------------------------------------------


def test_fit_on_train_only(spark):
    rows = [(1, 0, "train", 1.0, "a"), (2, 1, "train", None, None), (3, 0, "test", 99.0, "zz"), (4, 1, "test", None, "a")]
    df = spark.createDataFrame(rows, "dummy_id long, bad int, split string, v double, product_type string")
    filled = {r.dummy_id: r for r in fit_imputer(df).apply(df).collect()}
    assert [filled[i].v for i in (1, 2, 3, 4)] == [1.0, 1.0, 99.0, 1.0]
    assert filled[2].product_type == "missing"
    assert fit_imputer(df) == fit_imputer(df.repartition(5))
    encoder = fit_onehot(df.na.fill("b", ["product_type"]))
    coded = {r.dummy_id: r for r in encoder.apply(df).collect()}
    assert encoder.names() == ["product_type_b"]
    assert coded[3]["product_type_b"] == 0 and coded[2]["product_type_b"] == 0
    with pytest.raises(ValueError, match="levels"):
        fit_onehot(df, fit_on="all", max_levels=1)


def test_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(2.0, None), (2.0, None)], "same double, empty double")
    assert [r.same for r in fit_scaler(df, fit_on="all", columns=["same"]).apply(df).collect()] == [0.0, 0.0]
    assert fit_imputer(df, fit_on="all").medians == {"same": 2.0, "empty": None}


def test_zero_denominator_and_absent_inputs(spark):
    df = spark.createDataFrame([(3.0, -1.0), (3.0, 2.0)], "risk_drivers double, risk_mitigators double")
    made = fe.create_features(df)
    assert sorted((r.risk_ratio for r in made.collect()), key=str) == [1.0, None]
    assert "affordability_ratio" not in made.columns and "risk_x_emotional" not in made.columns


def test_quantile_flags_are_strict_and_null_is_zero(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)] + [(None,)], "total_risk_score double")
    flagged = fe.engineer_features(df, fit_on="all")
    assert flagged.where("high_risk_flag = 1").count() == 3  # 8, 9, 10 above 7
    assert flagged.where("low_risk_flag = 1").count() == 3  # 0, 1, 2 below 3
    assert flagged.where("total_risk_score IS NULL AND high_risk_flag = 0").count() == 1


# --- metrics ----------------------------------------------------------------------------


def brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))


def test_discrimination_matches_brute_force(spark):
    y = RNG.integers(0, 2, 400)
    s = np.clip((RNG.random(400) * 0.6 + y * 0.3).round(2), 0, 1)
    df = frame(spark, bad=y, pd=s).withColumn("inverse", 1 - F.col("pd"))
    got = mt.discrimination(df).first()
    values = np.unique(s)
    gap = [(s[y == 1] <= v).mean() - (s[y == 0] <= v).mean() for v in values]
    assert got.auc == pytest.approx(brute_auc(y, s), abs=1e-12)
    assert got.ks == pytest.approx(np.abs(gap).max(), abs=1e-12)
    assert got.ks_one_sided == pytest.approx(max(0, -min(gap)), abs=1e-12)
    assert got.brier == pytest.approx(((s - y) ** 2).mean(), abs=1e-12)
    turned = mt.discrimination(df, "inverse", brier=False).first()
    assert turned.auc == pytest.approx(1 - got.auc, abs=1e-12)
    again = mt.discrimination(df.repartition(37)).first()
    assert again.auc == got.auc and again.ks == got.ks


def test_single_class_has_no_auc(spark):
    got = mt.discrimination(frame(spark, bad=[0, 0, 0], pd=[0.1, 0.2, 0.3])).first()
    assert got.auc is None and got.ks is None and got.ks_one_sided is None and got.n == 3


def test_planted_leak_is_flagged(spark):
    y = RNG.integers(0, 2, 200)
    df = frame(spark, bad=y, honest=RNG.random(200), leak=y * 2.0 + RNG.random(200))
    flagged = {r.feature: r.extreme for r in mt.check_single_feature_auc(df, columns=["honest", "leak"]).collect()}
    assert flagged == {"honest": False, "leak": True}
    assert [r.feature for r in mt.leakage_check(df, columns=["honest", "leak"]).collect()] == ["leak"]


# --- bins, bands, evidence -----------------------------------------------------------------


def test_quantile_bins_match_qcut(spark):
    values = pd.Series(np.concatenate([RNG.integers(0, 4, 200), RNG.normal(size=100).round(1)]))
    edges = bn.fit_quantile_bins(frame(spark, v=values), ["v"], 10)
    got = bn.bin_columns(frame(spark, v=values, i=range(300)), edges, ["i"]).orderBy("i").toPandas().v
    expected = pd.qcut(values, 10, duplicates="drop").cat.codes + 1
    assert (got.to_numpy() == expected.to_numpy()).all()


def test_tied_scores_leave_low_bands_empty(spark):
    df = frame(spark, score=[1.0, 1, 1, 1, 2, 3, 4], pd=[0.5] * 7, bad=[1, 0, 1, 0, 0, 0, 0])
    summary = bn.band_summary(bn.fit_bands(df).apply(df)).orderBy("band_rank").collect()
    assert [r.band for r in summary] == list("ABCDE")
    # edges 1, 1.6, 2.8, 4: three bins, so D and E stay empty
    assert [r.n for r in summary] == [2, 1, 4, 0, 0] and summary[4].bad_rate is None
    assert summary[0].avg_score == 3.5


def test_edge_value_falls_into_the_lower_bin(spark):
    edges = bn.BinEdges({"v": (0.0, 1.0, 2.0)})
    got = bn.bin_columns(frame(spark, v=[0.0, 1.0, 1.5, 2.0, 9.0, -9.0]), edges).collect()
    assert [r.v for r in got] == [1, 1, 2, 2, 2, 1]


def test_constant_column_has_no_information(spark):
    df = frame(spark, v=[3.0] * 10, bad=[0, 1] * 5)
    table = bn.woe_iv_table(df, bn.fit_quantile_bins(df, ["v"])).collect()
    assert len(table) == 1 and table[0].woe == 0 and table[0].iv_total == 0


def test_woe_sign_and_iv(spark):
    y = RNG.integers(0, 2, 500)
    df = frame(spark, v=RNG.normal(size=500) + y, noise=RNG.normal(size=500), bad=y)
    iv = {r.feature: r.iv for r in bn.compute_iv_all(df, ["v", "noise"]).collect()}
    assert iv["v"] > 0.3 > iv["noise"] >= 0
    table = bn.woe_iv_table(df, bn.fit_quantile_bins(df, ["v"])).orderBy("bin").collect()
    assert table[0].woe > 0 > table[-1].woe  # few bads in the low bins


# --- scorecard ---------------------------------------------------------------------------


def test_score_scale(spark):
    df = frame(spark, pd=[1 / 21, 1 / 41, 0.0, 1.0])
    got = [r.s for r in df.select(build_score(F.col("pd")).alias("s")).collect()]
    assert got[0] == pytest.approx(600) and got[1] == pytest.approx(650)
    assert all(math.isfinite(v) for v in got)


def test_points_round_half_to_even_and_decisions(spark):
    model = LinearModel({"x": 1.0}, 0.0)
    factor = 20 / math.log(2)
    offset = 600 - factor * math.log(50)
    df = frame(spark, x=[(offset - 560.5) / factor, (offset - 619.5) / factor])
    assert [r.points for r in score_dataset(df, model).collect()] == [560, 620]
    cuts = frame(spark, s=[559, 560, 619, 620]).select(decision(F.col("s")).alias("d")).collect()
    assert [r.d for r in cuts] == ["DECLINE", "REFER", "REFER", "APPROVE"]
    rounded = spark.range(1).select(*[F.bround(F.lit(v), 0).alias(str(i)) for i, v in enumerate((0.5, 1.5, 2.5))]).first()
    assert list(rounded) == [0.0, 2.0, 2.0]


def test_points_table_order(spark):
    table = build_scorecard(LinearModel({"a": -0.5, "b": 0.7}, 1.0).table(spark)).collect()
    assert [r.feature for r in table] == ["b", "a"]
    assert table[0].base_score_share == pytest.approx(round((600 - 20 / math.log(2) * math.log(50)) / 2, 2))


# --- monitoring ---------------------------------------------------------------------------


def test_psi_of_a_population_with_itself_is_zero(spark):
    df = frame(spark, v=RNG.normal(size=500))
    edges = bn.fit_quantile_bins(df, ["v"])
    assert mo.population_stability(df, df, edges).first()["psi"] == 0
    moved = df.withColumn("v", F.col("v") + 1)
    assert mo.population_stability(df, moved, edges).first()["psi"] > 0.2


def test_band_monotone(spark):
    rising = values_table(spark, [("A", 1, 5, 0.1), ("B", 2, 0, None), ("C", 3, 5, 0.2)], "band string, band_rank int, n long, bad_rate double")
    assert bn.bands_monotone(rising).first()["monotone"]
    flat = rising.withColumn("bad_rate", F.when(F.col("n") > 0, 0.1))
    assert not bn.bands_monotone(flat).first()["monotone"]


def test_reindex(spark):
    df = spark.createDataFrame([(1, 2.0, "x")], "dummy_id long, a double, extra string")
    got = sc.reindex_columns(df, T.StructType.fromDDL("a double, b int"), keep=["dummy_id"]).first()
    assert got.asDict() == {"dummy_id": 1, "a": 2.0, "b": 0}


def test_fingerprint_sees_every_bit_and_field_border(spark):
    from scorespark.sources.sinks import dataset_hash

    def digest(rows):
        return tuple(dataset_hash(spark.createDataFrame(rows, "x double, a string, b string")).first())

    pairs = [
        ((1.00001, "a|b", "c"), (1.00004, "a", "b|c")),
        ((1.0, "~", "c"), (1.0, None, "c")),
        ((1.0, "a", "bc"), (1.0, "ab", "c")),
        ((1e17, "a", "b"), (1e17 + 16, "a", "b")),
        ((5e-324, "a", "b"), (1e-323, "a", "b")),
        ((0.1, "a", "b"), (0.1 + 1.4e-17, "a", "b")),
    ]
    for one, other in pairs:
        assert digest([one]) != digest([other])
    assert digest([(0.0, "a", "b"), (2.0, None, "")]) == digest([(2.0, None, ""), (-0.0, "a", "b")])
    assert digest([(float("inf"), "a", "b")]) != digest([(float("-inf"), "a", "b")]) != digest([(float("nan"), "a", "b")])


def test_double_text_is_exact(spark):
    import math

    from scorespark.functions.hashing import double_text

    values = [1.0, -1.5, 0.1, 2.0**53, 2.0**53 - 1, 1e308, 5e-324, 3.0, 1 / 3, 2.0**-1022, 8.0, 0.125, 1e17]
    rows = spark.createDataFrame([(v,) for v in values], "x double").select("x", double_text(F.col("x")).alias("t")).collect()
    for r in rows:
        mantissa, power = r.t.lstrip("-").split("p")
        assert math.ldexp(int(mantissa), int(power) - 52) == abs(r.x) and r.t.startswith("-") == (r.x < 0)


def test_rows_without_a_label_are_named(spark):
    rows = [(k, None if k < 20 else k % 2) for k in range(200)]
    df = spark.createDataFrame(rows, "dummy_id long, bad int")
    with pytest.raises(ValueError, match="20 rows"):
        sl.fit_cuts(df, sl.two_way())
    left = sl.fit_cuts(df, sl.two_way(), unlabelled="leave").apply(df)
    assert left.where("split is null").count() == 20


def test_fold_scaling_of_large_means(spark):
    from scorespark.operators.preparing import grouped_scaling

    values = [(k % 3, 1e9 + (k * 37 % 101) / 30) for k in range(300)]
    df = spark.createDataFrame(values, "fold int, x double")
    for r in grouped_scaling(df, "fold", ["x"]).collect():
        rest = [x for f, x in values if f != r.fold]
        mean = sum(rest) / len(rest)
        assert r["mean"] == pytest.approx(mean)
        assert r["deviation"] == pytest.approx((sum((x - mean) ** 2 for x in rest) / len(rest)) ** 0.5, rel=1e-6)


def test_many_requests_and_outcomes_of_one_applicant(spark):
    from scorespark.operators.monitoring import retraining_rows

    audit = spark.range(3000).selectExpr("1L AS applicant_id", "timestamp_seconds(id * 10) AS scored_at", "id AS request")
    outcomes = spark.range(3000).selectExpr("1L AS applicant_id", "timestamp_seconds(id * 10 + 5) AS observed_at", "CAST(id % 2 AS int) AS bad")
    found = retraining_rows(audit, outcomes, 1)
    assert found.count() == 3000
    assert found.where("unix_seconds(observed_at) <> request * 10 + 5 or bad <> request % 2").count() == 0
    late = spark.sql("SELECT 1L AS applicant_id, timestamp'1969-12-31 00:00:00' AS observed_at, 1 AS bad")
    assert retraining_rows(audit, late, 1).count() == 0


def test_sigmoid_calibration_keeps_certain_rows(spark):
    from scorespark.models.calibration import calibrate_model

    rows = [(float(p), 1 if (k * 7 % 100) < bad else 0) for p, bad in ((0, 10), (1, 90)) for k in range(100)]
    df = spark.createDataFrame(rows, "pd double, bad int")
    got = {r.pd: r.pd_calibrated for r in calibrate_model(df, "sigmoid")(df).collect()}
    assert got[0.0] == pytest.approx(0.10, abs=0.03) and got[1.0] == pytest.approx(0.90, abs=0.03)


def test_prepare_run_on_the_full_width(spark, tmp_path):
    from scorespark.plans import flows
    from scorespark.spec import applicant_schema

    fields = applicant_schema().fields
    columns = []
    for n, f in enumerate(fields):
        kind = f.dataType.simpleString()
        if kind == "double":
            columns.append(f"CAST((id * {n + 3}) % {97 + n} AS double) / 7 AS `{f.name}`")
        elif kind == "string":
            columns.append(f"CASE WHEN id % 2 = 0 THEN 'Micro' ELSE 'Retail' END AS `{f.name}`")
        else:
            columns.append(f"CAST({'id' if f.name == 'dummy_id' else 'id % 4 = 0'} AS {kind}) AS `{f.name}`")
    df = spark.range(600).selectExpr(*columns).withColumnRenamed("bad", " Bad ")
    done = flows.prepare_run(df, str(tmp_path / "wide"))
    assert done.rows.count() == 600 and len(done.features) >= 50


def test_sparse_onehot_of_many_levels(spark):
    from scorespark.operators.preparing import fit_sparse_onehot

    df = spark.range(3000).selectExpr("concat('l', lpad(id % 1500, 4, '0')) AS a", "id % 2 = 0 AS b0").selectExpr("a", "CAST(b0 AS string) AS b")
    model = fit_sparse_onehot(df, ["a", "b"], fit_on="all")
    rows = {(r.a, r.b): r.onehot for r in model.transform(df).distinct().collect()}
    sizes = {v.size for v in rows.values()}
    assert sizes == {1500 + 2}
    seen = model.transform(spark.createDataFrame([("new", "true"), ("l0001", None)], "a string, b string")).collect()
    assert [r.onehot.numNonzeros() for r in seen] == [1, 1]


def test_staged_tables_can_be_dropped(spark):
    from scorespark.session import drop_staged, stage

    table = stage(spark.range(5), "gone")
    path = table.inputFiles()[0]
    assert table.count() == 5
    assert drop_staged(spark) >= 1
    assert not os.path.exists(path.removeprefix("file://")) and drop_staged(spark) == 0


def test_quantiles_take_few_passes_and_read_only_open_columns(spark, monkeypatch):
    from scorespark.operators import quantiles

    passes, count = [], quantiles._count
    monkeypatch.setattr(quantiles, "_count", lambda df, open_, limit: passes.append(set(open_)) or count(df, open_, limit))
    df = spark.range(60_000).select(
        F.exp(F.col("id") / 100).alias("wide"),
        F.pmod("id", F.lit(3)).cast("double").alias("few"),
        F.when(F.pmod("id", F.lit(4)) == 0, F.lit(-0.0)).when(F.col("id") < 7, float("nan")).alias("odd"),
        F.lit(None).cast("double").alias("none"),
    )
    found = exact_quantiles(df, {c: [0.0, 0.5, 1.0] for c in df.columns}, limit=4000)
    exact = sorted(r[0] for r in df.select("wide").collect())
    assert found["wide"] == [exact[0], exact[29_999] + (exact[30_000] - exact[29_999]) * 0.5, exact[-1]]
    assert found["few"] == [0.0, 1.0, 2.0] and found["none"] == [None] * 3
    assert found["odd"][:2] == [0.0, 0.0] and found["odd"][2] != found["odd"][2]
    assert passes[0] == set(df.columns) and all(p == {"wide"} for p in passes[1:]) and len(passes) <= 5
