"""Queries on scores: discrimination, bands, points, evidence, attributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorespark.operators import bands as bn
from scorespark.operators import explain as ex
from scorespark.operators import metrics as mt
from scorespark.operators import scorecard as sd
from scorespark.operators.preparing import fit_imputer, fit_scaler
from scorespark.plans.frozen import (
    MODEL_INPUTS,
    base,
    frozen_scores,
    frozen_scores_all,
    held_out_band_summary,
    split_base,
)
from scorespark.plans.registry import query, r6, rounded
from scorespark.plans.sql import (
    APPLICANTS,
    BAND_LIST,
    NUMERIC,
    banded_cte,
    bin_of,
    cumulative_cte,
    dbl,
    imputed_cte,
    points_expr,
    quantile_edges,
    scored_cte,
    split_cte,
)
from scorespark.plans.sql import r6 as sql_r6
from scorespark.functions.scoring import POINTS_SCALE, build_score
from scorespark.session import scratch_path, stage, values_table
from scorespark.sources import sinks

TEST = "split = 'test'"
SCORED = f"WITH {scored_cte('two')}"
TEST_ROWS = f"{SCORED}, x AS (SELECT * FROM f WHERE {TEST})"
LEAKY = ["highest_arrears_perf", "num_accounts_perf"]


def _test(spark, d, extra=()):
    return frozen_scores(spark, d, extra=extra).where(F.col("split") == "test")


# --- discrimination -------------------------------------------------------------

_AUC = "SUM(b * (cg - g / 2)) / (MAX(tg) * MAX(tb))"


@query(
    f"""{TEST_ROWS}, {cumulative_cte('x', 'pd')}
SELECT CAST(SUM(g + b) AS BIGINT) AS n, CAST(SUM(b) AS BIGINT) AS n_bad, {sql_r6(_AUC, 'auc')}, {sql_r6(f'2 * ({_AUC}) - 1', 'gini')},
  {sql_r6('MAX(ABS(cb / tb - cg / tg))', 'ks')},
  {sql_r6('GREATEST(0, MAX(cg / tg - cb / tb))', 'ks_one_sided')},
  (SELECT ROUND(AVG((pd - bad) * (pd - bad)), 6) FROM x) AS brier FROM cum"""
)
def auc_gini_ks(spark, d):
    return rounded(mt.discrimination(_test(spark, d)), "auc", "gini", "ks", "ks_one_sided", "brier")


@query(
    f"""{TEST_ROWS}, {cumulative_cte('x', 'score')}
SELECT CAST(SUM(g + b) AS BIGINT) AS n, {sql_r6(_AUC, 'auc')}, {sql_r6('MAX(ABS(cb / tb - cg / tg))', 'ks')},
  {sql_r6('GREATEST(0, MAX(cg / tg - cb / tb))', 'ks_one_sided')} FROM cum"""
)
def inverted_score_ks(spark, d):
    """A score that falls with risk: the two KS definitions part."""
    found = mt.discrimination(_test(spark, d), "score", brier=False)
    return rounded(found.select("n", "auc", "ks", "ks_one_sided"), "auc", "ks", "ks_one_sided")


@query(f"{TEST_ROWS} SELECT {sql_r6('AVG((pd - bad) * (pd - bad))', 'brier')} FROM x")
def brier(spark, d):
    return _test(spark, d).agg(r6(F.avg(F.pow(F.col("pd") - F.col("bad"), 2))).alias("brier"))


@query(
    f"""{TEST_ROWS}, x9 AS (SELECT ROUND(pd, 9) AS pd, bad FROM x), {cumulative_cte('x9', 'pd')}
SELECT ROUND(s, 6) AS threshold, ROUND((tg - cg + g) / tg, 6) AS fpr, ROUND((tb - cb + b) / tb, 6) AS tpr FROM cum
UNION ALL SELECT NULL, 0e0, 0e0"""
)
def roc_points(spark, d):
    return rounded(mt.roc_points(_test(spark, d), places=9), "threshold", "fpr", "tpr")


@query(
    f"""{TEST_ROWS} SELECT bad, COUNT(*) AS n, {sql_r6('AVG(pd)', 'avg_pd')}, {sql_r6('MIN(pd)', 'min_pd')},
  {sql_r6('MAX(pd)', 'max_pd')} FROM x GROUP BY bad"""
)
def scores_by_class(spark, d):
    found = _test(spark, d).groupBy("bad").agg(
        F.count("*").alias("n"),
        F.avg("pd").alias("avg_pd"),
        F.min("pd").alias("min_pd"),
        F.max("pd").alias("max_pd"),
    )
    return rounded(found, "avg_pd", "min_pd", "max_pd")


def _feature_auc_sql(columns: list[str]) -> str:
    union = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {c} AS v, bad FROM i WHERE split = 'train'" for c in columns
    )
    return f"""WITH {split_cte('shares')}, {imputed_cte('s', columns, "split = 'train'")},
long AS ({union}), {cumulative_cte('long', 'v', key='feature')},
auc AS (SELECT feature, CAST(SUM(g + b) AS BIGINT) AS n, ROUND({_AUC}, 6) AS auc FROM cum GROUP BY feature)"""


def _imputed_train(spark, d, columns):
    df = split_base(spark, d, ["dummy_id", "bad", *columns])
    return fit_imputer(df, columns=columns, categorical=False).apply(df).where(F.col("split") == "train")


@query(
    _feature_auc_sql(NUMERIC + LEAKY)
    + " SELECT feature, n, auc, auc > 0.90 OR auc < 0.10 AS extreme FROM auc"
)
def feature_auc(spark, d):
    columns = NUMERIC + LEAKY
    found = mt.check_single_feature_auc(_imputed_train(spark, d, columns), columns=columns)
    return rounded(found, "auc")


@query(_feature_auc_sql(NUMERIC + LEAKY) + " SELECT feature, n, auc FROM auc WHERE auc > 0.70")
def leakage_flags(spark, d):
    columns = NUMERIC + LEAKY
    found = mt.leakage_check(_imputed_train(spark, d, columns), 0.70, columns=columns)
    return rounded(found, "auc")


@query(f"WITH {APPLICANTS} SELECT COUNT(*) AS n, CAST(SUM(bad) AS BIGINT) AS bads, {sql_r6('AVG(bad)', 'bad_rate')} FROM a")
def class_balance(spark, d):
    from scorespark.sources.applicants import applicants

    return rounded(mt.class_balance(applicants(spark, d)), "bad_rate")


_STATS = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, COUNT({c}) AS n, ROUND(AVG({c}), 6) AS mean, ROUND(STDDEV_POP({c}), 6) AS std,
  MIN({c}) AS "min", MAX({c}) AS "max" FROM a"""
    for c in NUMERIC
)


@query(f"WITH {APPLICANTS} {_STATS}")
def column_stats(spark, d):
    from scorespark.sources.applicants import applicants

    return rounded(mt.column_summary(applicants(spark, d), NUMERIC), "mean", "std")


@query(
    f"WITH {APPLICANTS}, q AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, UNNEST([1, 5, 50, 95, 99]) AS percent, UNNEST(QUANTILE_CONT({c}, [1e-2, 5e-2, 5e-1, 95e-2, 99e-2])) AS value FROM a"
        for c in NUMERIC
    )
    + ") SELECT feature, percent, ROUND(value, 6) AS value FROM q"
)
def column_quantiles(spark, d):
    from scorespark.operators.quantiles import exact_quantiles

    marks = [0.01, 0.05, 0.5, 0.95, 0.99]
    found = exact_quantiles(base(spark, d, NUMERIC), {c: marks for c in NUMERIC})
    rows = [(c, round(p * 100), v) for c in NUMERIC for p, v in zip(marks, found[c])]
    return rounded(values_table(spark, rows, "feature string, percent int, value double"), "value")


@query(
    f"WITH {APPLICANTS} "
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, COUNT(DISTINCT {c}) AS n_distinct FROM a" for c in NUMERIC)
)
def distinct_counts(spark, d):
    from scorespark.sources.applicants import applicants

    return mt.distinct_counts(applicants(spark, d), NUMERIC)


# --- bands, points, decisions ---------------------------------------------------

BANDED = f"{SCORED}, {banded_cte(where=TEST)}"
_SUMMARY = f"""sm AS (SELECT q.band, q.band_rank, COUNT(b.bad) AS n, ROUND(AVG(score), 6) AS avg_score, ROUND(AVG(pd), 6) AS avg_pd,
  ROUND(AVG(bad), 6) AS bad_rate FROM {BAND_LIST} q LEFT JOIN b ON b.band = q.band GROUP BY q.band, q.band_rank)"""


@query(f"{BANDED}, {_SUMMARY} SELECT * FROM sm")
def band_summary(spark, d):
    return rounded(held_out_band_summary(spark, d), "avg_score", "avg_pd", "bad_rate")


@query(
    f"""WITH {scored_cte(None)}, {banded_cte()}, {_SUMMARY} SELECT * FROM sm"""
)
def band_summary_all_rows(spark, d):
    scored = stage(frozen_scores_all(spark, d), "scored")
    found = bn.band_summary(bn.fit_bands(scored).apply(scored))
    return rounded(found, "avg_score", "avg_pd", "bad_rate")


@query(
    f"""WITH {scored_cte('two')}, f2 AS (SELECT * REPLACE (num_accounts_assess AS score) FROM f),
{banded_cte('f2')}, {_SUMMARY} SELECT * FROM sm"""
)
def band_summary_tied_scores(spark, d):
    """Bands of a score with a handful of values: edges merge, labels run down from A."""
    scored = frozen_scores(spark, d).withColumn("score", F.col("num_accounts_assess"))
    found = bn.band_summary(bn.fit_bands(scored).apply(scored))
    return rounded(found, "avg_score", "avg_pd", "bad_rate")


@query(
    f"""{BANDED}, {_SUMMARY}, st AS (SELECT bad_rate > LAG(bad_rate) OVER (ORDER BY band_rank) AS rises FROM sm WHERE n > 0)
SELECT COUNT(*) AS n_bands, BOOL_AND(COALESCE(rises, TRUE)) AS monotone FROM st"""
)
def band_monotone(spark, d):
    return bn.bands_monotone(held_out_band_summary(spark, d))


@query(f"{BANDED} SELECT dummy_id, {sql_r6('pd', 'pd')}, {sql_r6('score', 'score')}, bad AS target, band FROM b")
def score_frozen(spark, d):
    test = _test(spark, d)
    banded = bn.fit_bands(test).apply(test)
    return banded.select(
        "dummy_id", r6("pd").alias("pd"), r6("score").alias("score"), F.col("bad").alias("target"), "band"
    )


@query(
    f"""{SCORED} SELECT dummy_id,
  ROUND({dbl(600 - 20 / 0.6931471805599453 * 3.912023005428146)} + {dbl(POINTS_SCALE.factor)} * LN((1e0 - LEAST(GREATEST(pd, 1e-6), 1e0 - 1e-6)) / LEAST(GREATEST(pd, 1e-6), 1e0 - 1e-6)), 6) AS score
  FROM f"""
)
def score_points_scale(spark, d):
    """The same probabilities on the 600 / 20 / 50 scale."""
    scored = frozen_scores(spark, d)
    return scored.select("dummy_id", r6(build_score(F.col("pd"), 600, 20, 50)).alias("score"))


_DEVIATIONS = ", ".join(f"STDDEV_POP({c}) AS {c}" for c in MODEL_INPUTS)
_POINTS = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, ROUND({dbl(w)} * {c}, 6) AS coefficient,
  ROUND_EVEN(-({dbl(w)} * {c}) * {dbl(POINTS_SCALE.factor)}, 2) AS points_per_unit,
  ROUND_EVEN({dbl(POINTS_SCALE.offset / len(MODEL_INPUTS))}, 2) AS base_score_share FROM dev"""
    for c, w in sd.FROZEN_MODEL.coefficients.items()
)


def _scaled_model(spark, d):
    scored = frozen_scores(spark, d)
    deviations = fit_scaler(scored, columns=MODEL_INPUTS).deviations
    return sd.FROZEN_MODEL.on_scaled(deviations)


@query(f"{SCORED}, dev AS (SELECT {_DEVIATIONS} FROM f WHERE split = 'train') {_POINTS}")
def points_table(spark, d):
    return rounded(sd.build_scorecard(_scaled_model(spark, d).table(spark)), "coefficient")


@query(
    f"""{SCORED}, dev AS (SELECT {_DEVIATIONS} FROM f WHERE split = 'train'), co AS ({_POINTS})
SELECT feature, ABS(coefficient) AS importance FROM co ORDER BY importance DESC, feature LIMIT 20"""
)
def coefficient_importance(spark, d):
    return rounded(ex.top_coefficients(_scaled_model(spark, d).table(spark)), "importance")


_DECIDED = f"""{SCORED}, dc AS (SELECT dummy_id, {points_expr()} AS score, bad AS actual_bad FROM f WHERE {TEST}),
de AS (SELECT dummy_id, score, CASE WHEN score >= {{hi}} THEN 'APPROVE' WHEN score < {{lo}} THEN 'DECLINE' ELSE 'REFER' END AS decision,
  actual_bad FROM dc)"""


@query(_DECIDED.format(hi=620, lo=560) + " SELECT * FROM de")
def decisions(spark, d):
    return sd.scoring_report(_test(spark, d), sd.FROZEN_MODEL)


@query(_DECIDED.format(hi=545, lo=515) + " SELECT decision, COUNT(*) AS n FROM de GROUP BY decision")
def decision_counts(spark, d):
    report = sd.scoring_report(_test(spark, d), sd.FROZEN_MODEL, approve_cutoff=545, decline_cutoff=515)
    return sd.decision_counts(report)


@query(f"{SCORED} SELECT dummy_id, {points_expr()} AS points FROM f")
def score_integer(spark, d):
    return sd.score_dataset(frozen_scores(spark, d), sd.FROZEN_MODEL).select("dummy_id", "points")


# --- weight of evidence ---------------------------------------------------------

WOE_COLUMNS = NUMERIC
_TRAIN_IMPUTED = f"""WITH {split_cte('shares')}, {imputed_cte('s', WOE_COLUMNS, "split = 'train'")},
tr AS (SELECT * FROM i WHERE split = 'train')"""


def _woe_sql(edges_of) -> str:
    edges = ", ".join(f"{edges_of(c)} AS {c}" for c in WOE_COLUMNS)
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({bin_of('tr.' + c, 'ed.' + c)} AS INTEGER) AS bin, bad FROM tr CROSS JOIN ed"
        for c in WOE_COLUMNS
    )
    every = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {c} AS e, CAST(UNNEST(RANGE(1, GREATEST(2, LEN({c})))) AS INTEGER) AS bin FROM ed"
        for c in WOE_COLUMNS
    )
    return f""", ed AS (SELECT {edges}), rows_ AS ({rows}), every AS ({every}),
c1 AS (SELECT v.feature, v.bin, MIN(v.e[v.bin]) AS lo, MIN(v.e[LEAST(v.bin + 1, LEN(v.e))]) AS hi, COUNT(bad) AS total,
  CAST(COALESCE(SUM(bad), 0) AS BIGINT) AS bads FROM every v LEFT JOIN rows_ r ON r.feature = v.feature AND r.bin = v.bin GROUP BY v.feature, v.bin),
c2 AS (SELECT *, total - bads AS goods, COUNT(*) OVER w AS k, SUM(total - bads) OVER w AS tg, SUM(bads) OVER w AS tb
  FROM c1 WINDOW w AS (PARTITION BY feature)),
c3 AS (SELECT *, (goods + 0.5e0) / (tg + 0.5e0 * k) AS dg, (bads + 0.5e0) / (tb + 0.5e0 * k) AS db FROM c2),
c4 AS (SELECT *, LN(dg / db) AS w, (dg - db) * LN(dg / db) AS iv FROM c3),
woe AS (SELECT feature, bin, ROUND(lo, 6) AS lo, ROUND(hi, 6) AS hi, total, bads, goods, ROUND(dg, 6) AS dist_good, ROUND(db, 6) AS dist_bad, ROUND(w, 6) AS woe,
  ROUND(iv, 6) AS iv_bin, ROUND(SUM(iv) OVER (PARTITION BY feature), 6) AS iv_total, iv FROM c4)"""


_QUANTILE_WOE = _TRAIN_IMPUTED + _woe_sql(lambda c: quantile_edges(c, "tr", 10))


def _width_edges(c: str) -> str:
    k = f"LEAST(10, COUNT(DISTINCT {c}))"
    return (
        f"(SELECT CASE WHEN MIN({c}) = MAX({c}) THEN [MIN({c})] ELSE LIST_APPEND(LIST_TRANSFORM(RANGE(0, {k}), "
        f"lambda i: MIN({c}) + i * ((MAX({c}) - MIN({c})) / {k})), MAX({c})) END FROM tr)"
    )


_WOE_DOUBLES = ("lo", "hi", "dist_good", "dist_bad", "woe", "iv_bin", "iv_total")


@query(_QUANTILE_WOE + " SELECT * EXCLUDE (iv) FROM woe")
def woe_table(spark, d):
    train = stage(_imputed_train(spark, d, WOE_COLUMNS), "train")
    return rounded(bn.woe_iv_table(train, bn.fit_quantile_bins(train, WOE_COLUMNS)), *_WOE_DOUBLES)


@query(_TRAIN_IMPUTED + _woe_sql(_width_edges) + " SELECT * EXCLUDE (iv) FROM woe")
def woe_table_equal_width(spark, d):
    train = stage(_imputed_train(spark, d, WOE_COLUMNS), "train")
    return rounded(bn.woe_iv_table(train, bn.fit_equal_width_bins(train, WOE_COLUMNS)), *_WOE_DOUBLES)


@query(_QUANTILE_WOE + " SELECT feature, ROUND(SUM(iv), 6) AS iv FROM woe GROUP BY feature")
def iv_table(spark, d):
    train = stage(_imputed_train(spark, d, WOE_COLUMNS), "train")
    return rounded(bn.compute_iv_all(train, WOE_COLUMNS), "iv")


@query(
    _QUANTILE_WOE
    + """, ivs AS (SELECT feature, SUM(iv) AS v FROM woe GROUP BY feature)
SELECT feature, ROUND(v, 6) AS iv, CASE WHEN v > 0.3 THEN 'strong' WHEN v > 0.1 THEN 'medium' ELSE 'weak' END AS strength
FROM ivs ORDER BY v DESC, feature LIMIT 20"""
)
def iv_top20(spark, d):
    train = stage(_imputed_train(spark, d, WOE_COLUMNS), "train")
    return rounded(bn.strongest_features(bn.compute_iv_all(train, WOE_COLUMNS)), "iv")


# --- calibration tables and histograms -------------------------------------------


@query(
    f"""{TEST_ROWS}, z AS (SELECT *, 1 + {' + '.join(f'CAST(pd > {dbl(i * 0.1)} AS INTEGER)' for i in range(1, 10))} AS bin FROM x)
SELECT bin, COUNT(*) AS n, {sql_r6('AVG(pd)', 'mean_predicted')}, {sql_r6('AVG(bad)', 'observed_rate')} FROM z GROUP BY bin"""
)
def reliability(spark, d):
    return rounded(mt.reliability_table(_test(spark, d)), "mean_predicted", "observed_rate")


_HIST = "LEAST(50, CAST(FLOOR(COALESCE(({c} - lo) / NULLIF(hi - lo, 0), 0) * 50) AS INTEGER) + 1)"


@query(
    f"""{TEST_ROWS}, mm AS (SELECT MIN(pd) AS lo, MAX(pd) AS hi FROM x)
SELECT {_HIST.format(c='pd')} AS bin, COUNT(*) AS n FROM x CROSS JOIN mm GROUP BY 1"""
)
def pd_histogram(spark, d):
    return mt.histogram(_test(spark, d), "pd")


@query(
    f"""{TEST_ROWS}, mm AS (SELECT bad, MIN(score) AS lo, MAX(score) AS hi FROM x GROUP BY bad)
SELECT x.bad, {_HIST.format(c='score')} AS bin, COUNT(*) AS n FROM x JOIN mm ON mm.bad = x.bad GROUP BY 1, 2"""
)
def score_hist_by_class(spark, d):
    return mt.histogram(_test(spark, d), "score", by="bad")


# --- attributions ----------------------------------------------------------------

_MEANS = ", ".join(f"AVG({c}) AS {c}" for c in MODEL_INPUTS)
_PHI = {c: f"{dbl(w)} * (x.{c} - mu.{c})" for c, w in sd.FROZEN_MODEL.coefficients.items()}
_SHAP = f"{TEST_ROWS}, mu AS (SELECT {_MEANS} FROM f WHERE split = 'train'), sh AS (" + " UNION ALL ".join(
    f"SELECT dummy_id, '{c}' AS feature, x.{c} AS value, {e} AS phi FROM x CROSS JOIN mu" for c, e in _PHI.items()
) + ")"


def _explained(spark, d):
    scored = frozen_scores(spark, d)
    means = ex.feature_means(scored.where(F.col("split") == "train"), MODEL_INPUTS)
    return scored.where(F.col("split") == "test"), means


@query(f"{_SHAP} SELECT dummy_id, feature, value, ROUND(phi, 6) AS phi FROM sh")
def shap_linear(spark, d):
    test, means = _explained(spark, d)
    return rounded(ex.linear_shap(test, sd.FROZEN_MODEL, means), "phi")


@query(f"{_SHAP} SELECT feature, ROUND(AVG(ABS(phi)), 6) AS mean_abs_shap FROM sh GROUP BY feature")
def shap_importance(spark, d):
    test, means = _explained(spark, d)
    return rounded(ex.shap_importance(test, sd.FROZEN_MODEL, means), "mean_abs_shap")


@query(
    f"""{_SHAP}, best AS (SELECT feature FROM sh GROUP BY feature ORDER BY AVG(ABS(phi)) DESC, feature LIMIT 4)
SELECT dummy_id, feature, value, ROUND(phi, 6) AS phi FROM sh WHERE feature IN (SELECT feature FROM best)"""
)
def shap_dependence(spark, d):
    test, means = _explained(spark, d)
    return rounded(ex.shap_dependence(test, sd.FROZEN_MODEL, means), "phi")


@query(f"WITH {split_cte('two')} SELECT dummy_id, bad FROM s WHERE {TEST} ORDER BY dummy_id LIMIT 2000")
def explain_head(spark, d):
    from scorespark.operators.splitting import two_way

    test = split_base(spark, d, ["dummy_id", "bad"], two_way()).where(F.col("split") == "test")
    return ex.head_rows(test, "dummy_id", 2000).drop("split")


def _sample_sql(n: int) -> str:
    return f"""WITH {split_cte('two')} SELECT dummy_id, bad FROM s WHERE {TEST}
ORDER BY md5(CAST(dummy_id AS VARCHAR) || ':42'), dummy_id LIMIT {n}"""


@query(_sample_sql(100))
def background_sample(spark, d):
    return _sampled(spark, d, 100)


@query(_sample_sql(500))
def test_sample(spark, d):
    return _sampled(spark, d, 500)


def _sampled(spark, d, n):
    from scorespark.operators.splitting import two_way

    test = split_base(spark, d, ["dummy_id", "bad"], two_way()).where(F.col("split") == "test")
    return ex.sample_rows(test, "dummy_id", n).drop("split")


# --- report tables ---------------------------------------------------------------


@query(f"{BANDED}, {_SUMMARY} SELECT * FROM sm")
def report_tables(spark, d):
    """The band table written as a csv report and read back with its schema."""
    found = rounded(held_out_band_summary(spark, d), "avg_score", "avg_pd", "bad_rate")
    path = scratch_path(spark, "report")
    sinks.write_report(found, path, "csv")
    return spark.read.schema(found.schema).option("header", True).csv(path)


_STACK = f"""{TEST_ROWS}, both_ AS (SELECT 'scorecard' AS model, pd, bad FROM x
  UNION ALL SELECT 'single_feature', num_accounts_assess / 7, bad FROM x), {cumulative_cte('both_', 'pd', key='model')}"""


def _two_models(spark, d):
    test = _test(spark, d)
    return test.select(F.lit("scorecard").alias("model"), "pd", "bad").unionByName(
        test.select(F.lit("single_feature").alias("model"), (F.col("num_accounts_assess") / 7).alias("pd"), "bad")
    )


@query(
    f"""{_STACK} SELECT model, CAST(SUM(g + b) AS BIGINT) AS n, {sql_r6(_AUC, 'auc')}, {sql_r6(f'2 * ({_AUC}) - 1', 'gini')},
  {sql_r6('MAX(ABS(cb / tb - cg / tg))', 'ks')}, {sql_r6('SUM(g * s * s + b * (1 - s) * (1 - s)) / SUM(g + b)', 'brier')}
  FROM cum GROUP BY model"""
)
def stacked_metrics(spark, d):
    found = mt.discrimination(_two_models(spark, d), keys=["model"])
    return rounded(found, "auc", "gini", "ks", "brier").drop("n_bad", "ks_one_sided")


@query(
    f"""{_STACK}, me AS (SELECT model, ROUND({_AUC}, 4) AS auc, ROUND(MAX(ABS(cb / tb - cg / tg)), 4) AS ks FROM cum GROUP BY model)
SELECT '{{' || STRING_AGG('"' || model || '":{{"auc":' || CAST(auc AS VARCHAR) || ',"ks":' || CAST(ks AS VARCHAR) || '}}', ',' ORDER BY model) || '}}' AS json FROM me"""
)
def metrics_json(spark, d):
    found = mt.discrimination(_two_models(spark, d), keys=["model"], brier=False)
    short = found.withColumns({c: F.round(c, 4) for c in ("auc", "ks")})
    path = scratch_path(spark, "metrics")
    sinks.write_metrics_json(short, path, values=["auc", "ks"])
    return spark.read.text(path).withColumnRenamed("value", "json")
