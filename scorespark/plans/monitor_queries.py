"""Queries on stability, drift, outcomes and model versions, in batch and as streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorespark.functions.scoring import pd_to_score
from scorespark.models.logistic import fit_logistic
from scorespark.operators import monitoring as mo
from scorespark.operators.bands import band_summary as summarise
from scorespark.operators.bands import bands_monotone, fit_bands, fit_quantile_bins
from scorespark.operators.metrics import discrimination
from scorespark.operators.preparing import fit_imputer
from scorespark.operators.quantiles import grouped_quantiles
from scorespark.operators.scorecard import FROZEN_MODEL, LinearModel
from scorespark.operators.splitting import fit_cuts, two_way
from scorespark.plans.frozen import MODEL_INPUTS, base, frozen_scores, frozen_scores_all, split_base
from scorespark.plans.registry import query, r6, rounded
from scorespark.plans.sql import (
    NUMERIC,
    banded_cte,
    bin_of,
    cumulative_cte,
    margin,
    quantile_edges,
    scored_cte,
    split_cte,
)
from scorespark.session import scratch_path, stage, values_table
from scorespark.sources import applicants as src
from scorespark.sources.readers import table
from scorespark.sources import registry
from scorespark.sources.artefacts import Scorer, scored
from scorespark.sources.registry import current_version
from scorespark.sources.sinks import dataset_hash
from scorespark.sources.triggers import Retrained, retrain_on, trigger_name, triggers
from scorespark.streaming import runs
from scorespark.streaming.matching import match_outcomes

# --- population stability ---------------------------------------------------------

PSI_COLUMNS = list(NUMERIC)


def _psi_sql(edge_source: str, sides: str, columns: list[str]) -> str:
    """CTE ``psi(feature, psi)``; ``sides`` is a relation with the columns and is_base."""
    edges = ", ".join(f"{quantile_edges(c, edge_source, 10)} AS {c}" for c in columns)
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {bin_of('z.' + c, 'ed.' + c)} AS bin, is_base FROM {sides} z CROSS JOIN ed WHERE z.{c} IS NOT NULL"
        for c in columns
    )
    every = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, UNNEST(RANGE(1, GREATEST(2, LEN({c})))) AS bin FROM ed" for c in columns
    )
    return f"""ed AS (SELECT {edges}), rows_ AS ({rows}), every AS ({every}),
c1 AS (SELECT v.feature, v.bin, COALESCE(SUM(is_base), 0) AS e, COALESCE(SUM(1 - is_base), 0) AS a
  FROM every v LEFT JOIN rows_ r ON r.feature = v.feature AND r.bin = v.bin GROUP BY v.feature, v.bin),
c2 AS (SELECT feature, (e + 0.5e0) / (SUM(e) OVER w + 0.5e0 * COUNT(*) OVER w) AS e,
  (a + 0.5e0) / (SUM(a) OVER w + 0.5e0 * COUNT(*) OVER w) AS a FROM c1 WINDOW w AS (PARTITION BY feature)),
psi AS (SELECT feature, SUM((a - e) * LN(a / e)) AS psi FROM c2 GROUP BY feature)"""


_PSI_SPLIT = f"""{split_cte('two')}, base_ AS (SELECT * FROM s WHERE split = 'train'),
sides AS (SELECT *, CAST(split = 'train' AS INTEGER) AS is_base FROM s), {_psi_sql('base_', 'sides', PSI_COLUMNS)}"""


def _psi_splits(spark, d):
    df = split_base(spark, d, ["dummy_id", "bad", *PSI_COLUMNS], two_way())
    train, test = df.where(F.col("split") == "train"), df.where(F.col("split") == "test")
    return mo.population_stability(train, test, fit_quantile_bins(train, PSI_COLUMNS))


@query(f"WITH {_PSI_SPLIT} SELECT feature, ROUND(psi, 6) AS psi FROM psi")
def psi_features(spark, d):
    return rounded(_psi_splits(spark, d), "psi")


WEEK_SQL = "STRFTIME(DATE_TRUNC('week', ts), '%Y-%m-%d')"


def _week():
    return F.date_format(F.date_trunc("week", F.col("ts")), "yyyy-MM-dd")


_WEEKLY = f"""ev AS (SELECT {WEEK_SQL} AS period, value FROM events), first_ AS (SELECT MIN(period) AS p FROM ev),
base_ AS (SELECT value FROM ev, first_ WHERE period = p),
ed AS (SELECT {quantile_edges('value', 'base_', 10)} AS e),
every AS (SELECT UNNEST(RANGE(1, GREATEST(2, LEN(e)))) AS bin FROM ed),
cn AS (SELECT period, {bin_of('value', 'e')} AS bin, COUNT(*) AS n FROM ev CROSS JOIN ed GROUP BY 1, 2),
ex AS (SELECT v.bin, COALESCE(n, 0) AS e FROM every v LEFT JOIN (SELECT cn.* FROM cn, first_ WHERE period = p) b ON b.bin = v.bin),
c1 AS (SELECT q.period, ex.bin, ex.e, COALESCE(cn.n, 0) AS a FROM (SELECT DISTINCT period FROM cn) q CROSS JOIN ex
  LEFT JOIN cn ON cn.period = q.period AND cn.bin = ex.bin),
c2 AS (SELECT period, (e + 0.5e0) / (SUM(e) OVER w + 0.5e0 * COUNT(*) OVER w) AS e,
  (a + 0.5e0) / (SUM(a) OVER w + 0.5e0 * COUNT(*) OVER w) AS a FROM c1 WINDOW w AS (PARTITION BY period)),
psi AS (SELECT period, SUM((a - e) * LN(a / e)) AS psi FROM c2 GROUP BY period)"""


def _weekly(spark, d):
    """Events with their week, baseline bins and baseline counts of the first week."""
    events = table(spark, d, "events").select("ts", "value").withColumn("period", _week())
    first = events.agg(F.min("period")).first()[0]
    baseline = events.where(F.col("period") == first)
    edges = fit_quantile_bins(baseline, ["value"])
    counts = mo.period_bin_counts(baseline, "value", edges, F.col("period"))
    return events, edges, counts.select("bin", "n")


@query(f"WITH {_WEEKLY} SELECT period, ROUND(psi, 6) AS psi FROM psi")
def psi_weekly(spark, d):
    events, edges, baseline = _weekly(spark, d)
    counts = mo.period_bin_counts(events, "value", edges, F.col("period"))
    return rounded(mo.psi_from_period_counts(counts, edges, "value", baseline), "psi")


_DOUBLED = _WEEKLY.replace(
    "cn AS (SELECT period,", "cn0 AS (SELECT value * 2 AS value, period FROM ev),\ncb AS (SELECT period,"
).replace("(SELECT cn.* FROM cn, first_", "(SELECT cb.* FROM cb, first_").replace(
    "ex AS (SELECT v.bin,", f"cn AS (SELECT period, {bin_of('value', 'e')} AS bin, COUNT(*) AS n FROM cn0 CROSS JOIN ed GROUP BY 1, 2),\nex AS (SELECT v.bin,"
)


@query(f"WITH {_DOUBLED} SELECT period, ROUND(psi, 6) AS psi FROM psi WHERE psi > 0.2")
def drift_alerts(spark, d):
    """Every week with its values doubled stands out against the first week."""
    events, edges, baseline = _weekly(spark, d)
    shifted = events.withColumn("value", F.col("value") * 2)
    counts = mo.period_bin_counts(shifted, "value", edges, F.col("period"))
    return rounded(mo.drift_alerts(mo.psi_from_period_counts(counts, edges, "value", baseline)), "psi")


_AUC = "SUM(b * (cg - g / 2)) / (MAX(tg) * MAX(tb))"


@query(
    f"""WITH {scored_cte('two')}, x AS (SELECT * FROM f WHERE split = 'test'), {cumulative_cte('x', 'pd')},
me AS (SELECT {_AUC} AS auc, MAX(ABS(cb / tb - cg / tg)) AS ks FROM cum),
{banded_cte(where="split = 'test'", name='bd')},
st AS (SELECT band, AVG(bad) AS rate FROM bd GROUP BY band),
mono AS (SELECT BOOL_AND(COALESCE(rate > prev, TRUE)) AS m FROM (SELECT rate, LAG(rate) OVER (ORDER BY band) AS prev FROM st)),
base_ AS (SELECT score FROM f WHERE split = 'train'), sides AS (SELECT score, CAST(split = 'train' AS INTEGER) AS is_base FROM f),
{_psi_sql('base_', 'sides', ['score'])}
SELECT ROUND(auc, 6) AS auc, ROUND(ks, 6) AS ks, ROUND(psi, 6) AS max_psi, m AS bands_monotone,
  auc > 0.6 AND auc < 0.95 AS auc_ok, ks >= 0.2 AS ks_ok, psi <= 0.25 AS psi_ok,
  auc > 0.6 AND auc < 0.95 AND ks >= 0.2 AND psi <= 0.25 AND m AS passed FROM me, mono, psi""".replace(
        "edges AS (", "edges_ AS ("
    ).replace("CROSS JOIN edges)", "CROSS JOIN edges_)")
)
def gate(spark, d):
    scored = stage(frozen_scores(spark, d).select("dummy_id", "bad", "split", "pd", "score"), "scored")
    train, test = scored.where(F.col("split") == "train"), scored.where(F.col("split") == "test")
    psi = mo.population_stability(train, test, fit_quantile_bins(train, ["score"]))
    monotone = bands_monotone(summarise(fit_bands(test).apply(test)))
    return rounded(mo.validation_gate(discrimination(test), monotone, psi), "auc", "ks", "max_psi")


# --- request log ------------------------------------------------------------------

_LOG = f"""lg AS (SELECT event_id AS request_id, ts, user_id AS applicant_id, value, CAST(props ->> '$.k' AS INTEGER) AS k,
  CAST(props ->> '$.k' AS INTEGER) % 2 AS model_version, {WEEK_SQL} AS week FROM events)"""


@query(
    f"""WITH {_LOG} SELECT week, model_version, ROUND(QUANTILE_CONT(value, 5e-1), 6) AS p50, ROUND(QUANTILE_CONT(value, 95e-2), 6) AS p95,
  ROUND(QUANTILE_CONT(value, 99e-2), 6) AS p99 FROM lg GROUP BY week, model_version"""
)
def latency_percentiles(spark, d):
    log = src.request_log(spark, d).withColumn("week", _week())
    found = grouped_quantiles(log, ["week", "model_version"], "value", [0.5, 0.95, 0.99])
    return rounded(found, "p50", "p95", "p99")


@query(
    f"""WITH {_LOG} SELECT week AS period, 'value' AS feature, MIN(value) AS min_value, MAX(value) AS max_value FROM lg GROUP BY week
UNION ALL SELECT week, 'k', CAST(MIN(k) AS DOUBLE), CAST(MAX(k) AS DOUBLE) FROM lg GROUP BY week"""
)
def value_ranges(spark, d):
    return mo.value_ranges(src.request_log(spark, d), ["value", "k"], _week())


@query(f"WITH {_LOG} SELECT request_id, ts, applicant_id, value, model_version FROM lg ORDER BY ts DESC, request_id DESC LIMIT 50")
def recent_50(spark, d):
    log = src.request_log(spark, d).select("request_id", "ts", "applicant_id", "value", "model_version")
    return mo.recent_scores(log)


@query(
    """WITH pr AS (SELECT CAST(props ->> '$.k' AS INTEGER) AS version, MAX(ts) AS promoted_at FROM events
  WHERE event_type = 'purchase' GROUP BY 1)
SELECT version, promoted_at FROM pr ORDER BY promoted_at DESC, version DESC LIMIT 1"""
)
def current_model(spark, d):
    """The registry pointer over promotions taken from the request log."""
    log = src.request_log(spark, d).where(F.col("event_type") == "purchase")
    promoted = log.groupBy(F.col("k").alias("version")).agg(F.max("ts").alias("promoted_at"))
    return current_version(promoted)


@query(
    """SELECT user_id, COUNT(*) FILTER (ts < TIMESTAMP '2024-01-15') AS n_assess,
  MAX(value) FILTER (ts < TIMESTAMP '2024-01-15') AS worst_assess, MIN(ts) FILTER (ts < TIMESTAMP '2024-01-15') AS oldest_assess,
  COUNT(*) FILTER (ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-22') AS n_perf,
  MAX(value) FILTER (ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-22') AS worst_perf,
  MIN(ts) FILTER (ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-22') AS oldest_perf FROM events GROUP BY user_id"""
)
def assess_perf_window(spark, d):
    start = F.lit("2024-01-15").cast("timestamp_ntz")
    return mo.window_features(table(spark, d, "events"), "user_id", "ts", "value", start, 7)


# --- outcomes ---------------------------------------------------------------------

_OUTCOMES = """oc AS (SELECT l_orderkey AS applicant_id, MAX(l_shipdate) AS observed_at,
  CASE WHEN SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) >= 2 THEN 1 ELSE 0 END AS bad FROM lineitem GROUP BY l_orderkey)"""
_AUDIT = f"""WITH {scored_cte(None)}, {banded_cte()}, {_OUTCOMES},
au AS (SELECT dummy_id AS applicant_id, o_orderdate AS scored_at, pd, score, band FROM b JOIN orders ON o_orderkey = dummy_id)"""


def audit(spark, d):
    """One scored application per row, with its time and band."""
    scored = stage(frozen_scores_all(spark, d).select("dummy_id", "pd", "score"), "scored")
    banded = fit_bands(scored).apply(scored).withColumnRenamed("dummy_id", "applicant_id")
    return banded.join(src.application_times(spark, d), "applicant_id")


@query(
    f"""{_AUDIT} SELECT au.applicant_id, scored_at, observed_at, ROUND(pd, 6) AS pd, ROUND(score, 6) AS score, band, bad
FROM au JOIN oc ON oc.applicant_id = au.applicant_id WHERE observed_at >= scored_at AND observed_at < scored_at + INTERVAL 730 DAY"""
)
def retrain_join(spark, d):
    return rounded(mo.retraining_rows(audit(spark, d), src.outcomes(spark, d), 730), "pd", "score")


@query(
    f"""{_AUDIT} SELECT band, COUNT(*) AS n_scored, COUNT(bad) AS n_observed, ROUND(AVG(pd), 6) AS avg_pd,
  ROUND(AVG(pd) FILTER (bad IS NOT NULL), 6) AS avg_pd_observed, ROUND(AVG(bad), 6) AS realised_rate
FROM au LEFT JOIN oc ON oc.applicant_id = au.applicant_id GROUP BY band"""
)
def realised_vs_pd(spark, d):
    found = mo.realised_vs_predicted(audit(spark, d), src.outcomes(spark, d))
    return rounded(found, "avg_pd", "avg_pd_observed", "realised_rate")


@query(
    f"""{_AUDIT} SELECT applicant_id, scored_at, ROUND(pd, 6) AS pd, band FROM au
WHERE applicant_id NOT IN (SELECT applicant_id FROM oc)"""
)
def pending_outcomes(spark, d):
    waiting = mo.pending_outcomes(audit(spark, d), src.outcomes(spark, d))
    return rounded(waiting.select("applicant_id", "scored_at", "pd", "band"), "pd")


@query(
    f"""{_AUDIT}, rt AS (SELECT au.applicant_id, oc.bad FROM au JOIN oc ON oc.applicant_id = au.applicant_id
  WHERE observed_at >= scored_at AND observed_at < scored_at + INTERVAL 730 DAY)
SELECT CAST(1 AS INTEGER) AS version, COUNT(*) AS n_rows, CAST(SUM(bad) AS BIGINT) AS n_bad, TRUE AS auc_ok, TRUE AS passed FROM rt"""
)
def retrained_model(spark, d):
    """A scorecard refitted on applications with observed outcomes, tested, gated and registered.

    Medians and coefficients come from the training rows, all figures from the test rows.
    """
    split, found = _retrain(spark, d)
    root = scratch_path(spark, "retrained-models")
    version = registry.register_model(found.model, root, found.auc, found.ks, found.data_hash, gate=found.gate)
    known = registry.versions(spark, root).where(F.col("version") == version)
    counts = split.agg(F.count("*").alias("n_rows"), F.sum("bad").alias("n_bad"))
    return counts.join(known).join(found.gate).select(
        "version", "n_rows", "n_bad", "auc_ok", "passed"
    )


def _retrain(spark, d):
    """The split rows of a retrain and what it hands to the registry."""
    rows = mo.retraining_rows(audit(spark, d).select("applicant_id", "scored_at"), src.outcomes(spark, d), 730)
    inputs = base(spark, d, ["dummy_id", *MODEL_INPUTS])
    joined = stage(rows.join(inputs, F.col("applicant_id") == F.col("dummy_id")), "retrain")
    split = stage(fit_cuts(joined, two_way()).apply(joined), "retrain")
    imputer = fit_imputer(split, columns=MODEL_INPUTS, categorical=False)
    filled = stage(imputer.apply(split), "retrain")
    train, test = filled.where("split = 'train'"), filled.where("split = 'test'")
    model = fit_logistic(train, list(MODEL_INPUTS))
    pd = train.select("bad", model.pd().alias("pd")).withColumn("score", pd_to_score(F.col("pd")))
    scorer = Scorer(imputer, model, fit_bands(pd))
    scored = stage(scorer.apply(test), "retrained")
    metrics = stage(discrimination(scored), "retrained-metrics")
    psi = mo.population_stability(pd, scored, fit_quantile_bins(pd, ["score"]))
    gate = mo.validation_gate(metrics, bands_monotone(summarise(scored)), psi)
    figures = metrics.first()
    digest = dataset_hash(split.select("dummy_id", "bad", *MODEL_INPUTS)).first()["sum_digest"]
    return split, Retrained(scorer, figures["auc"], figures["ks"], digest, gate)


# --- champion and challenger --------------------------------------------------------

CHALLENGER = LinearModel(
    {"num_accounts_assess": 0.5, "risk_drivers": 0.02, "risk_mitigators": -0.001, "r_ho_em2_co": 0.004, "dim_judgement": -0.00001},
    -3.0,
)
_BOTH = f"""WITH {scored_cte(None)}, r AS (SELECT * FROM f), edges AS (SELECT {quantile_edges('score', 'r', 5)} AS e),
ch AS (SELECT *, 1e0 / (1e0 + EXP(-({margin(CHALLENGER)}))) AS pd2 FROM f),
lab AS (SELECT dummy_id, pd, pd2, SUBSTR('ABCDE', CAST(LEN(e) - {bin_of('score', 'e')} AS INTEGER), 1) AS b1,
  SUBSTR('ABCDE', CAST(LEN(e) - {bin_of('score2', 'e')} AS INTEGER), 1) AS b2
  FROM (SELECT *, 600e0 - 50 / LN(2e0) * LN(20e0) + 50 / LN(2e0) * LN((1e0 - pd2) / pd2) AS score2 FROM ch) CROSS JOIN edges)"""


def shadow_log(spark, d):
    """Both models' answers to every request, in long form as a scoring log keeps them."""
    scored = stage(frozen_scores_all(spark, d), "scored")
    bands = fit_bands(scored)
    champion = scored.select("dummy_id", F.lit(0).alias("model_version"), "pd", "score")
    challenger_pd = scored.withColumn("pd", CHALLENGER.pd())
    challenger = challenger_pd.select(
        "dummy_id", F.lit(1).alias("model_version"), "pd", pd_to_score(F.col("pd")).alias("score")
    )
    return bands.apply(champion.unionByName(challenger)).withColumnRenamed("dummy_id", "request_id")


@query(
    _BOTH
    + " SELECT b1 AS champion_band, "
    + ", ".join(f"COUNT(*) FILTER (b2 = '{b}') AS to_{b.lower()}" for b in "ABCDE")
    + " FROM lab GROUP BY b1"
)
def shadow_migration(spark, d):
    return mo.band_migration(mo.shadow_pairs(shadow_log(spark, d), 0, 1))


@query(
    _BOTH
    + """ SELECT COUNT(*) AS n, ROUND(AVG(CAST(b1 = b2 AS INTEGER)), 6) AS same_band_share, ROUND(AVG(pd2 - pd), 6) AS mean_pd_change,
  ROUND(MAX(ABS(pd2 - pd)), 6) AS max_pd_change FROM lab"""
)
def shadow_agreement(spark, d):
    found = mo.band_agreement(mo.shadow_pairs(shadow_log(spark, d), 0, 1))
    return rounded(found, "same_band_share", "mean_pd_change", "max_pd_change")


@query(
    _BOTH + " SELECT dummy_id, ROUND(pd2, 6) AS pd, 2 AS model_version FROM lab UNION ALL SELECT dummy_id, ROUND(pd, 6), 1 FROM lab"
)
def promoted_scores(spark, d):
    """All applicants scored with the registry's current scorer, before and after a promotion."""
    df = base(spark, d, ["dummy_id", *MODEL_INPUTS])
    imputer = fit_imputer(df, fit_on="all", columns=MODEL_INPUTS, categorical=False)
    root = scratch_path(spark, "scorers")
    filled = imputer.apply(df)
    out = None
    for model in (FROZEN_MODEL, CHALLENGER):
        bands = fit_bands(filled.select(pd_to_score(model.pd()).alias("score")))
        registry.promote(spark, root, registry.register_model(Scorer(imputer, model, bands), root, 0.7, 0.3, "-"))
        found = scored(df, registry.load_current(spark, root), registry.promoted_version(spark, root))
        part = found.select("dummy_id", "pd", "model_version")
        out = part if out is None else out.unionByName(part)
    return rounded(out, "pd")


# --- streams ------------------------------------------------------------------------


def _utc(spark):
    """Weeks of a stream are counted from midnight UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def _event_stream(spark, d):
    _utc(spark)
    schema = table(spark, d, "events").schema
    raw = runs.file_stream(spark, d, schema, "events.parquet")
    return raw.select(F.col("ts").cast("timestamp").alias("ts"), "value", "event_id")


@query(
    f"""WITH {scored_cte(None)}, {banded_cte()} SELECT dummy_id, ROUND(pd, 6) AS pd, ROUND(score, 6) AS score, band, 1 AS model_version FROM b"""
)
def stream_scores(spark, d):
    arriving = scratch_path(spark, "arriving")
    src.applicants(spark, d).select("dummy_id", *MODEL_INPUTS).write.parquet(arriving)
    known = spark.read.parquet(arriving)
    imputer = fit_imputer(known, fit_on="all", columns=MODEL_INPUTS, categorical=False)
    filled = imputer.apply(known).withColumn("score", pd_to_score(FROZEN_MODEL.pd()))
    bands = fit_bands(filled)
    stream = runs.file_stream(spark, arriving, known.schema)
    scored = runs.score_stream(stream, imputer, FROZEN_MODEL.pd(), bands, 1)
    out = scratch_path(spark, "scores")
    columns = scored.select("dummy_id", "pd", "score", "band", "model_version")
    runs.drain(columns, out)
    return rounded(spark.read.parquet(out), "pd", "score")


@query(
    f"""WITH {scored_cte(None)}, {banded_cte()} SELECT dummy_id, band, ROUND(pd, 6) AS pd, 1 AS model_version, TRUE AS timed FROM b"""
)
def audit_append(spark, d):
    """The audit log written by the scoring stream, with request and response read back from JSON.

    A request has been received when its file was written; latency runs from then on.
    """
    arriving = scratch_path(spark, "arriving")
    src.applicants(spark, d).select("dummy_id", *MODEL_INPUTS).write.parquet(arriving)
    known = spark.read.parquet(arriving)
    imputer = fit_imputer(known, fit_on="all", columns=MODEL_INPUTS, categorical=False)
    bands = fit_bands(imputer.apply(known).withColumn("score", pd_to_score(FROZEN_MODEL.pd())))
    stream = runs.file_stream(spark, arriving, known.schema)
    stream = stream.select("*", F.col("_metadata.file_modification_time").alias("received_at"))
    scored = runs.score_stream(stream, imputer, FROZEN_MODEL.pd(), bands, 1)
    out = scratch_path(spark, "audit")
    runs.drain(runs.audit_rows(scored, "dummy_id", list(MODEL_INPUTS), F.col("received_at")), out)
    log = spark.read.parquet(out)
    return log.select(
        F.get_json_object("request", "$.dummy_id").cast("bigint").alias("dummy_id"),
        F.get_json_object("response", "$.band").alias("band"),
        r6(F.get_json_object("response", "$.probability_of_default").cast("double")).alias("pd"),
        "model_version",
        (F.col("ts").isNotNull() & (F.col("latency_ms") > 0)).alias("timed"),
    )


_CLOSED = "WHERE DATE_TRUNC('week', ts) + INTERVAL 7 DAY <= (SELECT MAX(ts) FROM events) - INTERVAL 1 DAY"


_WINDOW_SUMMARY = """COUNT(*) AS n, ROUND(AVG(value), 6) AS avg_value, MIN(value) AS min_value, MAX(value) AS max_value,
  ROUND(QUANTILE_CONT(value, 0.5e0), 6) AS p50, ROUND(QUANTILE_CONT(value, 95e-2), 6) AS p95, ROUND(QUANTILE_CONT(value, 99e-2), 6) AS p99"""
_DAY_SQL = "STRFTIME(ts, '%Y-%m-%d')"
_CLOSED_DAYS = "WHERE DATE_TRUNC('day', ts) + INTERVAL 1 DAY <= (SELECT MAX(ts) FROM events) - INTERVAL 1 DAY"
_HISTOGRAM = tuple(float(20 * k) for k in range(16))


def _two_drains(spark, d, days):
    """Closed windows of the request log, which arrives in two parts with a drain after each."""
    arriving, out = scratch_path(spark, "requests"), scratch_path(spark, "windows")
    log = table(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), "value", "event_id")
    middle = F.expr("timestamp '2024-01-15'")
    for part in (F.col("ts") < middle, F.col("ts") >= middle):
        log.where(part).write.mode("append").parquet(arriving)
        stream = runs.file_stream(spark, arriving, log.schema)
        runs.drain(runs.window_value_counts(stream, "value", days=days), out)
    return spark.read.parquet(out)


@query(f"SELECT {WEEK_SQL} AS period, {_WINDOW_SUMMARY} FROM events {_CLOSED} GROUP BY 1")
def stream_weekly(spark, d):
    _utc(spark)
    summary = runs.window_summary(_two_drains(spark, d, 7))
    return rounded(summary, "avg_value", "p50", "p95", "p99")


@query(f"SELECT {_DAY_SQL} AS period, {_WINDOW_SUMMARY} FROM events {_CLOSED_DAYS} GROUP BY 1")
def stream_daily(spark, d):
    _utc(spark)
    summary = runs.window_summary(_two_drains(spark, d, 1))
    return rounded(summary, "avg_value", "p50", "p95", "p99")


@query(
    f"""SELECT {_DAY_SQL} AS period, CAST(CASE WHEN value <= 20 THEN 1 ELSE LEAST(15, CEIL(value / 20)) END AS INTEGER) AS bin, COUNT(*) AS n FROM events
WHERE {_DAY_SQL} = (SELECT MAX({_DAY_SQL}) FROM events {_CLOSED_DAYS}) GROUP BY 1, 2"""
)
def last_day_histogram(spark, d):
    """Values of the last closed day in bins of 20; the outer bins are open."""
    _utc(spark)
    return runs.last_histogram(_two_drains(spark, d, 1), _HISTOGRAM)


@query(
    f"""WITH {_WEEKLY}, cl AS (SELECT DISTINCT {WEEK_SQL} AS period FROM events {_CLOSED})
SELECT psi.period, ROUND(psi, 6) AS psi, psi > 0.005 AS alert FROM psi JOIN cl ON cl.period = psi.period"""
)
def stream_psi(spark, d):
    _utc(spark)
    _, edges, baseline = _weekly(spark, d)
    out = scratch_path(spark, "psi")
    runs.stream_psi(_event_stream(spark, d), "value", edges, stage(baseline, "baseline"), out, 0.005)
    return rounded(spark.read.parquet(out).drop("batch"), "psi")


@query(
    f"""{_AUDIT} SELECT au.applicant_id, STRFTIME(scored_at, '%Y-%m-%d') AS scored_on, STRFTIME(observed_at, '%Y-%m-%d') AS observed_on,
  ROUND(pd, 6) AS pd, bad FROM au JOIN oc ON oc.applicant_id = au.applicant_id
WHERE observed_at >= scored_at AND observed_at < scored_at + INTERVAL 365 DAY"""
)
def stream_outcomes(spark, d):
    _utc(spark)
    scores_in, outcomes_in = scratch_path(spark, "scored-in"), scratch_path(spark, "outcomes-in")
    scored = audit(spark, d).select("applicant_id", F.col("scored_at").cast("timestamp").alias("scored_at"), "pd")
    scored.write.parquet(scores_in)
    seen = src.outcomes(spark, d).withColumn("observed_at", F.col("observed_at").cast("timestamp"))
    seen.write.parquet(outcomes_in)
    joined = runs.outcome_join(
        runs.file_stream(spark, scores_in, scored.schema),
        runs.file_stream(spark, outcomes_in, seen.schema),
        365,
    )
    out = scratch_path(spark, "matured")
    runs.drain(joined, out)
    return spark.read.parquet(out).select(
        "applicant_id",
        F.date_format("scored_at", "yyyy-MM-dd").alias("scored_on"),
        F.date_format("observed_at", "yyyy-MM-dd").alias("observed_on"),
        r6("pd").alias("pd"),
        "bad",
    )


@query(
    f"""{_AUDIT}, last_ AS (SELECT GREATEST((SELECT MAX(scored_at) FROM au), (SELECT MAX(observed_at) FROM oc)) - INTERVAL 1 DAY AS upto)
SELECT au.applicant_id, STRFTIME(scored_at, '%Y-%m-%d') AS scored_on, STRFTIME(observed_at, '%Y-%m-%d') AS observed_on,
  ROUND(pd, 6) AS pd, bad FROM au JOIN oc ON oc.applicant_id = au.applicant_id CROSS JOIN last_
WHERE observed_at >= scored_at AND observed_at < scored_at + INTERVAL 365 DAY AND observed_at < upto"""
)
def stream_matured(spark, d):
    """Requests whose outcome the watermark has passed, matched with own state over three drains."""
    _utc(spark)
    scores_in, outcomes_in, out = (scratch_path(spark, x) for x in ("scored-in", "outcomes-in", "matured"))
    scored = audit(spark, d).select("applicant_id", F.col("scored_at").cast("timestamp").alias("scored_at"), "pd")
    seen = src.outcomes(spark, d).withColumn("observed_at", F.col("observed_at").cast("timestamp"))
    scored, seen = stage(scored, "scored"), stage(seen, "outcomes")
    borders = [F.lit(t).cast("timestamp") for t in ("1994-01-01", "1997-01-01")]
    for k in range(3):

        def arrived(at):
            now = F.lit(True) if k == 2 else at < borders[k]
            return now & (at >= borders[k - 1]) if k else now

        scored.where(arrived(F.col("scored_at"))).write.mode("append").parquet(scores_in)
        seen.where(arrived(F.col("observed_at"))).write.mode("append").parquet(outcomes_in)
        streams = [runs.file_stream(spark, f, t.schema) for f, t in ((scores_in, scored), (outcomes_in, seen))]
        runs.drain(match_outcomes(*streams, 365), out)
    return spark.read.parquet(out).select(
        "applicant_id",
        F.date_format("scored_at", "yyyy-MM-dd").alias("scored_on"),
        F.date_format("observed_at", "yyyy-MM-dd").alias("observed_on"),
        r6("pd").alias("pd"),
        "bad",
    )


def _both_scorers(spark, df, root):
    """The fixed scorecard and its challenger, registered as versions 1 and 2; both use the scorecard's bands."""
    imputer = fit_imputer(df, fit_on="all", columns=MODEL_INPUTS, categorical=False)
    bands = fit_bands(imputer.apply(df).select(pd_to_score(FROZEN_MODEL.pd()).alias("score")))
    for model in (FROZEN_MODEL, CHALLENGER):
        registry.register_model(Scorer(imputer, model, bands), root, 0.7, 0.3, "-")


@query(
    _BOTH
    + """ SELECT dummy_id, ROUND(CASE WHEN dummy_id % 2 = 0 THEN pd ELSE pd2 END, 6) AS pd,
  CASE WHEN dummy_id % 2 = 0 THEN b1 ELSE b2 END AS band, CAST(1 + dummy_id % 2 AS INTEGER) AS model_version FROM lab"""
)
def stream_registry(spark, d):
    """A running stream scores with the promoted version; a promotion takes effect between two micro-batches."""
    df = stage(src.applicants(spark, d).select("dummy_id", *MODEL_INPUTS), "applicants")
    root, arriving, out = (scratch_path(spark, x) for x in ("scorers", "arriving", "scores"))
    _both_scorers(spark, df, root)
    df.where("false").write.parquet(arriving)
    stream = runs.file_stream(spark, arriving, df.schema)
    running = None
    for version in (1, 2):
        registry.promote(spark, root, version)
        df.where(F.pmod("dummy_id", F.lit(2)) == version - 1).write.mode("append").parquet(arriving)
        if running is None:
            running = runs.follow_registry(stream, root, out, ["dummy_id", "pd", "band"], processingTime="0 seconds")
        running.processAllAvailable()
    running.stop()
    return rounded(spark.read.parquet(out).drop("batch"), "pd")


@query(_BOTH + " SELECT dummy_id, ROUND(pd, 6) AS champion_pd, b1 AS champion_band, ROUND(pd2, 6) AS challenger_pd, b2 AS challenger_band, 1 AS model_version FROM lab")
def stream_shadow(spark, d):
    """Champion and challenger answer the same stream side by side."""
    df = stage(src.applicants(spark, d).select("dummy_id", *MODEL_INPUTS), "applicants")
    root, arriving, out = (scratch_path(spark, x) for x in ("scorers", "arriving", "shadow"))
    _both_scorers(spark, df, root)
    registry.promote(spark, root, 1)
    df.write.parquet(arriving)
    stream = runs.file_stream(spark, arriving, df.schema)
    runs.follow_both(stream, root, 2, out, ["pd", "band"], "dummy_id", availableNow=True).awaitTermination()
    return rounded(spark.read.parquet(out).drop("batch"), "champion_pd", "challenger_pd")


@query(
    f"""SELECT {WEEK_SQL} AS period, COUNT(*) AS n, ROUND(AVG(value), 6) AS avg_value, MIN(value) AS min_value, MAX(value) AS max_value,
  TRUE AS p50_ok, TRUE AS p95_ok, TRUE AS p99_ok FROM events {_CLOSED} GROUP BY 1"""
)
def stream_weekly_sketch(spark, d):
    """Closed weeks from sketches; whether the quantiles' true ranks are within twice the stated error."""
    _utc(spark)
    arriving, out = scratch_path(spark, "requests"), scratch_path(spark, "sketches")
    log = table(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), "value")
    middle = F.expr("timestamp '2024-01-15'")
    for part in (F.col("ts") < middle, F.col("ts") >= middle):
        log.where(part).write.mode("append").parquet(arriving)
        runs.drain(runs.window_sketches(runs.file_stream(spark, arriving, log.schema), "value"), out)
    shares = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    found = stage(runs.sketch_quantiles(spark.read.parquet(out), list(shares.values())), "sketched")
    values = log.select(_week().alias("period"), "value").join(found.select("period", *shares), "period")
    ranks = values.groupBy("period").agg(
        *[
            # equal values span a stretch of ranks; the share must lie within it, give or take the error
            (
                (F.avg((F.col("value") < F.col(c)).cast("int")) <= p + 2 * runs.SKETCH_ERROR)
                & (F.avg((F.col("value") <= F.col(c)).cast("int")) >= p - 2 * runs.SKETCH_ERROR)
            ).alias(f"{c}_ok")
            for c, p in shares.items()
        ]
    )
    return rounded(found.drop(*shares).join(ranks, "period"), "avg_value")


@query(
    f"""WITH {_WEEKLY}, cl AS (SELECT DISTINCT {WEEK_SQL} AS period FROM events {_CLOSED}),
al AS (SELECT psi.period FROM psi JOIN cl ON cl.period = psi.period WHERE psi > 0.0005)
SELECT period, 'value' AS "column", TRUE AS registered, COUNT(*) OVER () AS n_versions, COUNT(*) OVER () AS n_first, CAST(0 AS BIGINT) AS n_again FROM al"""
)
def drift_retrain(spark, d):
    """Every alert of a closed week leads to one new version; seeing the alerts again leads to none."""
    _utc(spark)
    _, edges, baseline = _weekly(spark, d)
    out, root = scratch_path(spark, "psi"), scratch_path(spark, "retrained")
    runs.stream_psi(_event_stream(spark, d), "value", edges, stage(baseline, "baseline"), out, 0.0005)
    alerts = spark.read.parquet(out).where("alert").select("period", F.lit("value").alias("column"))
    _, retrained = _retrain(spark, d)
    news = [len(retrain_on(spark, root, alerts, lambda period, column: retrained)) for _ in range(2)]
    known = registry.versions(spark, root).select("version", F.col("code_revision").alias("name"))
    started = triggers(spark, root).join(known, ["name", "version"], "left_semi")
    names = [(p, trigger_name(p, "value")) for (p,) in alerts.select("period").distinct().collect()]
    by_name = values_table(spark, names, "period string, name string").join(started, "name", "left")
    return by_name.select(
        "period",
        F.lit("value").alias("column"),
        F.col("version").isNotNull().alias("registered"),
        F.lit(known.count()).cast("long").alias("n_versions"),
        F.lit(news[0]).cast("long").alias("n_first"),
        F.lit(news[1]).cast("long").alias("n_again"),
    )
