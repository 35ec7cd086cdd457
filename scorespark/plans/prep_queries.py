"""Queries on sources, schema work, splits, preparation and features."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorespark.operators import features as fe
from scorespark.operators import schema as sc
from scorespark.operators.preparing import (
    fit_imputer,
    fit_onehot,
    fit_scaler,
    grouped_scaling,
)
from scorespark.operators.splitting import (
    equal_folds,
    fit_cuts,
    holdout_then_test,
    shares_of_all,
    split_balance,
    split_overlap,
    two_way,
)
from scorespark.plans.frozen import base, split_base
from scorespark.plans.registry import query, rounded
from scorespark.plans.sql import APPLICANTS, NUMERIC, imputed_cte, split_cte
from scorespark.plans.sql import r6 as sql_r6
from scorespark.session import scratch_path
from scorespark.sources import readers, sinks
from scorespark.sources.applicants import applicant_columns, applicants
from scorespark.spec import DEFAULT_SPEC

RAW = f"WITH {APPLICANTS} "
FEATURES = ", ".join(["product_type", *NUMERIC])


@query(RAW + "SELECT * FROM a")
def source_applicants(spark, d):
    return applicants(spark, d)


@query(RAW + "SELECT COUNT(*) AS n_rows, 20 AS n_columns FROM a")
def ingest_profile(spark, d):
    return readers.load_profile(applicants(spark, d))


@query(
    RAW
    + """SELECT * FROM (
  SELECT 'column missing' AS rule, 'credit_limit' AS subject, CAST(1 AS BIGINT) AS found
  UNION ALL SELECT 'column type', 'dim_principles', 1
  UNION ALL SELECT 'column unexpected', 'income', 1
  UNION ALL SELECT 'column unexpected', 'expenses', 1
  UNION ALL SELECT 'value not allowed', 'product_type', COUNT(*) FROM a
    WHERE product_type NOT IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD', 'FURNITURE')
  UNION ALL SELECT 'key missing', 'dummy_id', COUNT(*) FROM a WHERE dummy_id IS NULL
  UNION ALL SELECT 'key repeated', 'dummy_id', COUNT(*) FROM
    (SELECT dummy_id FROM a GROUP BY dummy_id HAVING COUNT(*) > 1)
) WHERE found > 0"""
)
def ingest_violations(spark, d):
    df = applicants(spark, d)
    expected = [f for f in df.schema.fields if f.name not in ("income", "expenses", "dim_principles")]
    schema = T.StructType(
        [
            *expected,
            T.StructField("dim_principles", T.IntegerType()),
            T.StructField("credit_limit", T.DoubleType()),
        ]
    )
    return readers.contract_violations(
        df,
        schema,
        min_rows=1,
        key="dummy_id",
        allowed={"product_type": ("BUILDING", "MACHINERY", "HOUSEHOLD", "FURNITURE")},
    )


@query(
    RAW
    + f"""SELECT {', '.join(c for c in applicant_columns())} FROM a"""
)
def csv_source(spark, d):
    """Applicants written as csv with untidy headers and read back under a declared schema."""
    df = applicants(spark, d)
    untidy = df.toDF(*[f" {c.replace('_', ' ').title()} " for c in df.columns])
    path = scratch_path(spark, "applicants-csv")
    sinks.write_report(untidy, path, "csv")
    schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(untidy.columns, df.schema.fields)])
    return readers.load_credit_data(spark, path, "csv", schema)


@query(RAW + f"SELECT dummy_id, bad, {FEATURES} FROM a")
def clean_names(spark, d):
    df = applicants(spark, d).select("dummy_id", "bad", *FEATURES.split(", "))
    untidy = df.toDF(*[f" {c.replace('_', ' ').upper()} " for c in df.columns])
    return sc.clean_column_names(untidy)


@query(RAW + "SELECT * EXCLUDE (dummy_id) FROM a")
def drop_ids(spark, d):
    return sc.remove_ids(applicants(spark, d))


@query(RAW + "SELECT * EXCLUDE (num_accounts_perf, highest_arrears_perf, age_oldest_perf) FROM a")
def drop_leakage(spark, d):
    return sc.remove_leakage(applicants(spark, d))


@query(RAW + "SELECT * EXCLUDE (dummy_id, num_accounts_perf, highest_arrears_perf, age_oldest_perf) FROM a")
def drop_ids_and_leakage(spark, d):
    return sc.drop_ids_and_leakage(applicants(spark, d))


@query(RAW + f"SELECT dummy_id, bad, {FEATURES} FROM a")
def split_xy(spark, d):
    return sc.split_xy(applicants(spark, d)).select("dummy_id", "bad", "features.*")


@query(RAW + f"SELECT dummy_id, bad, {', '.join(NUMERIC)} FROM a")
def select_numeric(spark, d):
    return sc.select_numeric(applicants(spark, d))


@query(RAW + f"SELECT dummy_id, bad, {', '.join(NUMERIC[:10])} FROM a")
def first_ten_numeric(spark, d):
    return sc.select_numeric(applicants(spark, d), max_features=10)


@query(RAW + f"SELECT COUNT(*) AS n_rows, {len(NUMERIC)} AS n_numeric FROM a WHERE bad IS NOT NULL")
def checked_frame(spark, d):
    """The frame after both assertions: label present, every feature numeric."""
    df = sc.ensure_target(sc.ensure_numeric(sc.select_numeric(applicants(spark, d))))
    return df.where(F.col("bad").isNotNull()).agg(
        F.count("*").alias("n_rows"), F.lit(len(DEFAULT_SPEC.numeric(df))).alias("n_numeric")
    )


@query(
    """SELECT event_id, COALESCE(TRY_CAST(event_type AS DOUBLE), 0e0) AS event_type,
  COALESCE(TRY_CAST(props ->> '$.k' AS DOUBLE), 0e0) AS k, COALESCE(value, 0e0) AS value FROM events"""
)
def coerce_numeric(spark, d):
    events = readers.table(spark, d, "events").select(
        "event_id", "event_type", F.get_json_object("props", "$.k").alias("k"), "value"
    )
    return sc.coerce_numeric(events, ["event_type", "k", "value"])


@query(RAW + "SELECT dummy_id, risk_drivers, CAST(0 AS DOUBLE) AS credit_limit, CAST(0 AS INTEGER) AS product_type_other FROM a")
def reindex_columns(spark, d):
    schema = {
        "risk_drivers": T.DoubleType(),
        "credit_limit": T.DoubleType(),
        "product_type_other": T.IntegerType(),
    }
    return sc.reindex_columns(applicants(spark, d), schema, keep=["dummy_id"])


# --- splits -------------------------------------------------------------------


@query(f"WITH {split_cte('shares')} SELECT dummy_id, bad, split FROM s")
def split_assign(spark, d):
    return split_base(spark, d, ["dummy_id", "bad"], shares_of_all())


@query(f"WITH {split_cte('holdout')} SELECT dummy_id, bad, split FROM s")
def split_assign_holdout(spark, d):
    return split_base(spark, d, ["dummy_id", "bad"], holdout_then_test())


@query(f"WITH {split_cte('two')} SELECT dummy_id, bad, split FROM s")
def split_assign_two_way(spark, d):
    return split_base(spark, d, ["dummy_id", "bad"], two_way())


FOLDS = f"""{split_cte('two')},
fold AS (SELECT *, CAST(NTILE(3) OVER (PARTITION BY bad ORDER BY md5(CAST(dummy_id AS VARCHAR) || ':42')) - 1 AS INTEGER) AS fold
  FROM s WHERE split = 'train')"""


@query(f"WITH {FOLDS} SELECT dummy_id, bad, fold FROM fold")
def fold_assign(spark, d):
    train = split_base(spark, d, ["dummy_id", "bad"], two_way()).where(F.col("split") == "train")
    return fit_cuts(train, equal_folds(3)).apply(train, "fold").drop("split")


@query(
    f"""WITH {split_cte('shares')} SELECT split, COUNT(*) AS n, {sql_r6('AVG(bad)', 'bad_rate')},
  ROUND((SELECT AVG(bad) FROM s), 6) AS overall_rate,
  ABS(AVG(bad) - (SELECT AVG(bad) FROM s)) <= 0.01 AS within_tolerance FROM s GROUP BY split"""
)
def split_balance_check(spark, d):
    return rounded(split_balance(split_base(spark, d, ["dummy_id", "bad"])), "bad_rate", "overall_rate")


@query(
    f"""WITH {split_cte('shares')}, per_key AS (SELECT dummy_id, COUNT(DISTINCT split) AS n FROM s GROUP BY dummy_id)
SELECT (SELECT COUNT(*) FROM per_key WHERE n > 1) AS in_two_splits,
  (SELECT COUNT(*) FROM (SELECT dummy_id FROM a EXCEPT SELECT dummy_id FROM per_key)) AS in_no_split,
  (SELECT COUNT(*) FROM (SELECT dummy_id FROM per_key EXCEPT SELECT dummy_id FROM a)) AS not_in_source"""
)
def split_overlap_check(spark, d):
    assigned = split_base(spark, d, ["dummy_id", "bad"])
    return split_overlap(assigned, applicants(spark, d).select("dummy_id", "bad"))


# --- imputing, encoding, scaling ------------------------------------------------


@query(
    f"""WITH {split_cte('shares')}, {imputed_cte('s', NUMERIC, "split = 'train'")}
SELECT dummy_id, split, {', '.join(NUMERIC)} FROM i"""
)
def impute_median(spark, d):
    df = split_base(spark, d, ["dummy_id", "bad", *NUMERIC])
    return fit_imputer(df).apply(df).drop("bad")


@query(f"WITH {APPLICANTS}, {imputed_cte('a', NUMERIC)} SELECT dummy_id, {', '.join(NUMERIC)} FROM i")
def impute_median_all_rows(spark, d):
    df = base(spark, d, ["dummy_id", *NUMERIC])
    return fit_imputer(df, fit_on="all").apply(df)


@query(RAW + "SELECT dummy_id, COALESCE(product_type, 'missing') AS product_type FROM a")
def impute_category(spark, d):
    df = applicants(spark, d).select("dummy_id", "product_type")
    return fit_imputer(df, fit_on="all", columns=[]).apply(df)


@query(RAW + "SELECT dummy_id, COALESCE(risk_drivers, 0) AS risk_drivers, COALESCE(age_oldest_assess, 0) AS age_oldest_assess FROM a")
def fill_zero(spark, d):
    columns = ["risk_drivers", "age_oldest_assess"]
    return sc.fill_constant(applicants(spark, d).select("dummy_id", *columns), columns)


_LEVELS = ("BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query(
    RAW
    + "SELECT dummy_id, "
    + ", ".join(f"CASE WHEN product_type = '{v}' THEN 1 ELSE 0 END AS \"product_type_{v}\"" for v in _LEVELS)
    + " FROM a"
)
def onehot_full(spark, d):
    df = applicants(spark, d).select("dummy_id", "product_type")
    return fit_onehot(df, fit_on="all").apply(df)


@query(
    f"WITH {split_cte('two')} SELECT dummy_id, split, "
    + ", ".join(f"CASE WHEN product_type = '{v}' THEN 1 ELSE 0 END AS \"product_type_{v}\"" for v in _LEVELS)
    + " FROM s"
)
def onehot_train(spark, d):
    df = split_base(spark, d, ["dummy_id", "bad", "product_type"], two_way())
    return fit_onehot(df).apply(df).drop("bad")


@query(RAW + "SELECT dummy_id, CAST(risk_drivers > risk_mitigators AS INTEGER) AS driven, CAST(expenses > 0 AS INTEGER) AS spends FROM a")
def bool_to_int(spark, d):
    return applicants(spark, d).select(
        "dummy_id",
        (F.col("risk_drivers") > F.col("risk_mitigators")).cast("int").alias("driven"),
        (F.col("expenses") > 0).cast("int").alias("spends"),
    )


_SCALED = ", ".join(
    f"ROUND((i.{c} - par.m_{c}) / CASE WHEN par.s_{c} = 0 THEN 1 ELSE par.s_{c} END, 6) AS {c}" for c in NUMERIC
)
_PARAMS = ", ".join(f"AVG({c}) AS m_{c}, STDDEV_POP({c}) AS s_{c}" for c in NUMERIC)


@query(
    f"""WITH {split_cte('shares')}, {imputed_cte('s', NUMERIC, "split = 'train'")},
par AS (SELECT {_PARAMS} FROM i WHERE split = 'train')
SELECT dummy_id, split, {_SCALED} FROM i CROSS JOIN par"""
)
def scale_features(spark, d):
    df = split_base(spark, d, ["dummy_id", "bad", *NUMERIC])
    filled = fit_imputer(df).apply(df)
    return rounded(fit_scaler(filled).apply(filled).drop("bad"), *NUMERIC)


_FOLD_COLUMNS = tuple(NUMERIC)


@query(
    f"WITH {FOLDS} "
    + " UNION ALL ".join(
        f"""SELECT CAST({k} AS INTEGER) AS fold, '{c}' AS feature, {sql_r6(f'AVG({c})', 'mean')}, {sql_r6(f'STDDEV_POP({c})', 'deviation')}
  FROM fold WHERE fold <> {k}"""
        for k in range(3)
        for c in _FOLD_COLUMNS
    )
)
def scale_per_fold(spark, d):
    """Scaler parameters of each cross-validation round: fitted on the other folds."""
    train = split_base(spark, d, ["dummy_id", "bad", *_FOLD_COLUMNS], two_way()).where(
        F.col("split") == "train"
    )
    folded = fit_cuts(train, equal_folds(3)).apply(train, "fold")
    return rounded(grouped_scaling(folded, "fold", _FOLD_COLUMNS), "mean", "deviation")


# --- features -------------------------------------------------------------------

_PRODUCTS = {n: f"{a} * {b}" for n, (a, b) in fe.PRODUCTS.items()}


@query(
    RAW
    + """SELECT dummy_id, ROUND(income / NULLIF(expenses + 1, 0), 6) AS affordability_ratio,
  ROUND(risk_drivers / NULLIF(risk_mitigators + 1, 0), 6) AS risk_ratio, risk_drivers - risk_mitigators AS net_risk FROM a"""
)
def features_rowwise(spark, d):
    made = fe.ratio_features(applicants(spark, d))
    return rounded(made.select("dummy_id", "affordability_ratio", "risk_ratio", "net_risk"), "affordability_ratio", "risk_ratio")


@query(RAW + "SELECT dummy_id, " + ", ".join(f"{e} AS {n}" for n, e in _PRODUCTS.items()) + " FROM a")
def interactions(spark, d):
    return fe.interactions(applicants(spark, d)).select("dummy_id", *fe.PRODUCTS)


def _flag_sql(source: str, where: str) -> str:
    marks = ", ".join(
        f"QUANTILE_CONT({c}, {q}) AS t_{n}" for n, (c, q, _) in fe.FLAGS.items()
    )
    tests = {
        n: f"CAST(COALESCE({c} {'>' if side == 'above' else '<'} t_{n}, FALSE) AS INTEGER)"
        for n, (c, _, side) in fe.FLAGS.items()
    }
    flags = ", ".join(f"{t} AS {n}" for n, t in tests.items())
    both = ", ".join(f"{tests[x]} * {tests[y]} AS {n}" for n, (x, y) in fe.FLAG_PRODUCTS.items())
    return (
        f"SELECT dummy_id, {flags}, {both} FROM {source} CROSS JOIN (SELECT {marks} FROM {source} WHERE {where})"
    )


_FLAG_COLUMNS = ["total_risk_score", "r_ho_em2_co", "r_ho_vi4_st"]


@query(f"WITH {split_cte('shares')} " + _flag_sql("s", "split = 'train'"))
def features_flags_train(spark, d):
    df = split_base(spark, d, ["dummy_id", "bad", *_FLAG_COLUMNS])
    return fe.engineer_features(df).select("dummy_id", *fe.FLAGS, *fe.FLAG_PRODUCTS)


@query(RAW + _flag_sql("a", "TRUE"))
def features_flags_all(spark, d):
    df = base(spark, d, ["dummy_id", *_FLAG_COLUMNS])
    return fe.engineer_features(df, fit_on="all").select("dummy_id", *fe.FLAGS, *fe.FLAG_PRODUCTS)


@query(
    RAW
    + """SELECT dummy_id, CAST(COALESCE(expenses < (SELECT QUANTILE_CONT(expenses, 0.05) FROM a), FALSE) AS INTEGER) AS thin
  FROM a"""
)
def quantile_flag(spark, d):
    df = base(spark, d, ["dummy_id", "expenses"])
    return fe.quantile_flag(df, "expenses", 0.05, "below", "thin", fit_on="all").drop("expenses")


# --- sinks ----------------------------------------------------------------------


@query(
    f"""WITH {split_cte('shares')} SELECT split, COUNT(*) AS n, CAST(SUM(bad) AS BIGINT) AS bads,
  CAST(SUM(dummy_id) AS BIGINT) AS key_sum FROM s GROUP BY split"""
)
def saved_splits(spark, d):
    path = scratch_path(spark, "splits")
    sinks.save_splits(split_base(spark, d, ["dummy_id", "bad"]), path)
    return (
        spark.read.parquet(path)
        .groupBy("split")
        .agg(
            F.count("*").alias("n"),
            F.sum("bad").alias("bads"),
            F.sum("dummy_id").alias("key_sum"),
        )
    )


@query(
    f"WITH {split_cte('shares')} "
    + " UNION ALL ".join(
        f"SELECT 'median' AS kind, '{c}' AS name, (SELECT MEDIAN({c}) FROM s WHERE split = 'train') AS value"
        for c in NUMERIC
    )
)
def saved_parameters(spark, d):
    df = split_base(spark, d, ["dummy_id", "bad", *NUMERIC])
    path = scratch_path(spark, "parameters")
    sinks.save_parameters({"median": fit_imputer(df).medians}, spark, path)
    return spark.read.parquet(path)


def _double_text(c: str) -> str:
    raw = f"(ABS({c}) * POW(2e0, FLOOR((52 - FLOOR(LOG2(ABS({c})))) / 2)) * POW(2e0, (52 - FLOOR(LOG2(ABS({c})))) - FLOOR((52 - FLOOR(LOG2(ABS({c})))) / 2)))"
    mantissa = f"CAST(CASE WHEN {raw} >= POW(2e0, 53) THEN {raw} / 2 WHEN {raw} < POW(2e0, 52) THEN {raw} * 2 ELSE {raw} END AS BIGINT)"
    power = f"CAST(FLOOR(LOG2(ABS({c}))) + CASE WHEN {raw} >= POW(2e0, 53) THEN 1 WHEN {raw} < POW(2e0, 52) THEN -1 ELSE 0 END AS BIGINT)"
    return f"CASE WHEN {c} = 0 THEN '0' ELSE CASE WHEN {c} < 0 THEN '-' ELSE '' END || CAST({mantissa} AS VARCHAR) || 'p' || CAST({power} AS VARCHAR) END"


def _field(c: str, kind: str) -> str:
    text = f"CAST({c} AS VARCHAR)" if kind in ("bigint", "int", "string") else f"({_double_text(c)})"
    return f"COALESCE(CAST(LENGTH({text}) AS VARCHAR) || ':' || {text}, 'n')"


_HASHED = " || ".join(_field(c, t) for c, t in applicant_columns().items())


@query(
    RAW
    + f""", h AS (SELECT CAST('0x' || SUBSTR(md5({_HASHED}), 1, 15) AS BIGINT) AS d FROM a)
SELECT COUNT(*) AS n_rows, BIT_XOR(d) AS xor_digest, CAST(SUM(d) AS VARCHAR) AS sum_digest FROM h"""
)
def dataset_hash(spark, d):
    return sinks.dataset_hash(applicants(spark, d))
