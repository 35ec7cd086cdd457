"""Queries that fit models.

Fitted numbers depend on the optimiser. What the checking SQL states are the counts a
fit is measured on and conditions every right fit meets: discrimination inside
the healthy range, errors below chance, a gradient of zero, attributions that add up.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from scorespark.models import benchmarks as bm
from scorespark.functions.scoring import pd_to_score
from scorespark.models.calibration import CLIP, Calibrated, fit_calibrated, fit_curve
from scorespark.models.histogram_trees import fit_bagged_trees, fit_boosted_trees
from scorespark.models.logistic import fit_logistic
from scorespark.models.tree_shap import tree_shap
from scorespark.models.trees import trees_of
from scorespark.operators.bands import band_summary, fit_bands
from scorespark.operators.explain import importance_of, top_coefficients
from scorespark.operators.features import engineer_features
from scorespark.operators.metrics import discrimination
from scorespark.operators.preparing import Imputer, fit_imputer, fit_onehot, fit_scaler
from scorespark.operators.scorecard import score_population
from scorespark.operators.splitting import fit_cuts, shares_of_all, two_way
from scorespark.plans.frozen import base
from scorespark.plans.registry import query
from scorespark.plans.sql import NUMERIC, split_cte
from scorespark.session import scratch_path, spread, stage, values_table
from scorespark.sources import registry
from scorespark.sources.artefacts import Scorer
from scorespark.sources.sinks import dataset_hash
from scorespark.spec import DEFAULT_SPEC
from scorespark.streaming import runs

KEEP = ("dummy_id", "bad", "split")


def prepared(spark, d, scheme=None, scaled=False, encoded=True, engineered=False):
    """Split, imputed, optionally engineered, encoded and scaled applicants; and the feature names."""
    raw = base(spark, d)
    df = fit_cuts(raw, scheme or two_way()).apply(raw).drop(*DEFAULT_SPEC.leakage)
    df = fit_imputer(df).apply(df)
    if engineered:
        df = engineer_features(df)
        df = fit_imputer(df, categorical=False).apply(df)
    df = fit_onehot(df).apply(df) if encoded else df.drop("product_type")
    names = DEFAULT_SPEC.numeric(df)
    if scaled:
        df = fit_scaler(df).apply(df)
    return stage(spread(df.select(*KEEP, *names)), "prepared"), names


def _parts(df, *names):
    return [df.where(F.col("split") == n) for n in names]


def measured(metrics, *keys):
    """Counts, and whether the figures are those of a working model."""
    return metrics.select(
        *keys,
        "n",
        "n_bad",
        F.col("auc").between(0.60, 0.95).alias("auc_ok"),
        (F.col("ks") >= 0.2).alias("ks_ok"),
        (F.col("brier") < 0.25).alias("brier_ok"),
    )


def measured_sql(scheme: str, models: tuple[str, ...] = ()) -> str:
    """The same for the test rows of a split, once or per model."""
    names = f" CROSS JOIN (SELECT UNNEST([{', '.join(repr(m) for m in models)}]) AS model)" if models else ""
    key = "model, " if models else ""
    return f"""WITH {split_cte(scheme)}, x AS (SELECT COUNT(*) AS n, CAST(SUM(bad) AS BIGINT) AS n_bad FROM s WHERE split = 'test')
SELECT {key}n, n_bad, TRUE AS auc_ok, TRUE AS ks_ok, TRUE AS brier_ok FROM x{names}"""


_VARIANTS = tuple(f"{m}_{v}" for m in ("logistic", "forest", "boosting") for v in ("base", "calibrated"))


@query(measured_sql("two"))
def lr_metrics(spark, d):
    df, names = prepared(spark, d, scaled=True)
    train, test = _parts(df, "train", "test")
    model = fit_logistic(train, names)
    return measured(discrimination(test.select("bad", model.pd().alias("pd"))))


_LEVELS = "SELECT DISTINCT product_type AS l FROM s WHERE product_type IS NOT NULL AND split = 'train'"
_NAMES_SQL = f"""SELECT UNNEST([{', '.join(repr(c) for c in NUMERIC)}]) AS feature
UNION ALL SELECT 'product_type_' || l FROM ({_LEVELS} UNION SELECT 'missing' FROM s WHERE product_type IS NULL AND split = 'train') WHERE l > (SELECT MIN(l) FROM ({_LEVELS}))"""


@query(f"WITH {split_cte('two')} SELECT feature, TRUE AS stationary FROM ({_NAMES_SQL})")
def lr_importance(spark, d):
    """Features of the logistic fit, and whether its objective has no slope in their direction."""
    df, names = prepared(spark, d, scaled=True)
    train = _parts(df, "train")[0]
    model = fit_logistic(train, names)
    ranked = top_coefficients(model.table(spark), len(names))
    error = model.pd() - F.col("bad")
    slopes = train.agg(*[(F.sum(error * F.col(c)) / F.count("*")).alias(c) for c in names], F.count("*").alias("_n")).first()
    slope = values_table(
        spark, [(c, slopes[c] + model.coefficients[c] / slopes["_n"]) for c in names], "feature string, slope double"
    )
    return ranked.join(slope, "feature").select("feature", (F.abs("slope") < 1e-4).alias("stationary"))


@query(
    f"""WITH {split_cte('two')} SELECT COUNT(*) AS n, CAST(SUM(bad) AS BIGINT) AS n_bad, CAST(5 AS BIGINT) AS bands,
  TRUE AS rising, TRUE AS calibrated FROM s WHERE split = 'test'"""
)
def platt_scorecard(spark, d):
    """Cross-fitted, sigmoid-calibrated scorecard on the first ten numeric features: its band table.

    The bad rate of band E is above that of band A and the mean probability meets the bad rate.
    """
    df, names = prepared(spark, d, encoded=False)
    train, test = _parts(df, "train", "test")
    ensemble = fit_calibrated(train, names[:10])
    scored = stage(score_population(test, ensemble.pd()).select("dummy_id", "bad", "pd", "score"), "scored")
    bands = stage(band_summary(fit_bands(scored).apply(scored)), "bands")
    ordered = bands.agg(F.transform(F.array_sort(F.collect_list(F.struct("band", "bad_rate"))), lambda x: x["bad_rate"]).alias("r"))
    rising = ordered.select((F.element_at("r", 1) < F.element_at("r", -1)).alias("rising"))
    total = scored.agg(
        F.count("*").alias("n"), F.sum("bad").alias("n_bad"), (F.abs(F.avg("pd") - F.avg("bad")) < 0.03).alias("calibrated")
    )
    count = bands.agg(F.count("*").alias("bands"))
    return total.join(count).join(rising).select("n", "n_bad", "bands", "rising", "calibrated")


@query(measured_sql("two"))
def platt_metrics(spark, d):
    """As the scorecard above on all numeric features, scaled inside each fold."""
    df, names = prepared(spark, d, encoded=False)
    train, test = _parts(df, "train", "test")
    ensemble = fit_calibrated(train, names, scale=True)
    return measured(discrimination(test.select("bad", ensemble.pd().alias("pd"))))


@query(measured_sql("shares", _VARIANTS[:2]))
def isotonic_val(spark, d):
    """Logistic model as fitted and after isotonic calibration on the validation rows."""
    df, names = prepared(spark, d, shares_of_all(), scaled=True)
    train, val, test = _parts(df, "train", "val", "test")
    model = fit_logistic(train, names)
    scorers = {"logistic": lambda part: part.select("bad", model.pd().alias("pd"))}
    return measured(bm.evaluate_all(scorers, val, test), "model")


@query(measured_sql("two"))
def rf_metrics(spark, d):
    df, names = prepared(spark, d)
    train, test = _parts(df, "train", "test")
    model = bm.fit_forest(train, names)
    return measured(discrimination(bm.predict_pd(model, test, names, "bad")))


@query(measured_sql("two"))
def gbt_metrics(spark, d):
    df, names = prepared(spark, d)
    train, test = _parts(df, "train", "test")
    model = fit_boosted_trees(train, names)
    return measured(discrimination(test.select("bad", model.pd().alias("pd"))))


@query(measured_sql("two").replace("SELECT n,", "SELECT TRUE AS repeatable, n,"))
def bagged_metrics(spark, d):
    """A forest on rows drawn by hashes; ``repeatable``: its first trees are those of other partitions and row orders."""
    df, names = prepared(spark, d)
    train, test = _parts(df, "train", "test")
    model = fit_bagged_trees(train, names)
    again = fit_bagged_trees(train.repartition(13, "dim_core_traits"), names, trees=10)
    nodes = len(again.at)
    same = model.features == again.features and all(getattr(model, x)[:nodes] == getattr(again, x) for x in ("at", "threshold", "left", "right"))
    return measured(discrimination(test.select("bad", model.pd().alias("pd")))).withColumn("repeatable", F.lit(same))


@query(measured_sql("two"))
def mlp_metrics(spark, d):
    df, names = prepared(spark, d, scaled=True)
    train, test = _parts(df, "train", "test")
    model = bm.fit_network(train, names)
    return measured(discrimination(bm.predict_pd(model, test, names, "bad")))


@query(measured_sql("two", ("logistic", "forest", "boosting")))
def model_compare(spark, d):
    df, names = prepared(spark, d)
    train, test = _parts(df, "train", "test")
    return measured(bm.compare_models(train, test, names), "model")


@query(measured_sql("shares", _VARIANTS))
def evaluate_all_variants(spark, d):
    """Each model with and without calibration, on engineered and scaled features."""
    df, names = prepared(spark, d, shares_of_all(), scaled=True, engineered=True)
    train, val, test = _parts(df, "train", "val", "test")
    scorers = bm.fit_scorers(
        train, names, forest={"trees": 300, "depth": 6, "min_leaf": 20}, boosting={"trees": 300, "depth": 4, "rate": 0.05}
    )
    return measured(bm.evaluate_all(scorers, val, test), "model")


@query(f"WITH {split_cte('two')} SELECT feature, TRUE AS counted FROM ({_NAMES_SQL})")
def shap_tree(spark, d):
    """Mean absolute attribution per feature of a forest, over all test rows.

    ``counted``: the figure is the mean over the single attributions, whose number is that of the
    test rows, and features that no split uses have none.
    """
    df, names = prepared(spark, d)
    train, test = _parts(df, "train", "test")
    model = bm.fit_forest(train, names)
    values = stage(tree_shap(model, test, names), "attributions")
    found = importance_of(values)
    value = next(c for c in found.columns if c != "feature")
    used = {names[k] for k, weight in enumerate(model.featureImportances) if weight > 0}
    single = values.groupBy("feature").agg(F.sum(F.abs("phi")).alias("total"), F.count_distinct("dummy_id").alias("rows"))
    same = F.abs(F.col(value) - F.col("total") / test.count()) < 1e-9
    nonzero = (F.col(value) > 0) == F.col("feature").isin(*used)
    return found.join(single, "feature").select("feature", (same & nonzero & (F.col("rows") == test.count())).alias("counted"))


@query(f"WITH {split_cte('two')} SELECT COUNT(*) AS n, COUNT(*) AS n_equal FROM s WHERE split = 'test'")
def shap_tree_values(spark, d):
    """Rows whose attributions and base add up to the margin of the boosted trees."""
    df, names = prepared(spark, d)
    train, test = _parts(df, "train", "test")
    model = bm.fit_boosting(train, names)
    total = tree_shap(model, test, names).groupBy("dummy_id").agg((F.sum("phi") + F.first("base")).alias("margin"))
    pd = bm.predict_pd(model, test, names, "dummy_id")
    both = total.join(pd, "dummy_id").select((F.abs(1 / (1 + F.exp(-2 * F.col("margin"))) - F.col("pd")) < 1e-6).alias("same"))
    return both.agg(F.count("*").alias("n"), F.count_if("same").alias("n_equal"))


@query(measured_sql("two").replace("SELECT n,", "SELECT CAST(2 AS INTEGER) AS version, n,"))
def model_registry(spark, d):
    """Two benchmark forests registered with their figures, one promoted, and scored with the current one."""
    df, names = prepared(spark, d)
    train, test = _parts(df, "train", "test")
    root = scratch_path(spark, "models")
    digest = dataset_hash(train).first()["sum_digest"]
    assembler = VectorAssembler(inputCols=names, outputCol="x")
    for trees in (50, 100):
        fitted = bm.fit_forest(train, names, trees=trees)
        found = discrimination(bm.predict_pd(fitted, test, names, "bad")).first()
        version = registry.register_model(PipelineModel([assembler, fitted]), root, found["auc"], found["ks"], digest)
    registry.promote(spark, root, version)
    current = registry.load_current(spark, root)
    scored = current.transform(test).select("bad", F.element_at(bm.vector_to_array("probability"), 2).alias("pd"))
    return measured(discrimination(scored)).withColumn("version", F.lit(version))


@query(
    f"""WITH {split_cte('shares')} SELECT COUNT(*) AS n, COUNT(*) AS n_equal, CAST(1 AS INTEGER) AS version, TRUE AS auc_ok, TRUE AS brier_ok
FROM s WHERE split = 'test'"""
)
def tree_scorers(spark, d):
    """A forest and its isotonic twin as saved scorers: registered, promoted and scored on a stream.

    ``n_equal``: rows whose streamed probability is the curve over the fitted forest's own, interpolated in numpy.
    """
    df, names = prepared(spark, d, shares_of_all())
    train, val, test = _parts(df, "train", "val", "test")
    fitted = bm.fit_forest(train, names)
    forest = trees_of(spark, fitted, names)
    curve = fit_curve(bm.predict_pd(fitted, val, names, "bad"))
    model = Calibrated(forest, curve)
    bands = fit_bands(val.select(pd_to_score(F.greatest(F.least(model.pd(), F.lit(1 - CLIP)), F.lit(CLIP))).alias("score")))
    root, arriving, out = (scratch_path(spark, x) for x in ("models", "arriving", "scores"))
    registry.promote(spark, root, registry.register_model(Scorer(Imputer({}, ()), model, bands), root, 0.7, 0.3, "-"))
    test.select("dummy_id", "bad", *names).write.parquet(arriving)
    stream = runs.file_stream(spark, arriving, spark.read.parquet(arriving).schema)
    runs.follow_registry(stream, root, out, ["dummy_id", "bad", "pd"], availableNow=True).awaitTermination()
    scored = spark.read.parquet(out)
    plain = bm.predict_pd(fitted, test, names, "dummy_id").withColumnRenamed("pd", "plain")
    both = scored.join(plain, "dummy_id").select("pd", "plain", "model_version")

    @F.pandas_udf("double")
    def interpolated(plain: pd.Series) -> pd.Series:
        return pd.Series(np.interp(plain, curve.borders, curve.values))

    same = both.agg(F.count("*").alias("n"), F.count_if(F.abs(F.col("pd") - interpolated("plain")) < 1e-9).alias("n_equal"), F.max("model_version").alias("version"))
    figures = measured(discrimination(scored.select("bad", "pd"))).select("auc_ok", "brier_ok")
    return same.join(figures)
