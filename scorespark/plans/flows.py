"""Whole runs over any applicant table: preparation, scorecard, full evaluation.

A run takes a DataFrame in the declared shape and an output folder and leaves
tables there; each returns the frames it produced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorespark.models import benchmarks as bm
from scorespark.models.calibration import Calibrated, fit_calibrated
from scorespark.models.logistic import fit_logistic
from scorespark.models.tree_shap import tree_shap
from scorespark.models.trees import trees_of
from scorespark.operators import bands as bn
from scorespark.operators import features as fe
from scorespark.operators import metrics as mt
from scorespark.operators import schema as sc
from scorespark.operators import scorecard as sd
from scorespark.operators.explain import importance_of
from scorespark.operators.preparing import fit_imputer, fit_onehot, fit_scaler
from scorespark.operators.splitting import fit_cuts, holdout_then_test, shares_of_all, two_way
from scorespark.session import spread, stage
from scorespark.sources import sinks
from scorespark.sources.artefacts import Scorer, save_artefact
from scorespark.spec import DEFAULT_SPEC, FeatureSpec


@dataclass(frozen=True)
class Prepared:
    rows: DataFrame
    features: list[str]
    suspicious: DataFrame

    def part(self, name: str) -> DataFrame:
        return self.rows.where(F.col("split") == name)


def prepare_run(df: DataFrame, out: str, spec: FeatureSpec = DEFAULT_SPEC) -> Prepared:
    """Clean, engineer, encode, split 70/10/20, impute and scale on train, check and save.

    The splits are saved under ``out/processed``, the fitted numbers under ``out/parameters``.
    """
    df = sc.ensure_target(sc.nan_to_null(sc.clean_column_names(df)), spec)
    df = sc.remove_leakage(df, spec)
    df = fe.ratio_features(df)
    if {"total_risk_score", "dim_emotional_understanding"} <= set(df.columns):
        df = fe.interactions(df, {"risk_x_dim_emo": fe.PRODUCTS["risk_x_dim_emo"]})
    df = stage(df, "raw")
    df = sc.ensure_numeric(fit_onehot(df, spec, fit_on="all").apply(df), spec)
    df = fit_cuts(df, holdout_then_test(), spec).apply(df)
    imputer = fit_imputer(df, spec)
    filled = imputer.apply(df)
    scaler = fit_scaler(filled, spec)
    rows = scaler.apply(filled)
    sinks.save_splits(rows, f"{out}/processed")
    spark = df.sparkSession
    sinks.save_parameters(
        {"median": imputer.medians, "mean": scaler.means, "deviation": scaler.deviations},
        spark,
        f"{out}/parameters",
    )
    saved = spark.read.schema(rows.schema).parquet(f"{out}/processed")
    features = spec.numeric(saved)
    train = saved.where(F.col("split") == "train")
    return Prepared(saved, features, mt.check_single_feature_auc(train, spec, features))


def scorecard_run(
    df: DataFrame,
    out: str,
    spec: FeatureSpec = DEFAULT_SPEC,
    max_features: int | None = 10,
    scale: bool = False,
    forest: dict | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Calibrated scorecard and forest benchmark on a 70/30 split: (metrics, band summary).

    ``max_features=None, scale=True`` uses every numeric feature, standardised
    inside the folds. Writes the test scores, the band summary, metrics.json and, below
    ``models``, the scorecard (from rows with ratios to bands) and the forest as artefacts.
    """
    df = sc.remove_leakage(sc.nan_to_null(sc.clean_column_names(df)), spec)
    df = stage(fe.ratio_features(df), "raw")
    df = fit_cuts(df, two_way(), spec).apply(df)
    imputer = fit_imputer(df, spec, categorical=False)
    df = stage(spread(imputer.apply(df), spec.key), "imputed")
    train, test = (df.where(F.col("split") == s) for s in ("train", "test"))

    chosen = spec.numeric(df)[:max_features]
    if not chosen:
        raise ValueError("no numeric features available")
    ensemble = fit_calibrated(train, chosen, spec, scale=scale)
    scored = sd.score_population(test, ensemble.pd()).select(spec.key, spec.target, "pd", "score")
    scored = stage(scored, "scored")
    bands = bn.fit_bands(scored)
    banded = bands.apply(scored)
    summary = bn.band_summary(banded, label=spec.target)
    sinks.write_report(banded, f"{out}/scorecard_test_scores")
    sinks.write_report(summary, f"{out}/scorecard_band_summary")

    encoder = fit_onehot(df, spec)
    names = [*spec.numeric(df), *encoder.names()]
    trees = bm.fit_forest(encoder.apply(train), names, spec.target, **{"key": spec.key, **(forest or {})})
    benchmark = bm.predict_pd(trees, encoder.apply(test), names, spec.key, spec.target)
    both = scored.select(F.lit("scorecard").alias("model"), "pd", spec.target).unionByName(
        benchmark.select(F.lit("random_forest").alias("model"), "pd", spec.target)
    )
    metrics = stage(mt.discrimination(both, label=spec.target, keys=["model"]), "metrics")
    sinks.write_metrics_json(metrics, f"{out}/metrics.json")
    _save(df, out, {"scorecard": Scorer(imputer, ensemble, bands), "encoder": encoder, "forest": trees_of(df.sparkSession, trees, names)})
    return metrics, summary


def _save(df: DataFrame, out: str, parts: dict) -> None:
    for name, part in parts.items():
        save_artefact(df.sparkSession, part, f"{out}/models/{name}")


@dataclass(frozen=True)
class Evaluation:
    metrics: DataFrame
    information_values: DataFrame
    points: DataFrame
    scored: DataFrame
    importance: DataFrame
    suspicious: DataFrame


def evaluation_run(
    df: DataFrame,
    out: str,
    spec: FeatureSpec = DEFAULT_SPEC,
    forest: dict | None = None,
    boosting: dict | None = None,
    method: str = "isotonic",
) -> Evaluation:
    """Every model with and without calibration, the points scorecard and tree attributions.

    Split first (70/10/20), then everything learned comes from the training rows. Below
    ``models`` stand the scaler, each model and, as ``<model>_calibrated``, each with its curve.
    """
    forest = {"trees": 300, "depth": 6, "min_leaf": 20, **(forest or {})}
    boosting = {"trees": 300, "depth": 4, "rate": 0.05, **(boosting or {})}
    df = stage(sc.remove_leakage(sc.nan_to_null(sc.clean_column_names(df)), spec), "raw")
    df = fit_cuts(df, shares_of_all(), spec).apply(df)
    df = fit_imputer(df, spec).apply(df)
    df = fit_onehot(df, spec).apply(df)
    suspicious = mt.leakage_check(df.where(F.col("split") == "train"), spec=spec)
    plain = stage(fe.engineer_features(df), "engineered")
    names = spec.numeric(plain)
    # a ratio over a zero denominator is the only NULL engineering can leave
    plain = fit_imputer(plain, spec, categorical=False).apply(plain)
    scaler = fit_scaler(plain, spec, columns=names)
    scaled = stage(spread(scaler.apply(plain), spec.key), "scaled")
    train, val, test = (scaled.where(F.col("split") == s) for s in ("train", "val", "test"))

    logistic = fit_logistic(train, names, spec.target, max_iter=2000)
    trees, boosted = bm.fit_both(train, names, spec.target, spec.key, forest, boosting)
    keep = (spec.key, spec.target)
    scorers = {
        "logistic": lambda part: part.select(*keep, logistic.pd().alias("pd")),
        "forest": lambda part: bm.predict_pd(trees, part, names, *keep),
        "boosting": lambda part: bm.predict_pd(boosted, part, names, *keep),
    }
    curves = bm.fit_curves(scorers, val, method, spec.target)
    metrics = stage(bm.evaluate_curves(scorers, curves, test, spec.target), "metrics")
    session = df.sparkSession
    models = {"logistic": logistic, "forest": trees_of(session, trees, names), "boosting": trees_of(session, boosted, names)}
    calibrated = {f"{name}_calibrated": Calibrated(model, curves[name]) for name, model in models.items()}
    _save(df, out, {"scaler": scaler, **models, **calibrated})
    iv = bn.compute_iv_all(plain.where(F.col("split") == "train"), names, label=spec.target)
    points = sd.build_scorecard(logistic.table(df.sparkSession))
    scored = sd.scoring_report(test, logistic, spec.key, spec.target)
    attributions = stage(tree_shap(boosted, test, names, spec.key), "attributions")
    importance = importance_of(attributions)
    for name, table in {
        "model_metrics": metrics,
        "iv_table": iv,
        "scorecard_points": points,
        "scored_test_set": scored,
        "shap_values": attributions,
        "shap_importance": importance,
    }.items():
        sinks.write_report(table, f"{out}/{name}")
    return Evaluation(metrics, iv, points, scored, importance, suspicious)
