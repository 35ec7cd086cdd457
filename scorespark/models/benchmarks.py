"""Forest, boosting and neural benchmarks, and model comparison tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.classification import (
    GBTClassifier,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorespark.models.boosted import fit_boosted
from scorespark.models.calibration import Isotonic, OnLogOdds, fit_curve
from scorespark.models.forests import binned_table, fit_trees
from scorespark.models.logistic import assemble, fit_logistic
from scorespark.operators.metrics import discrimination
from scorespark.session import drop_table
from scorespark.spec import RANDOM_STATE

Scorer = Callable[[DataFrame], DataFrame]
Curve = Isotonic | OnLogOdds
_VARIANTS = "_base", "_calibrated"


def fit_forest(
    df: DataFrame,
    features: Sequence[str],
    label: str = "bad",
    trees: int = 100,
    depth: int = 5,
    min_leaf: int = 1,
    seed: int = RANDOM_STATE,
    key: str = "dummy_id",
    binned: tuple | None = None,
):
    """Random forest that tries sqrt(features) columns per split; rows are drawn by a hash of key and features."""
    estimator = RandomForestClassifier(
        featuresCol="x",
        labelCol=label,
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=min_leaf,
        featureSubsetStrategy="sqrt",
        seed=seed,
    )
    return fit_trees(df, features, estimator, key, binned)


def fit_boosting(
    df: DataFrame,
    features: Sequence[str],
    label: str = "bad",
    trees: int = 100,
    depth: int = 4,
    rate: float = 0.1,
    seed: int = RANDOM_STATE,
    key: str = "dummy_id",
    binned: tuple | None = None,
):
    """Gradient-boosted trees on 80 % row samples, by a hash of key and features (no leaf penalties, no column sampling per tree)."""
    estimator = GBTClassifier(
        featuresCol="x",
        labelCol=label,
        maxIter=trees,
        maxDepth=depth,
        stepSize=rate,
        subsamplingRate=0.8,
        seed=seed,
    )
    return fit_boosted(df, features, estimator, key, binned)


def fit_network(
    df: DataFrame, features: Sequence[str], label: str = "bad", epochs: int = 10, seed: int = RANDOM_STATE
):
    """Feed-forward network with hidden layers of 32 and 16 units."""
    estimator = MultilayerPerceptronClassifier(
        featuresCol="x",
        labelCol=label,
        layers=[len(features), 32, 16, 2],
        maxIter=epochs,
        seed=seed,
    )
    return estimator.fit(assemble(df, features, label))


def predict_pd(model, df: DataFrame, features: Sequence[str], *keep: str) -> DataFrame:
    """``keep`` and the probability of class 1 as ``pd``."""
    scored = model.transform(assemble(df, features, *keep))
    return scored.select(*keep, vector_to_array("probability")[1].alias("pd"))


def fit_both(train: DataFrame, features: Sequence[str], label: str, key: str, forest: dict, boosting: dict):
    """The forest and the boosted trees of the same rows, which are binned once."""
    binned = binned_table(train, features, label, key)
    # a fit with a key of its own bins its rows by that
    fitted = [
        fit(train, features, label, **{"key": key, "binned": None if options.get("key", key) != key else binned, **options})
        for fit, options in ((fit_forest, forest), (fit_boosting, boosting))
    ]
    drop_table(train.sparkSession, binned[1])
    return fitted


def fit_scorers(
    train: DataFrame,
    features: Sequence[str],
    key: str = "dummy_id",
    label: str = "bad",
    forest: dict | None = None,
    boosting: dict | None = None,
) -> dict[str, Scorer]:
    """Fit the three benchmark models; each becomes a function adding ``pd``."""
    logistic = fit_logistic(train, features, label)
    trees, boosted = fit_both(train, features, label, key, forest or {}, boosting or {})
    return {
        "logistic": lambda df: df.select(key, label, logistic.pd().alias("pd")),
        "forest": lambda df: predict_pd(trees, df, features, key, label),
        "boosting": lambda df: predict_pd(boosted, df, features, key, label),
    }


def compare_models(
    train: DataFrame, test: DataFrame, features: Sequence[str], label: str = "bad", **options
) -> DataFrame:
    """AUC and the other measures of all benchmark models on ``test``, one row each.

    The scored rows of all models are stacked and measured in one job.
    """
    return discrimination(_stacked(fit_scorers(train, features, label=label, **options), test), label=label, keys=["model"])


def evaluate_all(
    scorers: dict[str, Scorer],
    calibration_rows: DataFrame,
    test: DataFrame,
    method: str = "isotonic",
    label: str = "bad",
) -> DataFrame:
    """Measures of every model as fitted and after calibration on held-out rows."""
    return evaluate_curves(scorers, fit_curves(scorers, calibration_rows, method, label), test, label)


def fit_curves(scorers: dict[str, Scorer], rows: DataFrame, method: str = "isotonic", label: str = "bad") -> dict[str, Curve]:
    """The calibration curve of each model, learned on rows it was not fitted on."""
    return {name: fit_curve(scorer(rows), method, label=label) for name, scorer in scorers.items()}


def evaluate_curves(scorers: dict[str, Scorer], curves: dict[str, Curve], test: DataFrame, label: str = "bad") -> DataFrame:
    """Measures of every model as fitted and under its curve; all scored rows are measured in one job."""
    everything = None
    for name, scorer in scorers.items():
        both = curves[name].apply(scorer(test)).select(
            label,
            F.inline(
                F.array(
                    F.struct(F.lit(name + _VARIANTS[0]).alias("model"), F.col("pd")),
                    F.struct(F.lit(name + _VARIANTS[1]).alias("model"), F.col("pd_calibrated").alias("pd")),
                )
            ),
        )
        everything = both if everything is None else everything.unionByName(both)
    return discrimination(everything, label=label, keys=["model"])


def _stacked(scorers: dict[str, Scorer], df: DataFrame) -> DataFrame:
    stacked = None
    for name, scorer in scorers.items():
        scored = scorer(df).withColumn("model", F.lit(name))
        stacked = scored if stacked is None else stacked.unionByName(scored)
    return stacked
