"""The fixed scorecard applied end to end: split, impute, score, band, summarise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorespark.operators.bands import band_summary, fit_bands
from scorespark.operators.preparing import fit_imputer
from scorespark.operators.scorecard import FROZEN_MODEL, score_population
from scorespark.operators.splitting import fit_cuts, shares_of_all, two_way
from scorespark.session import stage
from scorespark.sources.applicants import applicants

MODEL_INPUTS = tuple(FROZEN_MODEL.coefficients)


def base(spark: SparkSession, folder: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The applicant table, written once because fitting reads it several times."""
    df = applicants(spark, folder)
    return stage(df.select(*columns) if columns else df, "applicants")


def split_base(
    spark: SparkSession, folder: str, columns: Sequence[str] | None = None, scheme=None
) -> DataFrame:
    df = base(spark, folder, columns)
    return fit_cuts(df, scheme or shares_of_all()).apply(df)


def frozen_scores(
    spark: SparkSession, folder: str, scheme=None, extra: Sequence[str] = ()
) -> DataFrame:
    """Applicants with split, imputed model inputs, ``pd`` and ``score``."""
    columns = ["dummy_id", "bad", *MODEL_INPUTS, *extra]
    df = split_base(spark, folder, columns, scheme or two_way())
    imputer = fit_imputer(df, columns=MODEL_INPUTS, categorical=False)
    return score_population(imputer.apply(df), FROZEN_MODEL.pd())


def frozen_scores_all(spark: SparkSession, folder: str, extra: Sequence[str] = ()) -> DataFrame:
    """As :func:`frozen_scores` without a split: medians over all rows."""
    df = base(spark, folder, ["dummy_id", "bad", *MODEL_INPUTS, *extra])
    imputer = fit_imputer(df, fit_on="all", columns=MODEL_INPUTS, categorical=False)
    return score_population(imputer.apply(df), FROZEN_MODEL.pd())


def held_out_band_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Band table of the test rows."""
    test = frozen_scores(spark, folder).where(F.col("split") == "test")
    return band_summary(fit_bands(test).apply(test))
