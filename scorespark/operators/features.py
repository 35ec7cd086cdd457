"""Engineered features: ratios, interactions and quantile flags."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorespark.functions.scoring import safe_ratio
from scorespark.operators.preparing import fit_rows
from scorespark.operators.quantiles import exact_quantiles

# fixed values: feature name -> the two columns whose product it is
PRODUCTS = {
    "emotional_x_stability": ("r_ho_em2_co", "r_ho_vi4_st"),
    "risk_x_emotional": ("total_risk_score", "r_ho_em2_co"),
    "drivers_x_mitigators": ("risk_drivers", "risk_mitigators"),
    "risk_x_mitigators": ("total_risk_score", "risk_mitigators"),
    "risk_x_dim_emo": ("total_risk_score", "dim_emotional_understanding"),
    "judgement_x_traits": ("dim_judgement", "dim_core_traits"),
}
FLAG_PRODUCTS = {
    "flag_risk_x_emotional": ("high_risk_flag", "high_emotional_flag"),
    "risk_x_low_stability": ("high_risk_flag", "low_stability_flag"),
}
# fixed values: flag name -> (column, quantile, side)
FLAGS = {
    "high_risk_flag": ("total_risk_score", 0.7, "above"),
    "low_risk_flag": ("total_risk_score", 0.3, "below"),
    "high_emotional_flag": ("r_ho_em2_co", 0.7, "above"),
    "low_stability_flag": ("r_ho_vi4_st", 0.3, "below"),
    "high_stability_flag": ("r_ho_vi4_st", 0.7, "above"),
}


def ratio_features(df: DataFrame) -> DataFrame:
    """Affordability, risk ratio and net risk, each where its inputs exist."""
    new = {}
    if {"income", "expenses"} <= set(df.columns):
        new["affordability_ratio"] = safe_ratio(F.col("income"), F.col("expenses") + 1)
    if {"risk_drivers", "risk_mitigators"} <= set(df.columns):
        new["risk_ratio"] = safe_ratio(F.col("risk_drivers"), F.col("risk_mitigators") + 1)
        new["net_risk"] = F.col("risk_drivers") - F.col("risk_mitigators")
    return df.withColumns(new) if new else df


def interactions(df: DataFrame, products: Mapping[str, tuple[str, str]] = PRODUCTS) -> DataFrame:
    """Products of two columns, each where both exist."""
    new = {
        name: F.col(a) * F.col(b)
        for name, (a, b) in products.items()
        if {a, b} <= set(df.columns)
    }
    return df.withColumns(new) if new else df


@dataclass(frozen=True)
class QuantileFlags:
    """Fitted thresholds: flag name -> (column, threshold, side)."""

    thresholds: Mapping[str, tuple[str, float | None, str]]

    def apply(self, df: DataFrame) -> DataFrame:
        new = {}
        for name, (column, threshold, side) in self.thresholds.items():
            if threshold is None:
                new[name] = F.lit(0)
                continue
            test = F.col(column) > threshold if side == "above" else F.col(column) < threshold
            new[name] = F.coalesce(test.cast("int"), F.lit(0))
        return df.withColumns(new) if new else df


def fit_quantile_flags(
    df: DataFrame, fit_on: str = "train", flags: Mapping[str, tuple[str, float, str]] = FLAGS
) -> QuantileFlags:
    """Thresholds of all flags from the fitting rows; flags without a column are left out."""
    present = {name: f for name, f in flags.items() if f[0] in df.columns}
    wanted: dict[str, list[float]] = {}
    for column, q, _ in present.values():
        if q not in wanted.setdefault(column, []):
            wanted[column].append(q)
    found = exact_quantiles(fit_rows(df, fit_on), wanted)
    return QuantileFlags(
        {
            name: (column, found[column][wanted[column].index(q)], side)
            for name, (column, q, side) in present.items()
        }
    )


def quantile_flag(
    df: DataFrame, column: str, q: float, direction: str = "above", name: str = "flag", fit_on: str = "train"
) -> DataFrame:
    """One 0/1 flag: strictly above, or below, the column's quantile."""
    return fit_quantile_flags(df, fit_on, {name: (column, q, direction)}).apply(df)


def create_features(df: DataFrame) -> DataFrame:
    """Row-wise features only; safe before or after a split."""
    return interactions(ratio_features(df))


def engineer_features(df: DataFrame, fit_on: str = "train") -> DataFrame:
    """All engineered features, with flag thresholds learned from the fitting rows."""
    flagged = fit_quantile_flags(df, fit_on).apply(df)
    return interactions(create_features(flagged), FLAG_PRODUCTS)
