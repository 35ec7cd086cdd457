"""Column roles of an applicant table.

Every operator that has to know which column is the label, the key, an outcome
column or a feature takes a :class:`FeatureSpec`. Adding a feature or changing
the label is a change to the spec, never to an operator.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# --- fixed values: names of the applicant table's columns -------------------
TARGET = "bad"
ID_COLUMNS = ("dummy_id",)
LEAKAGE_COLUMNS = ("num_accounts_perf", "highest_arrears_perf", "age_oldest_perf")
DIMENSIONS = (
    "dim_judgement",
    "dim_core_traits",
    "dim_emotional_understanding",
    "dim_principles",
)
ITEMS = (
    "r_ho_tc1_ag",
    "r_ho_em2_co",
    "r_ho_tc3_di",
    "r_ho_tc4_so",
    "r_ho_vi1_cn",
    "r_ho_vi5_ss",
    "r_ho_em3_sp",
    "r_ho_vi3_ac",
    "r_ho_em1_es",
    "r_ho_tc2_oc",
    "r_ho_vi4_st",
    "r_ho_vi2_cv",
    "r_ho_jd_cm",
    "r_sf_em1_ad",
    "r_sf_em2_af",
    "r_sf_tc1_al",
    "r_sf_tc11_as",
    "r_sf_em3_bo",
    "r_sf_tc2_cm",
    "r_sf_em6_cb",
    "r_sf_em7_cp",
    "r_sf_tc4_du",
    "r_sf_tc3_ex",
    "r_sf_tc5_el",
    "r_sf_vi1_fv",
    "r_sf_vi7_he",
    "r_sf_em8_im",
    "r_sf_vi5_ma",
    "r_sf_em4_mi",
    "r_sf_tc6_or",
    "r_sf_tc7_pe",
    "r_sf_vi6_po",
    "r_sf_dm1_ps",
    "r_sf_tc8_pr",
    "r_sf_vi4_rn",
    "r_sf_tc12_re",
    "r_sf_em5_sc",
    "r_sf_tc9_sd",
    "r_sf_vi2_tv",
    "r_sf_tc10_wl",
    "r_sf_vi3_av",
    "r_sf_dm2_cs",
)
COMPOSITES = ("total_risk_score", "risk_mitigators", "risk_drivers")
BUREAU_ASSESS = ("num_accounts_assess", "worst_arrears_assess", "age_oldest_assess")
CATEGORICAL = ("product_type",)
RANDOM_STATE = 42
# -----------------------------------------------------------------------------

BASE_FEATURES = DIMENSIONS + ITEMS + COMPOSITES + BUREAU_ASSESS + CATEGORICAL


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns are label, key and outcome; everything else is a feature."""

    target: str = TARGET
    ids: tuple[str, ...] = ID_COLUMNS
    leakage: tuple[str, ...] = LEAKAGE_COLUMNS
    reserved: tuple[str, ...] = ("split", "fold")

    @property
    def key(self) -> str:
        return self.ids[0]

    def features(self, df: DataFrame) -> list[str]:
        """Columns a model may see: no label, no key, no outcome column."""
        hidden = {self.target, *self.ids, *self.leakage, *self.reserved}
        return [c for c in df.columns if c not in hidden]

    def numeric(self, df: DataFrame) -> list[str]:
        """Numeric features, in column order."""
        return self._by_type(df, want_numeric=True)

    def categorical(self, df: DataFrame) -> list[str]:
        """Features that are not numeric, in column order."""
        return self._by_type(df, want_numeric=False)

    def _by_type(self, df: DataFrame, want_numeric: bool) -> list[str]:
        allowed = set(self.features(df))
        return [
            f.name
            for f in df.schema.fields
            if f.name in allowed and isinstance(f.dataType, T.NumericType) == want_numeric
        ]


DEFAULT_SPEC = FeatureSpec()


def applicant_schema() -> T.StructType:
    """Declared schema of a raw applicant file (58 columns)."""
    fields = [T.StructField(c, T.LongType()) for c in ID_COLUMNS]
    for name in BASE_FEATURES:
        kind = T.StringType() if name in CATEGORICAL else T.DoubleType()
        fields.append(T.StructField(name, kind))
    fields += [T.StructField(c, T.DoubleType()) for c in LEAKAGE_COLUMNS]
    fields.append(T.StructField(TARGET, T.IntegerType()))
    return T.StructType(fields)
