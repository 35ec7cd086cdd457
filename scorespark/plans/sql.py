"""Building blocks of the checking SQL: applicants, splits, imputation, frozen scores."""

from __future__ import annotations

from scorespark.functions.scoring import BAND_SCALE, POINTS_SCALE
from scorespark.operators.scorecard import FROZEN_MODEL, LinearModel
from scorespark.sources.applicants import applicant_columns

APPLICANTS = """
l AS (SELECT l_orderkey,
  CAST(COUNT(*) AS DOUBLE) AS n_lines,
  SUM(l_quantity) AS sum_qty, MAX(l_quantity) AS max_qty, MIN(l_quantity) AS min_qty,
  CAST(SUM(CAST(ROUND(l_discount * 100) AS INT)) AS DOUBLE) AS sum_disc,
  CAST(MAX(CAST(ROUND(l_discount * 100) AS INT)) AS DOUBLE) AS max_disc,
  CAST(SUM(CAST(ROUND(l_tax * 100) AS INT)) AS DOUBLE) AS sum_tax,
  CAST(MAX(CAST(ROUND(l_tax * 100) AS INT)) AS DOUBLE) AS max_tax,
  CAST(DATEDIFF('day', MIN(l_shipdate), MAX(l_shipdate)) AS DOUBLE) AS ship_span,
  CAST(SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS DOUBLE) AS r_lines,
  CAST(SUM(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS DOUBLE) AS n_flag_lines,
  MAX(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS r_max_qty
  FROM lineitem GROUP BY l_orderkey),
a AS (SELECT o.o_orderkey AS dummy_id,
  CASE WHEN l.l_orderkey IS NULL THEN NULL ELSE c.c_mktsegment END AS product_type,
  l.sum_qty AS total_risk_score, l.sum_disc AS risk_drivers, l.sum_tax AS risk_mitigators,
  c.c_acctbal AS dim_judgement, o.o_totalprice AS dim_core_traits,
  l.max_disc AS dim_emotional_understanding, CAST(c.c_nationkey AS DOUBLE) AS dim_principles,
  l.max_qty AS r_ho_em2_co, l.min_qty AS r_ho_vi4_st,
  l.n_lines AS num_accounts_assess, l.max_tax AS worst_arrears_assess, l.ship_span AS age_oldest_assess,
  o.o_totalprice AS income, c.c_acctbal AS expenses,
  l.n_flag_lines AS num_accounts_perf, l.r_lines AS highest_arrears_perf, l.r_max_qty AS age_oldest_perf,
  CASE WHEN COALESCE(l.r_lines, 0) >= 2 THEN 1 ELSE 0 END AS bad
  FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN l ON l.l_orderkey = o.o_orderkey)"""

COLUMNS = list(applicant_columns())
HIDDEN = ("dummy_id", "product_type", "bad", "num_accounts_perf", "highest_arrears_perf", "age_oldest_perf")
NUMERIC = [c for c in COLUMNS if c not in HIDDEN]


def dbl(x: float) -> str:
    """A DOUBLE literal (a plain decimal would be a DECIMAL)."""
    text = repr(float(x))
    return text if "e" in text else text + "e0"


def r6(expr: str, name: str) -> str:
    return f"ROUND({expr}, 6) AS {name}"


def _held_out(name: str, source: str, fraction: str) -> str:
    """CTE ``name(bad, c, q)``: q rows of class ``bad`` are held out of c."""
    return f"""
{name}_t AS (SELECT bad, c, CAST(SUM(c) OVER () AS DOUBLE) AS total FROM {source}),
{name}_k AS (SELECT *, total - CEIL({fraction} * total) AS kept FROM {name}_t),
{name}_r AS (SELECT *, c * kept / total AS exact,
  ROW_NUMBER() OVER (ORDER BY c * kept / total - FLOOR(c * kept / total) DESC, bad) AS place,
  kept - SUM(FLOOR(c * kept / total)) OVER () AS extra FROM {name}_k),
{name} AS (SELECT bad, c,
  CAST(c - FLOOR(exact) - CASE WHEN place <= extra THEN 1 ELSE 0 END AS BIGINT) AS q FROM {name}_r)"""


_RANKED = """
n AS (SELECT bad, COUNT(*) AS c FROM a GROUP BY bad),
k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY bad
  ORDER BY md5(CAST(dummy_id AS VARCHAR) || ':42')) AS place FROM a)"""


def split_cte(kind: str = "shares") -> str:
    """CTEs up to ``s``: applicants with their split, as one of three schemes."""
    if kind == "two":
        quotas, case = _held_out("t", "n", "3e-1"), "CASE WHEN place <= t.q THEN 'test' ELSE 'train' END"
        joins = "JOIN t ON t.bad = k.bad"
    elif kind == "holdout":
        quotas = (
            _held_out("h", "n", "3e-1")
            + ", hc AS (SELECT bad, q AS c FROM h),"
            + _held_out("t", "hc", "67e-2")
        )
        case = "CASE WHEN place <= t.q THEN 'test' WHEN place <= h.q THEN 'val' ELSE 'train' END"
        joins = "JOIN t ON t.bad = k.bad JOIN h ON h.bad = k.bad"
    else:
        quotas = (
            _held_out("t", "n", "2e-1")
            + ", rest AS (SELECT bad, c - q AS c FROM t),"
            + _held_out("v", "rest", "(1e-1 / (1 - 2e-1))")
        )
        case = "CASE WHEN place <= t.q THEN 'test' WHEN place <= t.q + v.q THEN 'val' ELSE 'train' END"
        joins = "JOIN t ON t.bad = k.bad JOIN v ON v.bad = k.bad"
    return f"{APPLICANTS}, {_RANKED}, {quotas},\ns AS (SELECT k.* EXCLUDE (place), {case} AS split FROM k {joins})"


def imputed_cte(source: str, columns: list[str], where: str = "TRUE", name: str = "i") -> str:
    """CTE ``i``: ``source`` with medians (of the rows in ``where``) for NULL."""
    medians = ", ".join(f"MEDIAN({c}) AS {c}" for c in columns)
    filled = ", ".join(f"COALESCE({source}.{c}, med.{c}) AS {c}" for c in columns)
    return (
        f"med AS (SELECT {medians} FROM {source} WHERE {where}),\n"
        f"{name} AS (SELECT {source}.* REPLACE ({filled}) FROM {source} CROSS JOIN med)"
    )


def margin(model: LinearModel = FROZEN_MODEL) -> str:
    return " + ".join([dbl(model.intercept)] + [f"({dbl(w)}) * {c}" for c, w in model.coefficients.items()])


def pd_expr(model: LinearModel = FROZEN_MODEL) -> str:
    return f"1e0 / (1e0 + EXP(-({margin(model)})))"


def score_expr(pd: str = "pd", scale=BAND_SCALE) -> str:
    p = f"LEAST(GREATEST({pd}, 1e-6), 1e0 - 1e-6)"
    return f"{dbl(scale.offset)} + {dbl(scale.factor)} * LN((1e0 - {p}) / {p})"


def points_expr() -> str:
    return f"CAST(ROUND_EVEN({dbl(POINTS_SCALE.offset)} - {dbl(POINTS_SCALE.factor)} * ({margin()}), 0) AS INTEGER)"


MODEL_INPUTS = list(FROZEN_MODEL.coefficients)


def scored_cte(kind: str | None = "two") -> str:
    """CTEs up to ``f``: every applicant, imputed, with ``pd`` and ``score``.

    Medians come from the training rows of the split, or from all rows without one.
    """
    head = f"{APPLICANTS}, " if kind is None else f"{split_cte(kind)}, "
    source, where = ("a", "TRUE") if kind is None else ("s", "split = 'train'")
    return (
        head
        + imputed_cte(source, MODEL_INPUTS, where)
        + f",\np AS (SELECT *, {pd_expr()} AS pd FROM i),\nf AS (SELECT *, {score_expr()} AS score FROM p)"
    )


def quantile_edges(value: str, source: str, bins: int) -> str:
    """A sorted list of distinct quantile edges."""
    marks = ", ".join(dbl(i / bins) for i in range(bins + 1))
    return f"(SELECT LIST_SORT(LIST_DISTINCT(QUANTILE_CONT({value}, [{marks}]))) FROM {source})"


def bin_of(value: str, edges: str) -> str:
    """Right-closed bin number of ``value``; values outside go to the end bins."""
    return (
        f"LEAST(GREATEST(1, LEN(LIST_FILTER({edges}, lambda e: e < {value}))), GREATEST(1, LEN({edges}) - 1))"
    )


def banded_cte(source: str = "f", where: str = "TRUE", name: str = "b") -> str:
    """CTEs up to ``b``: rows of ``source`` in ``where`` with their band."""
    return f"""
r AS (SELECT * FROM {source} WHERE {where}),
edges AS (SELECT {quantile_edges('score', 'r', 5)} AS e),
{name} AS (SELECT r.*, SUBSTR('ABCDE', CAST(LEN(e) - {bin_of('score', 'e')} AS INTEGER), 1) AS band
  FROM r CROSS JOIN edges)"""


BAND_LIST = "(SELECT UNNEST(['A','B','C','D','E']) AS band, UNNEST([1,2,3,4,5]) AS band_rank)"


def cumulative_cte(source: str, score: str, label: str = "bad", key: str | None = None) -> str:
    """CTEs up to ``cum``: class counts and running totals per distinct score."""
    k, part = (f"{key}, ", f"PARTITION BY {key}") if key else ("", "")
    return f"""
cnt AS (SELECT {k}{score} AS s, CAST(SUM(1 - {label}) AS DOUBLE) AS g, CAST(SUM({label}) AS DOUBLE) AS b
  FROM {source} WHERE {score} IS NOT NULL GROUP BY {k}{score}),
cum AS (SELECT *, SUM(g) OVER ({part} ORDER BY s) AS cg, SUM(b) OVER ({part} ORDER BY s) AS cb,
  SUM(g) OVER ({part}) AS tg, SUM(b) OVER ({part}) AS tb FROM cnt)"""
