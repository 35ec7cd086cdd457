import math
import random

import numpy as np

from scorespark.llm import vectors
from scorespark.llm.vectors import top_k

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, k=5):
    whole = []
    for vec_id, x in rows:
        if vec_id is not None and x is not None and all(v is not None and math.isfinite(v) for v in x):
            whole.append((vec_id, [math.floor(256 * v) if abs(v) < 2.0**44 else int(v) * 256 for v in x]))
    out = []
    for q, a in whole:
        if q % 50 == 0:
            scores = sorted((-max(min(sum(s * t for s, t in zip(a, b)), 2**63 - 1), -(2**63)), c) for c, b in whole if c != q)
            out += [(q, rank + 1, c, -s) for rank, (s, c) in enumerate(scores[:k])]
    return sorted(out)


def found(spark, rows, k=5):
    table = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in top_k(table, table.where("vec_id % 50 = 0"), k).collect())


def test_equals_brute_force_on_embeddings(spark, folder):
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    got = sorted(tuple(r) for r in top_k(table, table.where("vec_id % 50 = 0"), 5).collect())
    assert got == brute([(r.vec_id, r.embedding) for r in table.collect()])


def test_many_groups_ties_and_copies(spark, monkeypatch):
    monkeypatch.setattr(vectors, "GROUP", 16)
    monkeypatch.setattr(vectors, "QUERIES", 2)
    monkeypatch.setattr(vectors, "GROUPS_PER_LANE", 3)
    monkeypatch.setattr(vectors, "QUERY_GROUPS_PER_LANE", 2)
    rng = random.Random(3)
    rows = [(k, [rng.gauss(0, 0.2) for _ in range(12)]) for k in range(-300, 300)]
    rows += [(k, rows[5][1]) for k in range(1000, 1301)]  # a third of all are one vector
    rows += [(k, [float(rng.randint(-1, 1)) for _ in range(12)]) for k in range(2000, 2100)]  # many ties
    assert found(spark, rows) == brute(rows)


def test_repeated_groups_do_not_pass_through_the_driver(spark, monkeypatch):
    plans, stage = [], vectors.stage

    def seen(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df, label)

    monkeypatch.setattr(vectors, "stage", seen)
    table = spark.createDataFrame([(k, [k * 0.01, 1.0]) for k in range(200)], SCHEMA)
    found = top_k(table, table.where("vec_id % 50 = 0"), 5)
    joins = [x for plan in [*plans, found._jdf.queryExecution().executedPlan().toString()] for x in plan.splitlines() if "Join [lane" in x]
    assert len(joins) == 2 and all("SortMergeJoin" in x for x in joins)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [0.5, -0.25]), (0, [0.5, -0.25]), (0, [1.0, 1.0]), (50, []), (100, [3.0]), (150, [1e30, 2.0]), (1, [1e30, 2.0]), (2, [-1e30]),
        (3, None), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf]), (None, [9.0, 9.0]), (7, [0.1] * 3000), (8, [0.003, 4095.0]), (-50, [1.0, 2.0]),
        (200, None), (9, [2.0**50, 1.0]),
    ]
    assert found(spark, rows) == brute(rows)
    wide = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as score", "2 as grp", "3 as ids", "4 as parts", "5 as x", "6 as wide")
    assert sorted(tuple(r) for r in top_k(wide, wide.where("vec_id % 50 = 0"), 5).collect()) == brute(rows)
    assert found(spark, rows[:1]) == [] and found(spark, rows[8:12]) == []
    assert top_k(wide.limit(0), wide.limit(0), 5).count() == 0


def test_cells_bound_every_product():
    rng = np.random.default_rng(4)
    data = rng.integers(-300, 300, (500, 9))
    borders = np.quantile(data, [k / 16 for k in range(1, 16)], axis=0).T.round()
    low = np.hstack([data.min(0)[:, None], borders])
    high = np.hstack([borders - 1, data.max(0)[:, None]])
    cells = vectors.Cells(borders, low, high)
    lows, highs = cells.edges(cells.of(data))
    queries = rng.integers(-300, 300, (20, 9)).astype(float)
    exact = queries @ data.T
    assert (vectors.bounds(queries, lows, highs, True) <= exact).all() and (vectors.bounds(queries, lows, highs, False) >= exact).all()
