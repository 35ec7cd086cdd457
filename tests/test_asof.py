"""The as-of join against brute force, also where one key fills many partitions."""

import random
from collections import Counter
from datetime import datetime, timedelta

from scorespark.operators.asof import asof_next
from scorespark.operators.monitoring import retraining_rows

START = datetime(2024, 1, 1)


def _tables(spark, left, right):
    a = spark.createDataFrame([(k, START + timedelta(hours=t) if t is not None else None, n) for k, t, n in left], "id long, scored_at timestamp, n int")
    b = spark.createDataFrame([(k, START + timedelta(hours=t) if t is not None else None, y) for k, t, y in right], "id long, observed_at timestamp, bad int")
    return a, b


def _brute(left, right):
    out = Counter()
    for k, t, n in left:
        later = [(u, -y) for j, u, y in right if j == k and k is not None and t is not None and u is not None and u >= t]
        best = min(later, default=None)
        out[k, n, best and best[0], best and -best[1]] += 1
    return out


def _found(df):
    hours = lambda at: None if at is None else int((at - START).total_seconds() // 3600)
    return Counter((r.id, r.n, r._found and hours(r._found.observed_at), r._found and r._found.bad) for r in df.collect())


def test_one_applicant_with_most_rows_in_many_partitions(spark):
    rng = random.Random(5)
    left, right = [], []
    for n in range(600):
        k = 7 if n % 3 == 0 else rng.randint(0, 40)
        left.append((k, rng.randint(0, 5000), n))
        if n % 4 == 0:
            right.append((k, rng.randint(0, 5000), rng.randint(0, 1)))
    left += [(50, t, 1000 + t) for t in range(300)]  # long without any outcome, then one far behind
    right += [(50, 400, 1), (50, 400, 0)]
    a, b = _tables(spark, left, right)
    found = asof_next(a, b, "id", "scored_at", "observed_at", ["bad"], slices=23)
    assert _found(found) == _brute(left, right)
    matured = retraining_rows(a, b, 10, key="id")
    want = Counter()
    for (k, n, at, bad), times in _brute(left, right).items():
        asked = next(t for j, t, m in left if m == n)
        if at is not None and at < asked + 240:
            want[k, n, bad] += times
    assert Counter((r.id, r.n, r.bad) for r in matured.collect()) == want


def test_one_key_only_spreads_over_tasks(spark):
    left = [(1, t, t) for t in range(2000)]
    right = [(1, 1999, 1), (1, 3, 0)]
    a, b = _tables(spark, left, right)
    found = asof_next(a, b, "id", "scored_at", "observed_at", ["bad"], slices=16)
    assert _found(found) == _brute(left, right)
    line = a.repartitionByRange(16, "id", "scored_at")
    assert line.selectExpr("spark_partition_id() p").distinct().count() > 8


def test_nulls_ties_and_empty_sides(spark):
    left = [(1, 5, 1), (1, 5, 1), (1, None, 2), (None, 5, 3), (2, 9, 4)]
    right = [(1, 5, 0), (1, 5, 1), (None, 6, 1), (2, None, 1)]
    a, b = _tables(spark, left, right)
    for x, y in ((left, right), (left, []), ([], right)):
        p, q = (a if x else a.limit(0)), (b if y else b.limit(0))
        assert _found(asof_next(p, q, "id", "scored_at", "observed_at", ["bad"])) == _brute(x, y)
