"""Boosted and bagged trees: the same on any partitions, and as a plain fit by loops."""

import math

import numpy as np
import pytest

from scorespark.models import histogram_trees as ht
from scorespark.models.trees import Trees

NAMES = list("abcd")
SCHEMA = "dummy_id long, a double, b double, c double, d double, bad int"


def _rows(n=700):
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(n, 4)), 2)
    x[:, 3] = rng.integers(0, 3, n)
    bad = (x[:, 0] + x[:, 1] * x[:, 2] + x[:, 3] + rng.normal(size=n) > 1).astype(int)
    return [(k, *map(float, r), int(y)) for k, (r, y) in enumerate(zip(x, bad))]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(_rows(), SCHEMA).cache()


@pytest.mark.parametrize("fit", [lambda d: ht.fit_boosted_trees(d, NAMES, trees=4, depth=3), lambda d: ht.fit_bagged_trees(d, NAMES, trees=4, depth=3)])
def test_partitions_do_not_matter(rows, fit):
    models = [fit(rows.repartition(parts, "a")) for parts in (1, 5, 32)]
    assert models[0] == models[1] == models[2] and len(models[0].at) > 20


def _quantile_cuts(values):
    s = sorted(values)
    out = set()
    for k in range(1, ht.BINS):
        position = k / ht.BINS * (len(s) - 1)
        low = math.floor(position)
        out.add(s[low] if position == low else s[low] + (s[low + 1] - s[low]) * (position - low))
    return sorted(out)


def _plain_boosting(spark, table, trees, depth, rate, rows, columns, alpha, lam, least, seed):
    """Margins after boosting, row by row in plain loops."""
    keys = {r.dummy_id: r.h for r in spark.createDataFrame(table, SCHEMA).selectExpr("dummy_id", "xxhash64(dummy_id) AS h").collect()}
    y = [r[-1] for r in table]
    cuts = [_quantile_cuts([r[1 + k] for r in table]) for k in range(4)]
    margin = [math.log(sum(y) / (len(y) - sum(y)))] * len(table)

    def part(g, h):
        return max(abs(g) - alpha, 0) ** 2 / (h + lam)

    for number in range(trees):
        chosen = sorted(np.random.default_rng([seed, number]).permutation(4)[: math.ceil(columns * 4)])
        p = [1 / (1 + math.exp(-m)) for m in margin]
        u = ht.uniform(np.array([keys[r[0]] for r in table]), number, seed)
        g = [round((a - b) * ht.SCALE) / ht.SCALE for a, b in zip(p, y)]
        h = [round(a * (1 - a) * ht.SCALE) / ht.SCALE for a in p]

        def grow(members, left_depth):
            sample = [i for i in members if u[i] < rows]
            total_g, total_h = sum(g[i] for i in sample), sum(h[i] for i in sample)
            best = (1e-9, None)
            for f in chosen if left_depth else ():
                for cut in cuts[f]:
                    left = [i for i in sample if table[i][1 + f] <= cut]
                    lg, lh = sum(g[i] for i in left), sum(h[i] for i in left)
                    if min(lh, total_h - lh) < least:
                        continue
                    gain = part(lg, lh) + part(total_g - lg, total_h - lh) - part(total_g, total_h)
                    if gain > best[0]:
                        best = (gain, (f, cut))
            if best[1] is None:
                step = -rate * math.copysign(max(abs(total_g) - alpha, 0), total_g) / (total_h + lam)
                for i in members:
                    margin[i] += step
                return
            f, cut = best[1]
            grow([i for i in members if table[i][1 + f] <= cut], left_depth - 1)
            grow([i for i in members if table[i][1 + f] > cut], left_depth - 1)

        grow(range(len(table)), depth)
    return {r[0]: 1 / (1 + math.exp(-m)) for r, m in zip(table, margin)}


def test_boosting_equals_plain_loops(spark):
    table = _rows(160)
    options = dict(trees=13, depth=3, rate=0.3, rows=0.8, columns=0.7, alpha=0.5, lam=1.5, least=1.0, seed=7)
    want = _plain_boosting(spark, table, **options)
    df = spark.createDataFrame(table, SCHEMA)
    model = ht.fit_boosted_trees(df, NAMES, **options)
    got = {r.dummy_id: r.pd for r in df.select("dummy_id", model.pd().alias("pd")).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_penalties_shrink_leaves(rows):
    def widest(**options):
        return max(map(abs, ht.fit_boosted_trees(rows, NAMES, trees=1, depth=2, **options).value[1:]))

    assert widest(alpha=20.0) < widest() and widest(lam=200.0) < widest()
    assert len(ht.fit_boosted_trees(rows, NAMES, trees=1, depth=2, least=1e6).at) == 2


def test_forest_is_sound(rows):
    model = ht.fit_bagged_trees(rows, NAMES, trees=25, depth=5, min_leaf=5)
    scored = rows.select("bad", model.pd().alias("pd")).toPandas()
    assert scored.pd.between(0, 1).all()
    assert scored.pd[scored.bad == 1].mean() - scored.pd[scored.bad == 0].mean() > 0.25
    counts = ht.poisson_counts(ht.uniform(np.arange(20000), 3, 1))
    assert abs(counts.mean() - 1) < 0.03 and abs(counts.var() - 1) < 0.05


def test_edge_tables(spark, rows):
    for model in (ht.fit_boosted_trees, ht.fit_bagged_trees):
        for table in (rows.limit(0), rows.where("bad = 1"), rows.where("bad = 0")):
            fitted = model(table, NAMES, trees=2, depth=2)
            assert isinstance(fitted, Trees) and all(at == -1 for at in fitted.at)
    holes = spark.createDataFrame([(900, None, 1.0, 1.0, 1.0, 1), (901, float("nan"), 1.0, 1.0, 1.0, 0), (902, 1.0, 1.0, 1.0, 1.0, None)], SCHEMA)
    assert ht.fit_boosted_trees(rows.unionByName(holes), NAMES, trees=2, depth=2) == ht.fit_boosted_trees(rows, NAMES, trees=2, depth=2)


def test_tasks_follow_the_cores_not_the_rows(spark, rows, monkeypatch):
    seen, grow = [], ht._grow
    monkeypatch.setattr(ht, "ROWS_A_TASK", 10)
    monkeypatch.setattr(ht, "_grow", lambda table, *more: (seen.append(table.rdd.getNumPartitions()), grow(table, *more))[1])
    spread = ht.fit_boosted_trees(rows.repartition(32, "a"), NAMES, trees=2, depth=3)
    assert max(seen) <= spark.sparkContext.defaultParallelism
    monkeypatch.setattr(ht, "ROWS_A_TASK", 20_000)
    monkeypatch.setattr(ht, "TASKS", 0)  # cells meet in an aggregation
    assert ht.fit_boosted_trees(rows, NAMES, trees=2, depth=3) == spread


def test_nodes_on_features_of_their_own_are_counted_from_their_rows():
    rng = np.random.default_rng(8)
    bins = rng.integers(0, ht.BINS, (4, 500)).astype(np.uint8)
    loss, tree = ht.Bagging(1.0, 3), ht.Growing(0)
    tree.split(0, 1, 12, (0.0, 0.0), [(0.0, 0.0)] * 2)
    tree.split(2, 3, 20, (0.0, 0.0), [(0.0, 0.0)] * 2)
    y = (rng.random(500) < 0.4).astype(float)
    g, h = loss.weights(rng.integers(-(2**62), 2**62, 500), y, np.zeros(500), 0)
    counted = {1: np.array([0, 2]), 4: np.array([1, 3])}
    found = ht._sums(loss, [h / ht.SCALE * ht.PACK + g / loss.unit], tree, counted, bins)
    leaf = tree.leaves(bins)
    assert {k: rows.tolist() for k, rows in tree.members(bins, np.arange(500)).items()} == {k: np.flatnonzero(leaf == k).tolist() for k in (1, 3, 4)}
    for place, (node, features) in enumerate(counted.items()):
        for j, f in enumerate(features):
            for b in range(ht.BINS):
                mine = (leaf == node) & (bins[f] == b)
                assert found[:, place, j, b].tolist() == [int(g[mine].sum()), int(h[mine].sum())]


def test_poisson_counts_are_places_among_the_cumulated_chances():
    u = np.r_[np.random.default_rng(1).random(1000), 0.0, math.exp(-1.0), np.nextafter(1.0, 0.0)]
    chances = np.cumsum([math.exp(-1.0) / math.factorial(k) for k in range(9)])
    assert ht.poisson_counts(u).tolist() == [int(np.sum(chances <= x)) for x in u]
