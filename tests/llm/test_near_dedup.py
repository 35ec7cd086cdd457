import random
import re

import numpy as np
import pytest

from scorespark.llm import near_dedup
from scorespark.llm.components import components
from scorespark.llm.near_dedup import drop_near_copies, intersections, near_groups

SCHEMA = "doc_id long, text string, component_id string, node string, n_shingles string"


def brute(rows, width, percent):
    sets = {}
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        own = {tuple(words[k : k + width]) for k in range(len(words) - width + 1)} or ({tuple(words)} if words else set())
        sets.setdefault(doc_id, []).append(own)
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            if any(a and b and 100 * len(a & b) >= percent * len(a | b) for a in sets[i] for b in sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}, {i: sorted(map(len, s)) for i, s in sets.items()}


def corpus(seed, groups, copies, length=60, edits=6):
    rng = random.Random(seed)
    vocabulary = [f"W{k}" for k in range(400)]
    rows, doc = [], 0
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(1, length))]
        for _ in range(rng.randrange(1, copies + 1)):
            words = list(base)
            for _ in range(rng.randrange(edits)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((doc, " ".join(words)))
            doc += 1
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "a", "b", "c") for i, t in rows], SCHEMA).repartition(4)


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_same_groups_as_brute_force(spark, width, percent):
    rows = corpus(width, 60, 6) + corpus(9, 1, 40, 90, 4)[:0]
    got = near_groups(frame(spark, rows), width, percent).collect()
    roots, sizes = brute(rows, width, percent)
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got} == roots
    assert all([r.n_shingles] == sizes[r.doc_id] and r.kept == (r.doc_id == r.component_id) for r in got)


def test_large_cluster_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    monkeypatch.setattr(near_dedup, "SAMPLE", 2)
    rng = random.Random(4)
    base = [f"w{k}" for k in range(80)]
    rows = []
    for k in range(90):
        words = list(base)
        for _ in range(rng.randrange(9)):
            words[rng.randrange(80)] = f"x{rng.randrange(500)}"
        rows.append((k, " ".join(words)))
    rows += [(200 + k, rows[k][1].upper()) for k in range(20)]
    got = near_groups(frame(spark, rows), 3, 85).collect()
    assert {r.doc_id: r.component_id for r in got} == brute(rows, 3, 85)[0]


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "one"), (4, "ONE\n"), (5, "one two"), (6, " \t"), (7, "long " * 60000), (8, "Long " * 60000), (9, "é è"), (9, "one"), (10, "É è")]
    docs = frame(spark, rows)
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in near_groups(docs, 3, 85).collect()}
    assert got == {
        (1, 0): (1, True), (2, 0): (2, True), (3, 1): (3, True), (4, 1): (3, False), (5, 1): (5, True), (6, 0): (6, True),
        (7, 1): (7, True), (8, 1): (7, False), (9, 1): (3, False), (10, 1): (10, True),
    }
    unnamed = docs.unionByName(spark.createDataFrame([(None, "one", "a", "b", "c")], SCHEMA))
    assert [(r.component_id, r.kept) for r in near_groups(unnamed).where("doc_id is null").collect()] == [(None, True)]
    kept = drop_near_copies(unnamed)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "10", "2", "3", "5", "6", "7", "None"]
    assert near_groups(docs.limit(0)).count() == 0


def test_components_of_chains(spark):
    rng = random.Random(2)
    order = list(range(300))
    rng.shuffle(order)
    links = [(order[k], order[k + 1]) for k in range(199)] + [(order[k], order[k + 1]) for k in range(200, 299)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[k] for k in order[:200]} == {min(order[:200])} and {got[k] for k in order[200:]} == {min(order[200:])}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_intersections_of_many_sets():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 9000, 300)).astype(np.uint64) for _ in range(20)]
    table = intersections(sets)
    assert all(table[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(20) for j in range(20))
