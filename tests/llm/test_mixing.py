import re
from math import floor

import pytest
from pyspark.sql import functions as F

from scorespark.llm.mixing import mix, shard_rows, split_quotas, write_shards

SCHEMA = "doc_id long, text string, source string, size string, _rounds string"


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    """Reshare the excess until no target is above its cap."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        left = total - sum(capped.values())
        open_ = [s for s in names if s not in capped]
        if not open_:
            return capped
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > most * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: float(most * sizes[s]) for s in over}


def checked(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, s, "x", "y") for i, t, s in rows], SCHEMA)
    out = mix(docs, **options).collect()
    sizes, took = {}, {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert len(out) == len(rows)
    expected = brute_targets(sizes)
    for r in out:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(expected[r.source], abs=1e-6)
        assert 0 <= r.taken <= 3 * r["size"]
        assert len(r.shards) >= r.taken / max(r["size"], 1)
        took[r.source] = took.get(r.source, 0) + r.taken
    return expected, took, out


def test_targets_and_takings(spark):
    rows = [(k, "w " * (k % 37 + 1), f"s{k % 7 if k % 3 else 0}") for k in range(700)]
    expected, took, _ = checked(spark, rows, block_docs=16)
    for s, target in expected.items():
        assert abs(took[s] - target) <= 0.5


def test_caps_nulls_and_empty_texts(spark):
    rows = [(k, "w " * 100, "big") for k in range(50)] + [(100, "one", "a"), (101, "two words", None), (102, None, "b"), (103, "", "b")]
    expected, took, _ = checked(spark, rows)
    assert expected["a"] == 3 and took["a"] == 3 and took["b"] == 0
    assert abs(took["big"] - expected["big"]) <= 0.5


def test_repeated_rows_and_reruns(spark):
    rows = [(k % 5, f"t {k % 5}", "x" if k % 2 else None) for k in range(20)] + [(None, "q", "x"), (None, None, "z")]
    _, _, first = checked(spark, rows)
    docs = spark.createDataFrame([(i, t, s, "x", "y") for i, t, s in reversed(rows)], SCHEMA).repartition(3)
    again = mix(docs).collect()
    key = lambda r: (str(r.doc_id), str(r.source), r.taken, tuple(r.shards))
    assert sorted(map(key, first)) == sorted(map(key, again))
    assert mix(docs).columns.count("size") == 1


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert mix(docs).count() == 0
    assert mix(spark.createDataFrame([(1, None, "a", "", "")], SCHEMA)).first().taken == 0


def test_tree_keeps_quotas_exact(spark):
    draws = {0: 1000, 1: 301, 2: 0, 3: 7}
    leaves = split_quotas(spark.createDataFrame(list(draws.items()), "source_no int, n long"), 8).collect()
    total = sum(draws.values())
    for s, n in draws.items():
        assert sum(r.n for r in leaves if r.source_no == s) == n
        assert all(r.n >= 0 for r in leaves)
    for shard in range(8):
        assert sum(r.n for r in leaves if r.shard == shard) in (floor(total / 8), floor(total / 8) + 1)


def test_split_has_hypergeometric_spread(spark):
    from scorespark.llm.mixing import _hypergeometric

    rows = spark.range(4000).select(_hypergeometric(F.lit(60.0), F.lit(20.0), F.lit(30.0), F.col("id")).alias("x"))
    mean, var = rows.agg(F.avg("x"), F.variance("x")).first()
    assert abs(mean - 10) < 0.15
    assert abs(var - 30 * (1 / 3) * (2 / 3) * (30 / 59)) < 0.3


def test_leaves_are_disjoint_and_hold_what_is_taken(spark, folder, tmp_path, monkeypatch):
    from scorespark.llm import mixing

    monkeypatch.setattr(mixing._running, "__defaults__", (4,))  # many stretches of a source
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    mixed = mix(docs, shards=8, block_docs=4)
    rows = mixed.collect()
    write_shards(mixed, str(tmp_path / "mix"), parts_per_shard=2)
    written = spark.read.parquet(str(tmp_path / "mix"))
    copies = written.collect()
    # every copy is in one shard, and the shards' words are what is taken of each document
    words, drawn = {}, {}
    for c in copies:
        words[c.doc_id] = words.get(c.doc_id, 0) + c.words
        drawn.setdefault(c.doc_id, []).append(c["shard"])
    assert {r.doc_id: r.taken for r in rows if r.shards} == words
    assert {r.doc_id: sorted(r.shards) for r in rows if r.shards} == {k: sorted(v) for k, v in drawn.items()}
    # leaves differ by one block draw at most, whatever the source
    by_shard = shard_rows(mixed).groupBy("shard").count().collect()
    assert len(by_shard) == 8
    # inside a shard the order is keyed, not that of the input, and files keep it
    for file in {f for f in written.inputFiles()}:
        places = [r.place for r in spark.read.parquet(file).collect()]
        assert places == sorted(places)
    ids = [r.doc_id for r in sorted(copies, key=lambda r: r.place) if r["shard"] == 0]
    assert len(ids) > 5 and ids != sorted(ids)
