import hashlib
import random

import numpy as np
import pytest

from scorespark.llm import suffix_dedup
from scorespark.llm.suffix_dedup import (
    LoserTree,
    front_coded,
    from_planes,
    planes,
    repeated_stretches,
)

SCHEMA = "doc_id long, text string, tid string, n_bytes string"


def brute(rows):
    """Rows that repeat doc_id and text are one document; None comes last."""
    texts = {}
    for i, t in rows:
        texts[(i is None, i or 0, (t or "").encode())] = None
    seen, out = set(), {}
    for key in sorted(texts):
        raw = key[2]
        gone = bytearray(len(raw))
        for p in range(len(raw) - 99):
            window = raw[p : p + 100]
            if window in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(window)
        left = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[key] = (len(raw), sum(gone), spans, hashlib.sha256(left).hexdigest())
    return sorted(out[(i is None, i or 0, (t or "").encode())] + (str(i),) for i, t in rows)


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA).repartition(parts)


def result(df):
    return sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, str(r.doc_id)) for r in df.collect())


def corpus(seed, docs=60):
    rng = random.Random(seed)
    vocabulary = [f"wörd{k}" for k in range(300)]
    passages = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(8, 60))) for _ in range(6)]
    rows = []
    for k in range(docs):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            parts.append(" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(30))))
            if rng.random() < 0.6:
                p = rng.choice(passages)
                a, b = sorted(rng.randrange(len(p)) for _ in range(2))
                parts.append(rng.choice([p, p[a:b], p[a:], p[:b]]))
        rows.append((k, " ".join(parts)))
    for k in range(12):
        i, t = rng.choice(rows)
        at = rng.randrange(max(1, len(t)))
        rows.append((100 + k, rng.choice([t, t[:at] + "X" + t[at:], t[at:], t + t])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_same_as_brute_force(spark, seed, monkeypatch):
    rows = corpus(seed)
    assert result(repeated_stretches(frame(spark, rows))) == brute(rows)


def test_periodic_texts(spark):
    rows = [(1, "ab" * 400), (2, "a" * 350), (3, "x" + "a" * 120 + "y"), (4, "ab" * 60), (5, "abc " * 100 + "end"), (6, "c " + "abc " * 30)]
    assert result(repeated_stretches(frame(spark, rows))) == brute(rows)


def test_edge_rows(spark):
    long = " ".join(str(k * k) for k in range(3000))
    rows = [(1, None), (2, ""), (3, "short"), (4, "short"), (5, "z" * 99), (6, long), (7, long), (None, long + "!"), (8, "q" + long[:100]), (8, long[5:300]), (9, long[:50]), (6, long), (10, "e" * 100), (11, "e" * 100), (12, "é" * 50 + "w")]
    assert result(repeated_stretches(frame(spark, rows))) == brute(rows)
    assert repeated_stretches(frame(spark, rows).limit(0)).count() == 0


def test_spans_are_what_is_removed(spark):
    rows = corpus(5, 30)
    texts = dict(rows)
    for r in repeated_stretches(frame(spark, rows)).collect():
        raw = texts[r.doc_id].encode()
        left, at = b"", 0
        for a, b in zip(r.span_starts, r.span_ends):
            left, at = left + raw[at:a], b
        assert hashlib.sha256(left + raw[at:]).hexdigest() == r.kept_sha256


def test_loser_tree_sorts_and_knows_shared_prefixes():
    rng = random.Random(3)
    runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randrange(12))) for _ in range(rng.randrange(30))) for _ in range(7)]
    coded = [iter(list(zip(*front_coded(r)))) for r in runs]
    out = list(LoserTree(coded))
    assert [k for _, _, k in out] == sorted(k for r in runs for k in r)
    before = b""
    for _, shared, key in out:
        assert shared == len([1 for n in range(1, min(len(before), len(key)) + 1) if before[:n] == key[:n]])
        before = key


def test_planes_round_trip():
    entries = np.zeros(50, dtype=suffix_dedup._ENTRY)
    entries["gram"] = np.arange(50) * 977
    entries["pos"] = np.arange(50) ** 2
    assert (from_planes(planes(entries)) == entries).all()
