import re
import zlib
from collections import Counter
from math import log10

import numpy as np
import pyarrow as pa
import pytest

from scorespark.llm.lm_score import (
    ESCAPES,
    ONLINE_RATE,
    REPEATS,
    STEP,
    TABLE_BLOCK,
    Decisions,
    Model,
    Spelling,
    _add_blocks,
    _odds,
    fit_model,
    gates,
    held_out,
    huffman,
    lm_scores,
    look_up,
    make_code,
    repeats,
    score_batch,
    spell_batch,
    spelling_code,
    start_weights,
)
from scorespark.llm.text import Words, buffers

SCHEMA = "doc_id long, text string, n int, word string, score string"


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


def brute_base(rows):
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    counts = Counter(t for (_, text), h in zip(rows, held) if not h for t in tokens(text))
    scale = log10(sum(counts.values()) + len(counts) + 1)
    out = []
    for (i, text), h in zip(rows, held):
        own = tokens(text)
        out.append((i, h, len(own), sum(counts[t] > 0 for t in own), sum(counts.values()), sum(log10(counts[t] + 1) - scale for t in own)))
    return out


@pytest.mark.parametrize("base_words", [1 << 20, 50, 0])
def test_base_equals_brute_force(spark, base_words):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: r for r in lm_scores(docs, 500, base_words).collect()}
    for i, h, n, known, total, base in brute_base(rows):
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score < 0 and np.isfinite(r.score)


def test_better_than_the_base_on_held_out_texts_and_the_same_twice(spark):
    rows = [(k, f"The red fox number {k % 9} jumps over the lazy dog. " * (1 + k % 4)) for k in range(300)]
    docs = spark.createDataFrame([(i, t, 1, "w", "s") for i, t in rows], SCHEMA)
    first = {r.doc_id: r for r in lm_scores(docs).collect()}
    again = {r.doc_id: r.score for r in lm_scores(docs.repartition(5)).collect()}
    held = [r for r in first.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(again[i] == pytest.approx(r.score, rel=1e-5) for i, r in first.items())
    r = first[held[0].doc_id]
    assert r.bits_per_byte == pytest.approx(-r.score / log10(2) / len(rows[r.doc_id][1]))


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "x"), (5, "É é UPPER upper"), (5, "again"), (6, "long " * 40000), (7, "z" * 50000)]
    docs = spark.createDataFrame([(i, t, 1, "w", "s") for i, t in rows], SCHEMA)
    got = lm_scores(docs).collect()
    assert sorted((str(r.doc_id), r.n_tokens, round(r.base_score, 6)) for r in got) == sorted(
        (str(i), n, round(b, 6)) for i, _, n, _, _, b in brute_base(rows)
    )
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)
    assert lm_scores(docs.limit(0)).count() == 0
    assert lm_scores(docs.where("doc_id = 9")).count() == 0


def test_huffman_is_a_complete_prefix_code():
    start, length, node, bit = huffman([5, 1, 1, 2, 9])
    codes = ["".join(map(str, bit[s : s + n])) for s, n in zip(start, length)]
    assert sum(2.0 ** -len(c) for c in codes) == 1
    assert not any(a != b and b.startswith(a) for a in codes for b in codes)
    assert length[4] == min(length)


def read_back(symbols, code, words):
    names = {int(code.symbols[look_up(code.words, Words(*buffers(pa.array([w]))).hashes())[0]]): w for w in words}
    return ["|" if s == code.end else "?" if s == code.escape else names[s] for s in symbols]


def test_decisions_and_spellings_give_the_text():
    known = ["the", "fox"]
    code = make_code(Words(*buffers(pa.array(["the fox"]))).hashes(), [9, 4], 3, 2)
    texts = ["The fox x1 the", "", "é", "fox"]
    made = Decisions(Words(*buffers(pa.array(texts))), code)
    assert read_back(made.symbol.tolist(), code, known) == ["the", "fox", "?", "the", "|", "|", "?", "|", "fox", "|"]
    assert made.escaped.tolist() == [2, 4]
    assert made.offsets[-1] == len(made.path) == len(made.outcome) == made.bits.sum()
    alone = [Decisions(Words(*buffers(pa.array([t]))), code) for t in texts]
    for k in range(3):
        assert np.array_equal(np.concatenate([d.slots(k, 16) for d in alone]), made.slots(k, 16))

    spelled = [w.encode() for w in ("x1", "é", "fox", "z" * 5000)]
    steps = Spelling(Words(*buffers(pa.array(spelled, pa.binary())), lower=False), spelling_code())
    assert bytes(steps.symbol.astype(np.uint8)) == b"".join(w + b" " for w in spelled)
    alone = [Spelling(Words(*buffers(pa.array([w], pa.binary())), lower=False), spelling_code()) for w in spelled]
    for k in range(5):
        assert np.array_equal(np.concatenate([s.slots(k, 18) for s in alone]), steps.slots(k, 18))


def test_counts_beyond_32_bits_add_up():
    block = np.full((TABLE_BLOCK, 2), 2**31 - 1, dtype=np.int32)
    block[:, 0] = 5
    rows = {"predictor": [0] * 3, "block": [0] * 3, "part": [0] * 3, "fold": [0] * 3, "counts": [block.tobytes()] * 3}
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]
    batch = pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows.values(), kinds)], names=list(rows))
    once = list(_add_blocks(iter([batch])))
    twice = list(_add_blocks(iter(once + once)))
    (out,) = _odds(iter(twice))
    odds = np.frombuffer(out.column("odds")[0].as_py(), dtype=np.float16)[:TABLE_BLOCK]
    assert odds == pytest.approx(np.full(len(odds), np.log((6 * (2**31 - 1) + 0.4) / 30.4)), rel=1e-3)


def test_last_word_and_marker_are_contexts():
    known = ["the", "fox", "ran"]
    code = make_code(Words(*buffers(pa.array([" ".join(known)]))).hashes(), [9, 4, 3], 3, 2)
    made = Decisions(Words(*buffers(pa.array(["the fox ran xy", "ran fox ran xy", "the ran ran xy"]))), code)
    ran = code.symbols[look_up(code.words, Words(*buffers(pa.array(["ran"]))).hashes())[0]]
    after_the_fox, _, after_ran_fox = np.flatnonzero(made.symbol == ran)[:3]
    assert made.context[1, after_the_fox] == made.context[1, after_ran_fox]
    assert made.context[2, after_the_fox] != made.context[2, after_ran_fox]
    unknown = np.flatnonzero(made.symbol == code.escape)
    assert len(set(made.context[0, unknown])) == 1


def test_repeated_escaped_words_follow_the_counts_of_their_text():
    words = [(0, 5), (0, 5), (0, 7), (0, 5), (2, 5), (2, 6), (2, 6)]
    fresh, cost = repeats(np.array([o for o, _ in words]), np.array([h for _, h in words]))
    for at, (owner, h) in enumerate(words):
        earlier = [x for o, x in words[:at] if o == owner]
        different = len(set(earlier))
        again = (len(earlier) - different + REPEATS) / (len(earlier) + ESCAPES) if earlier else 0
        assert fresh[at] == (h not in earlier)
        assert cost[at] == pytest.approx(np.log(1 - again) if fresh[at] else np.log(again / different))


def brute_mix(tables, code, decisions):
    """Each text by itself, block after block, one decision at a time."""
    start = start_weights()
    log = int(tables.shape[1]).bit_length() - 1
    slots = [decisions.slots(k, log) for k in range(3)]
    out = []
    for low, high in zip(decisions.offsets[:-1], decisions.offsets[1:]):
        own, total, push = np.zeros(4), 0.0, np.zeros(4)
        for i, at in enumerate(range(low, high)):
            if i and i % STEP == 0:
                own, push = own + push * ONLINE_RATE / STEP, np.zeros(4)
            odds = np.array([code.odds[decisions.path[at]], *(tables[k][slots[k][at]] for k in range(3))], dtype=np.float32)
            gate = gates(odds[2:3], odds[3:4])[0]
            p = 1 / (1 + np.exp(-np.clip(odds @ (start[gate] + own), -16, 16)))
            total += np.log(p if decisions.outcome[at] else 1 - p)
            push += odds * (decisions.outcome[at] - p)
        out.append(total)
    return out


def test_scores_equal_a_brute_force_mixer(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = fit_model(docs)[0]
    rows = docs.orderBy("doc_id").limit(12).collect()
    made = Decisions(Words(*buffers(pa.array(["", *[r.text or "" for r in rows]], pa.string()))), model.code)
    assert score_batch(made, model) == pytest.approx(brute_mix(model.tables.astype(np.float32), model.code, made), rel=1e-3)


def test_tables_are_counted_whole_and_words_are_a_distribution(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model, words, _, _ = fit_model(docs)
    texts = [r.text for r in docs.where(~held_out(docs.doc_id)).collect()]
    made = Decisions(Words(*buffers(pa.array(texts, pa.string()))), model.code)
    log = int(model.tables.shape[1]).bit_length() - 1
    for k in range(len(model.tables)):
        counts = np.zeros((model.tables.shape[1], 2), dtype=np.int64)
        np.add.at(counts, (made.slots(k, log), made.outcome), 1)
        assert np.allclose(model.tables[k], np.log((counts[:, 1] + 0.4) / (counts[:, 0] + 0.4)), atol=0.01)
    seen = Counter(t for text in texts for t in tokens(text)[:-1])
    rows = words.collect()
    assert {r.word.decode(): r.n for r in rows if r.n} == seen
    coded = {r.word.decode() for r in rows if r.spelled == 0}
    assert coded == {w for w, n in seen.items() if n >= 3}
    assert sum(np.exp(r.spelled) for r in rows if r.spelled < 0) < 1


def test_spelling_is_a_distribution_over_bytes():
    tables = np.random.default_rng(3).normal(size=(5, 1 << 16)).astype(np.float16)
    weights = np.full((16, 5), 0.3)
    nothing = [b"ab" + bytes([c]) for c in range(256) if c != 32]
    longer = [spell_batch(Spelling(Words(*buffers(pa.array([w], pa.binary())), lower=False), spelling_code()), tables, weights)[0] for w in nothing]
    closed = [spell_batch(Spelling(Words(*buffers(pa.array([w], pa.binary())), lower=False), spelling_code()), tables, weights)[0] for w in (b"ab",)]
    assert sum(np.exp(longer)) + np.exp(closed[0]) < 1


def test_all_held_out_rows_together_beat_the_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = [r for r in lm_scores(docs).collect() if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)
