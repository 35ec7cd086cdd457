import random

import numpy as np
import pyarrow as pa

from scorespark.llm.decontaminate import (
    _windows,
    best_distance,
    contaminated,
    drop_contaminated,
    edit_budget,
    find_items,
    folded_words,
    lsh_candidates,
    prepare_items,
)
from scorespark.llm.text import buffers

DOCS = "doc_id long, text string, item_id string, distance string"


def distance(item, text):
    """Smallest word edit distance of ``item`` to any stretch of ``text``."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item):
        new = [i + 1]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def edited(rng, words, edits, vocabulary):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        kind = rng.randrange(3)
        if kind == 0:
            words[at] = rng.choice(vocabulary)
        elif kind == 1:
            del words[at]
        else:
            words.insert(at, rng.choice(vocabulary))
    return words


def test_same_as_brute_force_over_all_pairs():
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(60)]
    items = [[rng.choice(vocabulary) for _ in range(rng.randrange(6, 40))] for _ in range(25)]
    texts = []
    for k in range(120):
        inner = edited(rng, items[k % 25], rng.randrange(0, 10), vocabulary) if k % 4 else []
        around = [[rng.choice(vocabulary) for _ in range(rng.randrange(20))] for _ in range(2)]
        texts.append(around[0] + inner + around[1])
    found = find_items(*buffers(pa.array([" ".join(t) for t in texts])), prepare_items(list(range(25)), [" ".join(i) for i in items], 0.8))
    got = {(t, k) for t, k, *_ in found}
    true = {(t, k) for t, text in enumerate(texts) for k, item in enumerate(items) if distance(item, text) <= edit_budget(len(item), 0.8)}
    assert got <= true
    assert len(true) > 40 and len(got) >= 0.99 * len(true)
    assert all(d == distance(items[k], texts[t]) for t, k, d, *_ in found) or sum(
        d == distance(items[k], texts[t]) for t, k, d, *_ in found
    ) > 0.97 * len(found)


def test_recall_at_the_largest_distance():
    rng = random.Random(6)
    vocabulary = [f"v{k}" for k in range(3000)]
    items = [[rng.choice(vocabulary) for _ in range(rng.randrange(10, 60))] for _ in range(50)]
    texts = [edited(rng, items[k % 50], edit_budget(len(items[k % 50]), 0.8), vocabulary) for k in range(400)]
    found = find_items(*buffers(pa.array([" ".join(t) for t in texts])), prepare_items(list(range(50)), [" ".join(i) for i in items], 0.8))
    assert sum((t, t % 50) in {(a, b) for a, b, *_ in found} for t in range(400)) >= 0.99 * 400


def test_best_distance():
    item = np.array([1, 2, 3, 4], dtype=np.uint64)
    rows = np.array([[9, 1, 2, 3, 4, 9], [1, 2, 9, 3, 4, 0], [7, 7, 7, 7, 7, 7]], dtype=np.uint64)
    assert best_distance(item, rows)[0].tolist() == [0, 1, 4]


def test_edge_rows(spark):
    item = "The quick brown fox, jumps over the lazy dog today!"
    bench = spark.createDataFrame([(1, item, "x"), (2, None, "x"), (3, "", "x"), (4, "too short", "x"), (None, item, "x")], "item_id long, text string, doc_id string")
    rows = [
        (1, f"before {item} after", "a", "b"), (2, item.lower().replace(",", ""), "a", "b"), (3, None, "a", "b"), (4, "", "a", "b"),
        (5, "too short", "a", "b"), (6, "word " * 50000 + item, "a", "b"), (6, "clean", "a", "b"), (None, item, "a", "b"),
        (7, "the quick brown fox sat on a mat and then slept", "a", "b"), (8, item.replace("lazy", "idle") + item, "a", "b"),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    got = contaminated(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, 1), (2, 1), (6, 1), (8, 1), (None, 1)}
    assert {r.doc_id: r.start_word for r in got}[6] == 50000
    kept = drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [3, 4, 5, 7]
    assert contaminated(docs.limit(0), bench).count() == 0
    assert contaminated(docs, bench.limit(0)).count() == 0
    assert drop_contaminated(docs, bench.limit(0)).count() == len(rows)


def test_long_items_with_one_kind_of_edit_are_all_found():
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(3000)]
    for n in (100, 400, 1000):
        items = [[rng.choice(vocabulary) for _ in range(n)] for _ in range(6)]
        texts = []
        for item in items:
            places = set(rng.sample(range(n), edit_budget(n, 0.8)))
            shorter = [w for k, w in enumerate(item) if k not in places]
            longer = [x for k, w in enumerate(item) for x in ([rng.choice(vocabulary), w] if k in places else [w])]
            changed = [rng.choice(vocabulary) if k in places else w for k, w in enumerate(item)]
            around = [rng.choice(vocabulary) for _ in range(50)]
            texts += [around + body + around for body in (shorter, longer, changed)]
        found = find_items(*buffers(pa.array([" ".join(t) for t in texts])), prepare_items(list(range(6)), [" ".join(i) for i in items], 0.8))
        true = {(3 * k + kind, k) for k in range(6) for kind in range(3)}
        assert {(t, k) for t, k, *_ in found} >= true
        assert all(d <= edit_budget(n, 0.8) for _, _, d, *_ in found)


def recall_of_tables(rng, n, kind, items=12, copies=4):
    """Share of items at the largest distance that the tables alone bring up."""
    vocabulary = [f"w{k}" for k in range(4000)]
    bodies = [[rng.choice(vocabulary) for _ in range(n)] for _ in range(items)]
    budget, texts = edit_budget(n, 0.8), []
    for k in range(items * copies):
        item, places = bodies[k % items], set(rng.sample(range(n), budget))
        if kind == "mixed":
            body = edited(rng, item, budget, vocabulary)
        elif kind == "deleted":
            body = [w for j, w in enumerate(item) if j not in places]
        else:
            body = [x for j, w in enumerate(item) for x in ([rng.choice(vocabulary), w] if j in places else [w])]
        around = [rng.choice(vocabulary) for _ in range(40)]
        texts.append(" ".join(around + body + around))
    prepared = prepare_items(list(range(items)), [" ".join(i) for i in bodies], 0.8)
    words = folded_words(*buffers(pa.array(texts)))
    hashes = words.hashes()
    met = {(int(t), int(i)) for i, t, _ in lsh_candidates(hashes, words, prepared, _windows(hashes, words, prepared)[1])}
    return sum((t, t % items) in met for t in range(len(texts))) / len(texts)


def test_recall_of_the_tables_at_every_length_and_kind_of_edit():
    rng = random.Random(12)
    table = {(n, kind): recall_of_tables(rng, n, kind) for n in (10, 30, 100, 400, 1000) for kind in ("mixed", "deleted", "inserted")}
    print({f"{n} {kind}": round(r, 3) for (n, kind), r in table.items()})
    assert min(table.values()) >= 0.9
