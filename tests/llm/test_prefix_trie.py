import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from scorespark.llm import prefix_trie
from scorespark.llm.prefix_trie import SpillingQueue, shared_trie

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[conv].append((turn is not None, turn or 0, digest, role, text))
    turns = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        rebuilt[c] = turns.get(base, [])[:h] + turns[c][h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
        ends[tuple(seq)].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = leaves[node] or 1
        saved[node] += (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
        if node:
            up = node[:-1]
            children[up] += 1
            leaves[up] += leaves[node]
            saved[up] += saved[node]
    return {
        (
            min(m), len(n), min(members[n[:-1]]) if n else None, len(m), children[n], leaves[n], saved[n],
            hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest(),
        )
        for n, m in members.items()
    }


def trie_of(spark, rows, **kwargs):
    got = [tuple(r) for r in shared_trie(spark.createDataFrame(rows, SCHEMA), **kwargs).select(*NAMES).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_equals_brute_force_on_conversations(spark, folder):
    table = spark.read.parquet(f"{folder}/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table.collect()]
    assert {tuple(r) for r in shared_trie(table).select(*NAMES).collect()} == brute(rows)


@pytest.mark.parametrize("tier, levels, limit", [(2, 2, 3), (64, 256, 200_000)])
def test_pieces_rounds_and_spills(spark, tier, levels, limit, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PART_BYTES", 100)
    rng = random.Random(1)
    rows = []
    for c in range(-7, 90):
        hot = c % 3 == 0  # a third of all conversations are alike
        for t in range(4 if hot else rng.randint(0, 9)):
            rows.append((c, t, "user", "hot" if hot or t < 2 else rng.choice("abc")))
    rows += [(1000, t, "a", f"turn {t}") for t in range(60)]  # one very long one
    assert trie_of(spark, rows, tier=tier, levels=levels, limit=limit) == brute(rows)


def test_edge_rows(spark):
    rows = [
        (1, None, "user", "first"), (1, 0, None, None), (1, 0, None, None), (1, 1, "", "tie"), (1, 1, "é", "tie"), (2, 5, "user", None),
        (None, 0, "user", "no conversation"), (7, -3, "user", "x" * 200_000), (7, 2, "user", "é" * 10), (-1, 0, "user", "minus"), (10, 3, "user", ""),
    ]
    assert trie_of(spark, rows) == brute(rows)
    wide = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as depth", "2 as key", "3 as place", "4 as digest", "5 as bytes")
    assert {tuple(r) for r in shared_trie(wide).select(*NAMES).collect()} == brute(rows)
    assert trie_of(spark, rows[6:7]) == set()


def test_queue_spills_in_order(tmp_path):
    rng = random.Random(2)
    queue = SpillingQueue(5, str(tmp_path))
    sent = [(rng.randint(0, 9), bytes([rng.randint(0, 3)]), k) for k in range(300)]
    for message in sent:
        queue.push(message)
    assert queue.files > 10 and len(queue.heap) <= 5
    addresses = sorted({m[:2] for m in sent})
    assert [sorted(queue.take(a)) for a in addresses] == [sorted(m for m in sent if m[:2] == a) for a in addresses]
    assert not list(tmp_path.iterdir())
