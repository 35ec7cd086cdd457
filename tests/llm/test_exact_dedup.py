import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from scorespark.llm.exact_dedup import drop_exact_copies, exact_groups, grace

SCHEMA = "doc_id long, text string, source string, kept boolean, _id string"


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((doc_id, text or ""))
    out = []
    for content, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0]))[0]
        for doc_id, _ in members:
            out.append((doc_id, keep, len(members), hashlib.sha256(content.encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = [
    (5, "a b"), (3, "ab"), (9, "a\tb"), (7, "a  b\n"), (1, ""), (2, None), (4, " \n"), (None, "zz"), (8, "zz"),
    (10, "é x"), (11, "éx"), (12, "long " * 60000), (13, "long" * 60000), (14, "A b"), (15, "b a"),
]


@pytest.mark.parametrize("memory", [1, 300, 1 << 20])
def test_groups_equal_brute_force(spark, memory):
    docs = spark.createDataFrame([(i, t, "s", True, "x") for i, t in ROWS], SCHEMA).repartition(3)
    got = exact_groups(docs, memory).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == brute(ROWS)
    assert {r.doc_id for r in got if r.kept} == {7, 4, 8, 10, 11, 12, 14, 15}


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "x", "s", True, "k"), (1, "x", "s", True, "k"), (1, "y", "s", True, "k")], SCHEMA)
    got = exact_groups(docs).collect()
    assert sorted((r.group_size, r.kept) for r in got) == [(1, True), (2, False), (2, True)]
    kept = drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.text for r in kept.collect()) == ["x", "y"]
    assert exact_groups(docs.limit(0)).count() == 0
    assert drop_exact_copies(docs.limit(0)).count() == 0


def test_drop_keeps_one_of_each_text(spark):
    docs = spark.createDataFrame([(i, t, "s", True, "x") for i, t in ROWS], SCHEMA)
    kept = sorted(r.doc_id for r in drop_exact_copies(docs).where("doc_id is not null").collect())
    assert kept == [4, 7, 8, 10, 11, 12, 14, 15]


def test_grace_spills_without_losing_records():
    rng = random.Random(1)
    records = []
    for k in range(2000):
        content = str(rng.randrange(500)).encode() * 20
        records.append((hashlib.sha256(content).digest(), content, (-1, k, k), 1, (k,)))
    out = list(grace(records, 3000))
    assert len(out) == len({r[1] for r in records})
    assert sorted(k for r in out for k in r[4]) == list(range(2000))
    assert sum(r[3] for r in out) == 2000
    same = [(records[0][0], records[0][1], (-1, k, k), 1, (k,)) for k in range(3000)]
    assert [r[2:4] for r in grace(same, 1000)] == [((-1, 0, 0), 3000)]


def test_equal_hash_does_not_join_texts():
    sha = b"\0" * 32
    out = list(grace([(sha, b"a" * 400, (0, 1, 1), 1, (1,)), (sha, b"b" * 400, (0, 2, 2), 1, (2,))], 100))
    assert len(out) == 2


def test_hash_column(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    sha = F.sha2(F.regexp_replace("text", r"[\x20\x09-\x0D]", "").cast("binary"), 256)
    wrong = docs.withColumn("s", sha).join(exact_groups(docs), "doc_id").where("s <> text_sha256")
    assert wrong.count() == 0
