import numpy as np
import pytest
from pyspark.sql import functions as F

from scorespark.llm.quality import (
    STATISTICS,
    drop_low_quality,
    fit_trees,
    held_out,
    quality_scores,
    statistics,
)
from scorespark.llm.text import buffers

SCHEMA = "doc_id long, text string, source string, score string"


def measured(texts):
    import pyarrow as pa

    return statistics(*buffers(pa.array(texts, pa.string())))


def test_statistics_of_small_texts():
    table = measured(["", None, "aa aa bb\naa!! X9", "é"])
    at = {name: k for k, name in enumerate(STATISTICS)}
    assert (table[:2] == 0).all()
    row = table[2]
    assert row[at["distinct_words"]] == pytest.approx(4 / 5)
    assert row[at["top_word"]] == pytest.approx(2 / 5)
    assert row[at["word_length"]] == pytest.approx(12 / 5)
    assert row[at["digit"]] == pytest.approx(1 / 16)
    assert row[at["distinct_lines"]] == 1
    assert row[at["word_end_symbol"]] == pytest.approx(1 / 5)
    assert table[3, at["beyond"]] == 1
    assert np.isfinite(table).all()


def test_statistics_do_not_depend_on_the_batch():
    texts = ["one two three four", "x", "", "a\n\nb a\n", "zz " * 5000]
    together = measured(texts)
    for k, text in enumerate(texts):
        assert np.allclose(together[k], measured([text])[0], atol=1e-6)


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    rows = rng.random((4000, 5)).astype(np.float32)
    labels = ((rows[:, 0] > 0.5) ^ (rows[:, 3] > 0.5)).astype(float)
    model = fit_trees(rows[:3000], labels[:3000])
    assert ((model.scores(rows[3000:]) > 0.5) == labels[3000:]).mean() > 0.97


def test_trees_without_labels_or_with_one_class():
    assert fit_trees(np.zeros((0, 3), np.float32), np.zeros(0)).scores(np.zeros((2, 3), np.float32)).tolist() == [0.5, 0.5]
    assert fit_trees(np.ones((9, 3), np.float32), np.ones(9)).scores(np.zeros((1, 3), np.float32))[0] > 0.9


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    rows = quality_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = sum((r.score >= 0.5) == (r.quality == 1) for r in rows)
    assert len(rows) > 40 and right / len(rows) > 0.9


def test_edge_rows(spark):
    docs = spark.createDataFrame(
        [(1, "good text here", "s", "x"), (2, None, None, None), (None, "t", "s", "x"), (4, "", "s", "x"), (4, "w " * 90000, "s", "x")],
        SCHEMA,
    )
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 1), (4, 0)], "doc_id long, quality int")
    out = quality_scores(docs, labels)
    rows = out.collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)
    assert quality_scores(docs.limit(0), labels.limit(0)).count() == 0
    kept = drop_low_quality(docs, labels.limit(0))
    assert kept.columns == docs.columns and kept.count() == 5


def test_held_out_rule(spark):
    import zlib

    rows = spark.range(50).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)
