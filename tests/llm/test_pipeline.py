import os
import re
import shutil
import subprocess
import sys

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from test_near_dedup import brute as brute_near

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="module")
def stages(spark, folder, tmp_path_factory):
    """What each stage got and gave on the smallest tables, with a few planted rows."""
    base = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    some = docs.where("doc_id < 40")
    extra = some.select((F.col("doc_id") + 10_000).alias("doc_id"), F.concat(F.lit(" \n"), "text").alias("text"), *docs.columns[2:])
    near = some.select((F.col("doc_id") + 20_000).alias("doc_id"), F.concat("text", F.lit(" tail")).alias("text"), *docs.columns[2:])
    docs = docs.unionByName(extra.select(*docs.columns)).unionByName(near.select(*docs.columns))
    out = []
    for k, (name, step) in enumerate(corpus_pipeline.STAGES):
        got = step(spark, docs, folder)
        got.write.parquet(f"{base}/{k}")
        after = spark.read.parquet(f"{base}/{k}")
        out.append((name, docs, after))
        docs = after
    return {name: (before, after) for name, before, after in out}


def _rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_order_and_columns(stages, folder, spark):
    assert list(stages) == ["quality", "exact_dedup", "near_dedup", "decontaminate", "mixing"]
    columns = spark.read.parquet(f"{folder}/documents.parquet").columns
    for name, (_, after) in stages.items():
        if name != "mixing":
            assert after.columns == columns
    for before, after in stages.values():
        assert after.join(before, "doc_id", "left_anti").count() == 0 < after.count() < 1000


def test_quality_keeps_most_and_rejects_what_is_scored_low(spark, stages, folder):
    before, after = stages["quality"]
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    kept = {r.doc_id for r in after.collect()}
    good = [r.doc_id for r in labels.where("quality = 1").join(before, "doc_id").collect()]
    assert sum(i in kept for i in good) >= 0.95 * len(good)
    assert len(kept) < before.count()


def test_exact_stage_equals_brute_force(stages):
    before, after = (_rows(x) for x in stages["exact_dedup"])
    best = {}
    for i, t in before:
        key = re.sub(r"[\x20\x09-\x0D]", "", t)
        best[key] = min(best.get(key, (1, 0)), (-len(t), i))
    assert sorted(i for i, _ in after) == sorted(i for _, i in best.values())


def test_near_stage_equals_brute_force(stages):
    before, after = (_rows(x) for x in stages["near_dedup"])
    roots, _ = brute_near(before, 5, 80)
    assert sorted(i for i, _ in after) == sorted(set(roots.values())) and len(after) < len(before)


def test_benchmark_stage_drops_holders_only(spark, stages, folder):
    before, after = stages["decontaminate"]
    words = lambda t: " ".join(re.findall(r"[^\W_]+", t.lower()))
    items = [words(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    kept = {i for i, _ in _rows(after)}
    for i, t in _rows(before):
        assert (i not in kept) == any(item in words(t) for item in items)


def test_mixing_stage(stages):
    _, after = stages["mixing"]
    took = after.groupBy("source").agg(F.sum("taken").alias("n"), F.first("target").alias("t")).collect()
    assert all(abs(r.n - r.t) <= 0.5 for r in took)
    assert after.where("taken <= 0 or taken > 3 * size").count() == 0


def test_whole_run(spark, folder):
    assert corpus_pipeline.run(spark, folder).count() > 20
    assert corpus_pipeline.ORACLE_SQL is None


def test_edge_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for k, rows in enumerate([[], [(1, None, None, None, None), (1, None, None, None, None), (None, "x y", "en", None, 3), (2, "a b", None, "s", 3)]]):
        docs = spark.createDataFrame(rows, schema)
        for name, step in corpus_pipeline.STAGES:
            got = step(spark, docs, str(tmp_path))
            got.write.parquet(str(tmp_path / f"{k}-{name}"))
            docs = spark.read.parquet(str(tmp_path / f"{k}-{name}"))
        assert docs.count() == (2 if k else 0)


def test_queries_are_registered_and_the_rest_works_without_this_folder(tmp_path):
    import __spark_entry__ as entry

    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and not any(k.startswith('op') for k in q); print(len(q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": str(copy)})
    assert done.returncode == 0, done.stderr
