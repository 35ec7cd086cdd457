"""Streams that are drained again and again lose and repeat nothing."""

import random
from collections import Counter
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from scorespark.operators.bands import BinEdges, ScoreBands
from scorespark.operators.monitoring import retraining_rows
from scorespark.operators.preparing import Imputer
from scorespark.operators.scorecard import LinearModel
from scorespark.session import scratch_path
from scorespark.sources import registry
from scorespark.sources.artefacts import Scorer
from scorespark.streaming import runs
from scorespark.streaming.matching import match_outcomes


def _arrive(spark, folder, rows, schema):
    kinds = [f.split() for f in schema.split(", ")]
    plain = ", ".join(f"{n} {'string' if t == 'timestamp' else t}" for n, t in kinds)
    df = spark.createDataFrame(rows, plain).select(*[F.col(n).cast(t).alias(n) for n, t in kinds])
    df.coalesce(1).write.mode("append").parquet(folder)


def test_three_drains_into_one_folder(spark):
    arriving, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    seen = 0
    for size in (10, 15, 15):
        _arrive(spark, arriving, [(k,) for k in range(seen, seen + size)], "id long")
        seen += size
        runs.drain(runs.file_stream(spark, arriving, spark.read.parquet(arriving).schema), out)
        assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(seen))


def test_weekly_psi_over_several_drains(spark):
    arriving, out = scratch_path(spark, "in"), scratch_path(spark, "psi")
    edges = BinEdges({"value": [0.0, 1.0, 2.0]})
    baseline = spark.createDataFrame([(1, 50), (2, 50)], "bin int, n long")
    schema = "ts timestamp, value double"
    weeks = [["2024-01-02", "2024-01-09"], ["2024-01-10", "2024-01-17"], ["2024-01-24"]]
    for k, days in enumerate(weeks):
        _arrive(spark, arriving, [(d, 0.5 + j % 2) for d in days for j in range(20)], schema)
        stream = runs.file_stream(spark, arriving, spark.read.parquet(arriving).schema)
        runs.stream_psi(stream, "value", edges, baseline, out, 0.2)
    found = sorted(r.period for r in spark.read.parquet(out).collect())
    assert found == ["2024-01-01", "2024-01-08", "2024-01-15"]


def test_outcomes_that_arrive_before_and_after_their_scores(spark):
    scores, seen, out = (scratch_path(spark, x) for x in ("s", "o", "joined"))
    left, right = "applicant_id long, scored_at timestamp, pd double", "applicant_id long, observed_at timestamp, bad int"
    # files out of event-time order, one per batch
    parts = [
        ([(1, "2024-01-03", 0.1)], [(2, "2024-01-06", 1)]),
        ([(2, "2024-01-02", 0.2)], [(1, "2024-01-05", 0)]),
        ([(3, "2024-01-04", 0.3)], [(3, "2024-01-05", 1)]),
    ]
    for s, o in parts:
        _arrive(spark, scores, s, left)
        _arrive(spark, seen, o, right)
        streams = [
            spark.readStream.schema(spark.read.parquet(f).schema).option("maxFilesPerTrigger", 1).parquet(f) for f in (scores, seen)
        ]
        runs.drain(runs.outcome_join(*streams, 30, lateness="10 days"), out)
    assert sorted((r.applicant_id, r.bad) for r in spark.read.parquet(out).collect()) == [(1, 0), (2, 1), (3, 1)]


def test_latency_is_measured_from_arrival(spark):
    scored = spark.createDataFrame([(1, 0.1, 600.0, "A", 1)], "id long, pd double, score double, band string, model_version int")
    arrived = F.current_timestamp() - F.expr("INTERVAL 2 SECONDS")
    row = runs.audit_rows(scored, "id", ["pd"], arrived).first()
    assert 1990 < row.latency_ms < 2010


def test_matching_equals_the_batch_join_over_three_drains(spark):
    scores, seen, out = (scratch_path(spark, x) for x in ("s", "o", "matched"))
    left, right = "applicant_id long, scored_at timestamp, n int", "applicant_id long, observed_at timestamp, bad int"
    rng, start = random.Random(6), datetime(2024, 1, 1)
    asked = [[], [], []]
    told = [[], [], []]
    for n in range(240):
        who = 1 if n % 3 == 0 else rng.randint(2, 20)  # one applicant asks again and again
        hour = rng.randint(0, 24 * 90)
        # files come late and out of order, by less than the lateness
        drain = min(2, (hour + rng.randint(0, 24 * 8)) // (24 * 33))
        rows = told if n % 2 else asked
        rows[drain].append((who, str(start + timedelta(hours=hour)), rng.randint(0, 1) if n % 2 else n))
    asked[2].append((99, "2026-01-01", 999))  # moves the watermark beyond all others
    told[2].append((99, "2026-01-01", 0))
    for s, o in zip(asked, told):
        _arrive(spark, scores, s, left)
        _arrive(spark, seen, o, right)
        streams = [runs.file_stream(spark, f, spark.read.parquet(f).schema) for f in (scores, seen)]
        runs.drain(match_outcomes(*streams, 20, lateness="15 days"), out)
    found = Counter(spark.read.schema(f"{left}, observed_at timestamp, bad int").parquet(out).collect())
    requests, outcomes = spark.read.parquet(scores), spark.read.parquet(seen)
    want = retraining_rows(requests.where("n < 999"), outcomes, 20).select("applicant_id", "scored_at", "n", "observed_at", "bad")
    assert found == Counter(want.collect()) and len(found) > 50


def _scorer(weight):
    bands = ScoreBands((0.0, 500.0, 1000.0))
    return Scorer(Imputer({"x": 0.0}, {}), LinearModel({"x": weight}, 0.0), bands)


def test_a_running_query_follows_the_registry(spark):
    arriving, out, root = (scratch_path(spark, x) for x in ("in", "scores", "models"))
    for weight in (1.0, -1.0):
        registry.register_model(_scorer(weight), root, 0.7, 0.3, "h")
    registry.promote(spark, root, 1)
    _arrive(spark, arriving, [(k, 2.0) for k in range(5)], "id long, x double")
    stream = runs.file_stream(spark, arriving, spark.read.parquet(arriving).schema)
    query = runs.follow_registry(stream, root, out, ["id", "pd"], processingTime="0 seconds")
    try:
        query.processAllAvailable()
        registry.promote(spark, root, 2)
        _arrive(spark, arriving, [(k, 2.0) for k in range(5, 9)], "id long, x double")
        query.processAllAvailable()
    finally:
        query.stop()
    rows = spark.read.parquet(out).collect()
    assert sorted((r.id, r.model_version) for r in rows) == [(k, 1 if k < 5 else 2) for k in range(9)]
    assert all((r.pd > 0.5) == (r.model_version == 1) for r in rows)


def test_a_repeated_batch_keeps_its_version(spark):
    from scorespark.sources.commits import create_once

    arriving, out, root = (scratch_path(spark, x) for x in ("in", "scores", "models"))
    for weight in (1.0, -1.0):
        registry.register_model(_scorer(weight), root, 0.7, 0.3, "h")
    registry.promote(spark, root, 2)
    # batch 0 was begun with version 1, then its driver was lost
    assert create_once(spark, f"{runs.state_path(out)}-versions/0", "1")
    _arrive(spark, arriving, [(1, 2.0)], "id long, x double")
    stream = runs.file_stream(spark, arriving, spark.read.parquet(arriving).schema)
    runs.follow_registry(stream, root, out, ["id", "pd"], availableNow=True).awaitTermination()
    assert [(r.id, r.model_version) for r in spark.read.parquet(out).collect()] == [(1, 1)]


def test_champion_and_challenger_on_one_stream(spark):
    arriving, out, root = (scratch_path(spark, x) for x in ("in", "shadow", "models"))
    for weight in (1.0, -1.0):
        registry.register_model(_scorer(weight), root, 0.7, 0.3, "h")
    registry.promote(spark, root, 1)
    _arrive(spark, arriving, [(k, float(k)) for k in range(5)], "id long, x double")
    stream = runs.file_stream(spark, arriving, spark.read.parquet(arriving).schema)
    runs.follow_both(stream, root, 2, out, ["pd", "band"], "id", availableNow=True).awaitTermination()
    rows = spark.read.parquet(out).collect()
    assert sorted(r.id for r in rows) == list(range(5))
    assert all(abs(r.champion_pd + r.challenger_pd - 1) < 1e-12 and r.model_version == 1 for r in rows)


def test_sketches_stay_small_and_within_their_error(spark):
    arriving, out = scratch_path(spark, "in"), scratch_path(spark, "sketches")
    log = spark.range(200_000).select(
        (F.timestamp_seconds(F.lit(1_704_067_200) + F.pmod(F.xxhash64("id"), F.lit(14 * 86_400)))).alias("ts"),
        F.exp(F.randn(7) * 2).alias("value"),
    )
    log.write.parquet(arriving)
    log = spark.read.parquet(arriving)
    runs.drain(runs.window_sketches(runs.file_stream(spark, arriving, log.schema), "value"), out)
    sketches = spark.read.parquet(out)
    shares = (0.05, 0.5, 0.95, 0.99)
    found = {r.period: r for r in runs.sketch_quantiles(sketches, shares).collect()}
    assert len(found) == 1  # the second week is still open
    sizes = [len(r.sketch) for r in sketches.collect()]
    assert max(sizes) < 8_000  # 100,000 distinct values a week
    (period, row), = found.items()
    values = sorted(r.value for r in log.where("date_trunc('week', ts) = timestamp '2024-01-01'").collect())
    assert (row.n, row.min_value, row.max_value) == (len(values), values[0], values[-1])
    for p in shares:
        rank = sum(v <= row[f"p{round(100 * p)}"] for v in values) / len(values)
        assert abs(rank - p) <= 2 * runs.SKETCH_ERROR
    merged = runs.sketch_quantiles(runs.merged_sketches(sketches.unionByName(sketches), F.lit("all"))).first()
    assert merged.n == 2 * row.n and abs(sum(v <= merged.p50 for v in values) / len(values) - 0.5) <= 2 * runs.SKETCH_ERROR


def test_a_shard_of_applicants_takes_few_state_calls():
    from scorespark.streaming.matching import DAY_MICROS, OutcomeMatcher

    calls = []

    class State:
        def __init__(self):
            self.held = None

        def exists(self):
            return self.held is not None

        def get(self):
            calls.append("get")
            return self.held

        def update(self, value):
            calls.append("update")
            self.held = value

        def appendValue(self, value):
            calls.append("append")
            self.held = [*(self.held or []), value]

        put = update

        def clear(self):
            self.held = None

    class Handle:
        def getListState(self, *_):
            return State()

        getValueState = getListState

        def registerTimer(self, at):
            calls.append("timer")

    class Times:
        def __init__(self, ms):
            self.ms = ms

        def getCurrentWatermarkInMs(self):
            return self.ms

    matcher = OutcomeMatcher(10 * DAY_MICROS, 1, ["who", "n", "at", "bad"])
    matcher.init(Handle())
    requests = [{"key": k, "at_micros": k, "later": False, "asked0": -k, "bad": None} for k in range(5000)]
    outcomes = [{"key": k, "at_micros": 2 * DAY_MICROS + k, "later": True, "bad": k % 2} for k in range(0, 5000, 2)]
    list(matcher.handleInputRows((7,), iter(requests + outcomes), Times(0)))
    found = list(matcher.handleExpiredTimer((7,), Times(3 * 86_400_000), None))
    assert sorted(map(tuple, found)) == [(k, -k, 2 * DAY_MICROS + k, 0) for k in range(0, 5000, 2)]
    assert len(list(matcher.handleExpiredTimer((7,), Times(20 * 86_400_000), None))) == 0 and matcher.pieces.held is None
    assert len(calls) < 40
