"""Streaming twins of scoring and monitoring: file streams, windows, joins, sinks.

Each function takes a streaming DataFrame and returns one (or a running query);
:func:`drain` processes what is available and stops, which is how a scheduled
job - and the tests - run them. Checkpoints and outputs live on shared storage.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from scorespark.functions.intervals import right_closed_bin
from scorespark.operators.bands import BinEdges, ScoreBands
from scorespark.operators.monitoring import psi_from_period_counts
from scorespark.operators.preparing import Imputer
from scorespark.operators.quantiles import counted_quantiles
from scorespark.operators.scorecard import score_population
from scorespark.sources.commits import create_once, read_once
from scorespark.sources.registry import load_version, promoted_version

WEEK = "7 days"
MONDAY = "4 days"  # windows count from a Thursday, 1970-01-01


def file_stream(
    spark: SparkSession, folder: str, schema: T.StructType, pattern: str | None = None
) -> DataFrame:
    """New parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(folder)


def state_path(path: str) -> str:
    """Where the progress and state of the stream into ``path`` are kept."""
    return path.rstrip("/") + "-state"


def drain(stream: DataFrame, path: str, mode: str = "append") -> None:
    """Process everything available into parquet files under ``path``, exactly once.

    The state of the stream is kept beside the output, so the next call into the
    same folder goes on where this one stopped.
    """
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", state_path(path))
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def drain_batches(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], path: str, mode: str = "append"
) -> None:
    """Process everything available through ``handle(batch, batch_id)``, which writes to ``path``.

    Batch numbers go on from call to call, so what a batch wrote is its own.
    """
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", state_path(path))
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def score_stream(
    applicants: DataFrame, imputer: Imputer, pd: Column, bands: ScoreBands, model_version: int
) -> DataFrame:
    """Score arriving applicants; only row-wise expressions, so there is no state."""
    scored = bands.apply(score_population(imputer.apply(applicants), pd))
    return scored.withColumn("model_version", F.lit(model_version))


def follow_registry(
    applicants: DataFrame, root: str, path: str, columns: Sequence[str], query_name: str | None = None, **trigger
) -> StreamingQuery:
    """Score arriving applicants with the model that is promoted when their micro-batch starts.

    A batch's version is fixed by a record made once before anything is scored, so a
    batch that is tried again is scored by the same version, and its folder is
    written anew: every row bears the version that scored it, and none is there twice.
    Promoting a version takes effect from the next batch on, without a restart.
    Returns the running query; ``trigger`` goes to ``trigger()``.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        record = f"{state_path(path)}-versions/{batch_id}"
        create_once(spark, record, str(promoted_version(spark, root)))
        version = int(read_once(spark, record))
        rows = load_version(spark, root, version).apply(batch).withColumn("model_version", F.lit(version))
        rows.select(*columns, "model_version").write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = applicants.writeStream.foreachBatch(handle).option("checkpointLocation", state_path(path))
    if query_name:
        writer = writer.queryName(query_name)
    return (writer.trigger(**trigger) if trigger else writer).start()


def follow_both(
    applicants: DataFrame, root: str, challenger: int, path: str, columns: Sequence[str], key: str, **trigger
) -> StreamingQuery:
    """Shadow scoring: the promoted model and ``challenger`` answer the same micro-batch side by side.

    Rows have the key, ``columns`` of either model as ``champion_...`` and ``challenger_...``, and the champion's
    version, fixed as in :func:`follow_registry`.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        record = f"{state_path(path)}-versions/{batch_id}"
        create_once(spark, record, str(promoted_version(spark, root)))
        version = int(read_once(spark, record))
        inputs = batch.columns
        rows = batch
        for side, number in (("champion", version), ("challenger", challenger)):
            found = load_version(spark, root, number).apply(rows.select(F.struct(*rows.columns).alias("_row"), *inputs))
            kept = [F.col("_row").getField(c).alias(c) for c in rows.columns]
            rows = found.select(*kept, *[F.col(c).alias(f"{side}_{c}") for c in columns])
        answers = [f"{side}_{c}" for side in ("champion", "challenger") for c in columns]
        out = rows.select(key, *answers).withColumn("model_version", F.lit(version))
        out.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = applicants.writeStream.foreachBatch(handle).option("checkpointLocation", state_path(path))
    return (writer.trigger(**trigger) if trigger else writer).start()


def audit_rows(scored: DataFrame, key: str, inputs: list[str], received_at: Column | None = None) -> DataFrame:
    """Audit-log rows: time, request and response as JSON, model version, latency.

    ``received_at`` is the arrival time of a request; latency is the time from
    then until the row is processed.
    """
    now = F.current_timestamp()
    arrived = now if received_at is None else received_at
    latency = (F.unix_micros(now) - F.unix_micros(arrived)) / 1000.0
    return scored.select(
        now.alias("ts"),
        F.to_json(F.struct(key, *inputs)).alias("request"),
        F.to_json(F.struct(F.col("pd").alias("probability_of_default"), "score", "band")).alias("response"),
        "model_version",
        latency.alias("latency_ms"),
    )


def window_value_counts(
    requests: DataFrame, value: str, ts: str = "ts", days: int = 7, lateness: str = "1 day"
) -> DataFrame:
    """Rows per calendar window (weeks from Monday, or days) and value; closed windows only in append mode.

    The state is one counter per open window and distinct value, so exact
    quantiles of a closed window can be read from its counts.
    """
    start = MONDAY if days == 7 else "0 days"
    return (
        requests.withWatermark(ts, lateness)
        .where(F.col(value).isNotNull())
        .groupBy(F.window(ts, f"{days} days", startTime=start).alias("w"), F.col(value).alias("value"))
        .agg(F.count("*").alias("n"))
        .select(_week().alias("period"), "value", "n")
    )


#: Size of a quantile sketch; its rank error is at most 1.65 % of the rows with 99 % confidence.
SKETCH_K = 200
SKETCH_ERROR = 0.0165


def window_sketches(
    requests: DataFrame, value: str, ts: str = "ts", days: int = 7, lateness: str = "1 day", k: int = SKETCH_K
) -> DataFrame:
    """Volume, mean, range and a mergeable quantile sketch per calendar window; closed windows only in append mode.

    The state is one sketch of a few kilobytes per open window, however many rows or distinct
    values there are. Its quantiles have a rank error (:data:`SKETCH_ERROR`);
    :func:`window_value_counts` is the exact twin for values with few distinct levels.
    """
    start = MONDAY if days == 7 else "0 days"
    number = F.col(value).cast("double")
    return (
        requests.withWatermark(ts, lateness)
        .where(number.isNotNull() & ~F.isnan(number))
        .groupBy(F.window(ts, f"{days} days", startTime=start).alias("w"))
        .agg(
            F.count("*").alias("n"),
            F.avg(number).alias("avg_value"),
            F.min(number).alias("min_value"),
            F.max(number).alias("max_value"),
            F.kll_sketch_agg_double(number, F.lit(k)).alias("sketch"),
        )
        .select(_week().alias("period"), "n", "avg_value", "min_value", "max_value", "sketch")
    )


def sketch_quantiles(sketches: DataFrame, probabilities: Sequence[float] = (0.5, 0.95, 0.99)) -> DataFrame:
    """``sketches`` with p50, p95 ... in place of the sketch."""
    wanted = {f"p{round(100 * p)}": F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))) for p in probabilities}
    return sketches.withColumns(wanted).drop("sketch")


def merged_sketches(sketches: DataFrame, period: Column) -> DataFrame:
    """Windows put together to longer periods: volumes add up, sketches merge."""
    return sketches.groupBy(period.alias("period")).agg(
        F.sum("n").alias("n"),
        (F.sum(F.col("avg_value") * F.col("n")) / F.sum("n")).alias("avg_value"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
        F.kll_merge_agg_double("sketch").alias("sketch"),
    )


def window_summary(counts: DataFrame, probabilities: Sequence[float] = (0.5, 0.95, 0.99)) -> DataFrame:
    """Volume, mean, range and exact percentiles per period of ``counts(period, value, n)``."""
    totals = counts.groupBy("period").agg(
        F.sum("n").alias("n"),
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("avg_value"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
    )
    return totals.join(counted_quantiles(counts, ["period"], "value", "n", probabilities), "period")


def last_histogram(counts: DataFrame, edges: Sequence[float]) -> DataFrame:
    """Counts of the last closed period per bin of ``edges``: ``(period, bin, n)``."""
    last = counts.agg(F.max("period").alias("period"))
    return (
        counts.join(last, "period")
        .groupBy("period", right_closed_bin("value", list(edges)).alias("bin"))
        .agg(F.sum("n").alias("n"))
    )


def weekly_bin_counts(
    requests: DataFrame, column: str, edges: BinEdges, ts: str = "ts", lateness: str = "1 day"
) -> DataFrame:
    """Rows per week and baseline bin; the state is one counter per open week and bin."""
    return (
        requests.withWatermark(ts, lateness)
        .where(F.col(column).isNotNull())
        .groupBy(
            F.window(ts, WEEK, startTime=MONDAY).alias("w"),
            right_closed_bin(column, edges.edges[column]).alias("bin"),
        )
        .agg(F.count("*").alias("n"))
        .select(_week().alias("period"), "bin", "n")
    )


def _week() -> Column:
    return F.date_format(F.col("w.start"), "yyyy-MM-dd")


def stream_psi(
    requests: DataFrame, column: str, edges: BinEdges, baseline: DataFrame, path: str, alert_above: float
) -> None:
    """PSI of every closed week against ``baseline(bin, n)``, appended with an alert flag.

    All bins of a week close in the same micro-batch, so a batch holds whole weeks.
    The output folder is named by batch: a repeated batch replaces its own files.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        psi = psi_from_period_counts(batch, edges, column, baseline)
        flagged = psi.withColumn("alert", F.col("psi") > alert_above)
        flagged.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    drain_batches(weekly_bin_counts(requests, column, edges), handle, path)


def outcome_join(
    scored: DataFrame, outcomes: DataFrame, window_days: int, lateness: str = "1 day", key: str = "applicant_id"
) -> DataFrame:
    """Scores with the outcome that arrives within ``window_days`` after them.

    Both sides hold one row per applicant. The time condition together with both
    watermarks lets Spark drop a score from the state once its window has passed.
    """
    left = scored.withWatermark("scored_at", lateness).alias("s")
    right = outcomes.withWatermark("observed_at", lateness).alias("o")
    inside = F.expr(
        f"s.{key} = o.{key} AND o.observed_at >= s.scored_at "
        f"AND o.observed_at < s.scored_at + INTERVAL {window_days} DAYS"
    )
    return left.join(right, inside, "inner").select(f"s.{key}", "scored_at", "observed_at", "pd", "bad")
