"""Requests and their outcomes matched on streams, with state and timers of its own.

Applicants are dealt by a hash of their key to shards, and the state is kept per shard: the
requests that are still open and the outcomes that may still be needed, some thousand to a
stored value. So what a batch costs follows from its rows, not from calls per applicant.
A request is decided when the watermark has passed its next outcome (no earlier one can
arrive) or the end of its performance window; then it and all outcomes before the watermark
leave the state. An applicant with many requests and outcomes has each request answered
once, by the first outcome in its window, in whatever order the files arrive; rows are
never multiplied.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from itertools import islice
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY_MICROS = 86_400_000_000
#: Shards of the applicants; their number is part of a stream's stored state.
SHARDS = 1 << 14
#: Rows of a stored value at most.
PIECE = 10_000
_NAN = float("nan")


class OutcomeMatcher(StatefulProcessor):
    """Decides the requests of a shard of applicants as the watermark advances.

    A stored row is ``(key, time, request columns)`` of a request or ``(key, time, None, label)`` of an outcome.
    """

    def __init__(self, window_micros: int, asked: int, names: list[str]):
        self.window, self.asked, self.names = window_micros, asked, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pieces = handle.getListState("pieces", T.StructType([T.StructField("rows", T.BinaryType())]))
        long = T.StructType([T.StructField("at", T.LongType())])
        self.wakes = handle.getValueState("wakes", long)
        self.decided = handle.getValueState("decided", long)

    def _wake(self, micros: int, watermark_ms: int) -> None:
        """A timer for when the watermark is beyond a moment, if it is the next one."""
        at = max(micros // 1000, watermark_ms) + 1
        known = self.wakes.get() if self.wakes.exists() else None
        if known is None or not watermark_ms < known[0] <= at:
            self.handle.registerTimer(at)
            self.wakes.update((at,))

    def _rows(self, rows: Iterable[Row], edge: int) -> Iterator[tuple]:
        columns = [f"asked{k}" for k in range(self.asked)]
        for row in rows:
            if row["at_micros"] < edge:
                continue  # late: what it could change has been decided
            if row["later"]:
                yield row["key"], row["at_micros"], None, row["bad"]
            else:
                yield row["key"], row["at_micros"], tuple(row[c] for c in columns)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        arrived, first = self._rows(rows, now * 1000), None
        while some := list(islice(arrived, PIECE)):
            self.pieces.appendValue((pickle.dumps(some),))
            wake = min(row[1] + (self.window if row[2] is not None else 0) for row in some)
            first = wake if first is None else min(first, wake)
        if first is not None:
            self._wake(first, now)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        last = self.decided.get() if self.decided.exists() else None
        if last is not None and last[0] == now:
            return  # another timer of this batch has done it
        self.decided.update((now,))
        by_key: dict[Any, tuple[list, dict]] = {}
        for (piece,) in self.pieces.get():
            for row in pickle.loads(piece):
                requests, worst = by_key.setdefault(row[0] if row[0] == row[0] else _NAN, ([], {}))
                if row[2] is not None:
                    requests.append(row)
                else:
                    worst[row[1]] = max(row[3], worst.get(row[1], row[3]))
        made, kept = Row(*self.names), []
        for whose, (requests, worst) in by_key.items():
            for request, outcome in self._decide(whose, requests, worst, now * 1000, kept):
                yield made(whose, *request[2], *outcome)
        if not kept:
            for state in (self.pieces, self.wakes, self.decided):
                state.clear()
            return
        self.pieces.put([(pickle.dumps(kept[k : k + PIECE]),) for k in range(0, len(kept), PIECE)])
        self._wake(min(row[1] + (self.window if row[2] is not None else 0) for row in kept), now)

    def _decide(self, key: Any, requests: list, worst: dict[int, int], edge: int, kept: list) -> Iterator[tuple]:
        """An applicant's answered requests with their outcomes; what is still needed goes to ``kept``."""
        outcomes, nth = sorted(worst.items()), 0
        for request in sorted(requests, key=lambda r: r[1]):
            while nth < len(outcomes) and outcomes[nth][0] < request[1]:
                nth += 1
            following = outcomes[nth] if nth < len(outcomes) else None
            end = request[1] + self.window
            if following is not None and following[0] < min(edge, end):
                yield request, following
            elif end > edge:
                kept.append(request)
        kept += [(key, at, None, bad) for at, bad in outcomes if at >= edge]

    def close(self) -> None:
        pass


def match_outcomes(
    scored: DataFrame, outcomes: DataFrame, window_days: int, lateness: str = "1 day", key: str = "applicant_id"
) -> DataFrame:
    """The streaming twin of :func:`scorespark.operators.monitoring.retraining_rows`.

    ``scored`` has the key, ``scored_at`` and any other columns, ``outcomes`` the key, ``observed_at`` and
    ``bad``; neither needs to be unique. A request comes out once the watermark has passed
    its outcome, rows later than the watermark are not looked at, and requests without key
    or time never have an outcome. Of outcomes at the same time the larger label counts.
    """
    spark = scored.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    shard = F.pmod(F.xxhash64("key"), F.lit(SHARDS))
    kept = [c for c in scored.columns if c != key]
    asked = scored.where(F.col(key).isNotNull() & F.col("scored_at").isNotNull()).select(
        F.col(key).alias("key"),
        F.col("scored_at").cast("timestamp").alias("at"),
        F.lit(False).alias("later"),
        *[F.col(c).alias(f"asked{k}") for k, c in enumerate(kept)],
        F.lit(None).cast("int").alias("bad"),
    )
    kinds = [scored.schema[c].dataType for c in kept]
    seen = outcomes.where(F.col(key).isNotNull() & F.col("observed_at").isNotNull() & F.col("bad").isNotNull()).select(
        F.col(key).alias("key"),
        F.col("observed_at").cast("timestamp").alias("at"),
        F.lit(True).alias("later"),
        *[F.lit(None).cast(kind).alias(f"asked{k}") for k, kind in enumerate(kinds)],
        F.col("bad").cast("int").alias("bad"),
    )
    line = asked.unionByName(seen).withWatermark("at", lateness).withColumns({"at_micros": F.unix_micros("at"), "shard": shard})
    nullable = [T.StructField(c, kind) for c, kind in zip(kept, kinds)]
    found = T.StructType(
        [T.StructField(key, asked.schema["key"].dataType), *nullable, T.StructField("_observed", T.LongType()), T.StructField("bad", T.IntegerType())]
    )
    matcher = OutcomeMatcher(window_days * DAY_MICROS, len(kept), found.names)
    matched = line.groupBy("shard").transformWithState(
        statefulProcessor=matcher, outputStructType=found, outputMode="Append", timeMode="EventTime"
    )
    return matched.select(key, *kept, F.timestamp_micros("_observed").alias("observed_at"), "bad")
