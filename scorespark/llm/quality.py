"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are computed from whole texts in Arrow batches; the trees are fitted
by histograms on a bounded sample of labelled rows and flattened into one set of
arrays, through which a batch of rows walks level by level in numpy.

Null and empty texts have all statistics 0 and are scored like any other row.
Rows of ``labels`` without doc_id or label are left out of the fit; a document
with several labels is fitted once per label. With no labelled row, or only one
class, every score is that class's smoothed rate. Other columns, whatever their
names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorespark.llm.text import (
    Words,
    bounded_batches,
    buffers,
    distinct_per_text,
    documents_view,
    shingles,
    slices,
)
from scorespark.session import stage

#: Labelled rows the fit takes at most, those with the smallest hash of doc_id.
TRAIN_ROWS = 20_000
TREES, DEPTH, BINS, RATE = 120, 5, 64, 0.1
THRESHOLD = 0.3

_CLASSES = {
    "space": b" \t",
    "line": b"\n\r\x0b\x0c",
    "digit": b"0123456789",
    "upper": bytes(range(65, 91)),
    "lower": bytes(range(97, 123)),
    "stop": b".,;:",
    "bang": b"!?",
    "bar": b"|",
    "symbol": b"#$%&*+<=>^_~\\/@`{}[]",
    "quote": b"'\"()-",
    "beyond": bytes(range(128, 256)),
    "control": bytes(range(9)) + bytes(range(14, 32)) + b"\x7f",
}
STATISTICS = (
    *_CLASSES,
    "log_bytes",
    "log_words",
    "word_length",
    "long_words",
    "short_words",
    "distinct_words",
    "distinct_runs",
    "top_word",
    "line_length",
    "distinct_lines",
    "entropy",
    "byte_kinds",
    "word_end_symbol",
    "word_all_upper",
)
_CLASS_TABLE = np.zeros((256, len(_CLASSES)), dtype=np.float32)
for _k, _chars in enumerate(_CLASSES.values()):
    _CLASS_TABLE[list(_chars), _k] = 1
_IS_SYMBOL = _CLASS_TABLE[:, [list(_CLASSES).index(c) for c in ("symbol", "bang", "bar")]].sum(axis=1) > 0
_IS_UPPER = _CLASS_TABLE[:, list(_CLASSES).index("upper")] > 0
_IS_LINE = np.zeros(256, dtype=bool)
_IS_LINE[10] = True


def _rate(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of :data:`STATISTICS` per text."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(n, dtype=np.int64), sizes)
    spectrum = np.bincount(owner * 256 + data, minlength=n * 256).reshape(n, 256).astype(np.float32)
    words = Words(data, offsets, lower=False)
    count = words.counts
    lengths = words.ends - words.starts
    who = words.owners()

    def per_text(values: np.ndarray) -> np.ndarray:
        return np.bincount(who, weights=values, minlength=n)

    hashes = words.hashes()
    distinct, kinds = distinct_per_text(hashes, who, n)
    order = np.lexsort((hashes, who))
    if len(order):
        h, o = hashes[order], who[order]
        edge = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (o[1:] != o[:-1])]))
        top = np.zeros(n)
        np.maximum.at(top, o[edge], np.diff(np.append(edge, len(h))))
    else:
        top = np.zeros(n)
    runs, run_owner = shingles(words, 3)
    _, run_kinds = distinct_per_text(runs, run_owner, n)
    run_count = np.bincount(run_owner, minlength=n)

    breaks = np.flatnonzero(_IS_LINE[data])
    line_starts = np.unique(np.concatenate([offsets[:-1][sizes > 0], breaks + 1]))
    line_starts = line_starts[line_starts < len(data)]
    line_owner = np.searchsorted(offsets, line_starts, side="right") - 1
    line_ends = np.minimum(np.append(line_starts[1:], len(data)), offsets[line_owner + 1])
    _, line_kinds = distinct_per_text(words.spans(line_starts, line_ends), line_owner, n)
    line_count = np.bincount(line_owner, minlength=n)

    share = spectrum / np.maximum(sizes, 1)[:, None]
    logs = np.log2(share, out=np.zeros_like(share), where=share > 0)
    last = data[words.ends - 1] if len(words.ends) else data[:0]
    before = np.concatenate([[0], np.cumsum(_IS_UPPER[data])])
    caps = before[words.ends] - before[words.starts]
    columns = [
        *_rate(spectrum @ _CLASS_TABLE, sizes[:, None]).T,
        np.log1p(sizes),
        np.log1p(count),
        _rate(per_text(lengths), count),
        _rate(per_text(lengths > 15), count),
        _rate(per_text(lengths <= 3), count),
        _rate(kinds, count),
        _rate(run_kinds, run_count),
        _rate(top, count),
        _rate(sizes, line_count),
        _rate(line_kinds, line_count),
        -(share * logs).sum(axis=1),
        (spectrum > 0).sum(axis=1),
        _rate(per_text(_IS_SYMBOL[last]), count),
        _rate(per_text((caps > 1) & (caps * 2 > lengths)), count),
    ]
    return np.stack(columns, axis=1).astype(np.float32)


@dataclass
class Trees:
    """Complete trees of one depth side by side: split column, upper border and leaf value by position."""

    column: np.ndarray  # trees x inner nodes
    border: np.ndarray
    value: np.ndarray  # trees x leaves
    start: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.start)
        each = np.arange(len(rows))
        depth = int(np.log2(self.value.shape[1])) if len(self.value) else 0
        for column, border, value in zip(self.column, self.border, self.value):
            at = np.zeros(len(rows), dtype=np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (rows[each, column[at]] > border[at])
            total += value[at - len(column)]
        return 1 / (1 + np.exp(-total))


def fit_trees(
    rows: np.ndarray, labels: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE
) -> Trees:
    """Newton boosting of the log loss with histograms of at most ``bins`` quantile bins per column."""
    n, width = rows.shape
    good = (labels.sum() + 0.5) / (n + 1)
    start = float(np.log(good / (1 - good)))
    none = Trees(np.zeros((0, 2**depth - 1), int), np.zeros((0, 2**depth - 1)), np.zeros((0, 2**depth)), start)
    if n == 0 or labels.min() == labels.max():
        return none
    borders = [np.unique(np.quantile(rows[:, k], np.linspace(0, 1, bins + 1)[1:-1])) for k in range(width)]
    codes = np.stack([np.searchsorted(borders[k], rows[:, k], side="left") for k in range(width)])
    flat = codes + (np.arange(width) * bins)[:, None]  # position in a histogram of all columns
    margin = np.full(n, start)
    out: tuple[list, list, list] = ([], [], [])
    inner = 2**depth - 1
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        slope, curve = labels - p, p * (1 - p)
        at = np.zeros(n, dtype=np.int64)
        column, border = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, nodes = 2**level - 1, 2**level
            place = (at - first) * (width * bins)
            g = np.zeros(nodes * width * bins)
            h = np.zeros(nodes * width * bins)
            for k in range(width):
                g += np.bincount(place + flat[k], weights=slope, minlength=len(g))
                h += np.bincount(place + flat[k], weights=curve, minlength=len(h))
            g = g.reshape(nodes, width, bins).cumsum(axis=2)
            h = h.reshape(nodes, width, bins).cumsum(axis=2)
            all_g, all_h = g[:, :1, -1:], h[:, :1, -1:]
            gain = g**2 / (h + 1) + (all_g - g) ** 2 / (all_h - h + 1) - all_g**2 / (all_h + 1)
            gain[(h < 1) | (all_h - h < 1)] = 0
            gain[:, :, -1] = 0
            best = gain.reshape(nodes, -1).argmax(axis=1)
            for node in range(nodes):
                k, b = divmod(int(best[node]), bins)
                if gain[node, k, b] > 1e-9 and b < len(borders[k]):
                    column[first + node], border[first + node] = k, borders[k][b]
            at = 2 * at + 1 + (rows[np.arange(n), column[at]] > border[at])
        leaf = at - inner
        value = rate * np.bincount(leaf, weights=slope, minlength=inner + 1) / (
            np.bincount(leaf, weights=curve, minlength=inner + 1) + 1
        )
        margin += value[leaf]
        for kept, new in zip(out, (column, border, value)):
            kept.append(new)
    return Trees(np.array(out[0]), np.array(out[1]), np.array(out[2]), start)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels the fit never sees."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch):
            table = statistics(*buffers(piece.column("text")))
            values = pa.array(table.ravel(), pa.float32())
            at = pa.array(np.arange(len(table) + 1, dtype=np.int32) * table.shape[1])
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.ListArray.from_arrays(at, values)], names=["doc_id", "stats"]
            )


def _apply(model: Trees):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.asarray(batch.column("stats").flatten(), dtype=np.float32)
            scores = model.scores(values.reshape(batch.num_rows, len(STATISTICS)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    return run


def document_statistics(docs: DataFrame) -> DataFrame:
    bounded_batches(docs.sparkSession)
    return documents_view(docs).mapInArrow(_measure, "doc_id long, stats array<float>")


def fit_quality(stats: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Trees:
    """Fit on at most ``train_rows`` labelled rows that are not held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("_label")).where(
        "_id is not null and _label is not null"
    )
    rows = (
        stats.where(~held_out(F.col("doc_id")))
        .join(known, F.col("doc_id") == F.col("_id"))
        .orderBy(F.xxhash64(F.lit(7), "doc_id"), "doc_id", "_label")
        .limit(train_rows)
        .select("stats", "_label")
        .toArrow()
    )
    table = np.asarray(rows.column("stats").combine_chunks().flatten(), dtype=np.float32)
    return fit_trees(table.reshape(rows.num_rows, len(STATISTICS)), np.asarray(rows.column("_label"), dtype=float))


def quality_scores(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, score (label 1 likelier if higher), predicted."""
    stats = stage(document_statistics(docs), "quality-stats")
    scored = stats.mapInArrow(_apply(fit_quality(stats, labels, train_rows)), "doc_id long, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def drop_low_quality(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``docs`` without the documents predicted 0; rows without doc_id stay, of a repeated id all rows go if all are rejected."""
    verdict = quality_scores(docs, labels, train_rows).groupBy(F.col("doc_id").alias("_id")).agg(F.max("predicted").alias("_best"))
    rejected = verdict.where("_best = 0 and _id is not null")
    return docs.join(rejected, docs["doc_id"] == rejected["_id"], "left_anti").select(*docs.columns)
