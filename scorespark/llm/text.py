"""Whole texts as numpy arrays inside Arrow tasks: words, hashes and runs of a batch.

White space is ``[\\x20\\x09-\\x0D]`` everywhere; a word is a longest run of other
bytes. These bytes never occur inside a multi-byte UTF-8 character, so working on
bytes and on characters gives the same words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WHITE = b" \t\n\x0b\x0c\r"
WHITE_CLASS = r"[\x20\x09-\x0D]"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Bytes of text that a task turns into arrays at a time.
SLICE_BYTES = 2 << 20

_rng = np.random.default_rng(20240229)
BYTE_CODES = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 2**64))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WHITE = np.zeros(256, dtype=bool)
IS_WHITE[list(WHITE)] = True

_powers: dict[str, np.ndarray] = {}


def bounded_batches(spark: SparkSession, rows: int = 2000, size: int = 8 << 20) -> None:
    """Arrow batches of at most ``rows`` rows and about ``size`` bytes, so long texts do not pile up."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def documents_view(docs: DataFrame) -> DataFrame:
    """The two columns operators compute on; others, whatever their names, stay outside."""
    return docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def _power_table(kind: str, n: int) -> np.ndarray:
    table = _powers.get(kind)
    if table is None or len(table) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        factors = np.full(size, BASE if kind == "up" else BASE_INVERSE, dtype=np.uint64)
        factors[0] = 1
        table = _powers[kind] = np.multiply.accumulate(factors)
    return table[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finishing step of a 64-bit hash."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows of a batch in pieces of about :data:`SLICE_BYTES` of ``column``."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    start, n = 0, len(sizes)
    if not n:
        return
    ends = np.cumsum(sizes)
    while start < n:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + SLICE_BYTES, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a column one after another, and where each begins and ends; null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, dtype=kind, count=len(column) + 1, offset=column.offset * np.dtype(kind).itemsize)
    at = at.astype(np.int64)
    size = int(at[-1] - at[0])
    out = np.frombuffer(data, dtype=np.uint8, count=size, offset=int(at[0])) if data and size else np.zeros(0, np.uint8)
    return out, at - at[0]


class Words:
    """Where the words of a batch of texts lie and the hashes of their bytes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = True):
        self.data = LOWER[data] if lower else data
        self.offsets = offsets
        n = len(data)
        inside = ~IS_WHITE[data]
        first = np.ones(n + 1, dtype=bool)
        np.logical_not(inside, out=first[1:])
        first[offsets[:-1]] = True
        last = np.ones(n + 1, dtype=bool)
        np.logical_not(inside, out=last[:-1])
        last[offsets[1:]] = True
        self.starts = np.flatnonzero(inside & first[:-1])
        self.ends = np.flatnonzero(inside & last[1:]) + 1
        self.first = np.searchsorted(self.starts, offsets)  # of each text, its first word; one more at the end
        self.counts = np.diff(self.first)
        self._prefix: np.ndarray | None = None

    def prefix(self) -> np.ndarray:
        if self._prefix is None:
            n = len(self.data)
            self._prefix = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(BYTE_CODES[self.data] * _power_table("up", n), out=self._prefix[1:])
        return self._prefix

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of stretches of bytes, equal for equal bytes wherever they stand."""
        sums = self.prefix()
        raw = (sums[ends] - sums[starts]) * _power_table("down", len(self.data) + 1)[starts]
        return mix(raw + (ends - starts).astype(np.uint64))

    def hashes(self) -> np.ndarray:
        return self.spans(self.starts, self.ends)

    def owners(self) -> np.ndarray:
        """For each word, the number of its text."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words and the text of each.

    A text with fewer words has one run, all its words; a text without words has none.
    """
    hashes, counts, first = words.hashes(), words.counts, words.first
    factors = [np.uint64(int(BASE) * (2 * k + 3) % 2**64 | 1) for k in range(width)]
    n = len(hashes)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    owners = words.owners()
    total = np.zeros(n, dtype=np.uint64)
    for k, factor in enumerate(factors[:n]):
        total[: n - k] += mix(hashes[k:] + np.uint64(k)) * factor
    left = np.repeat(first[1:], counts) - np.arange(n)  # words from here to the end of the text
    full = left >= width
    out, who = mix(total[full]), owners[full]
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        extra = np.zeros(len(short), dtype=np.uint64)
        for k in range(width - 1):
            has = counts[short] > k
            extra[has] += mix(hashes[first[:-1][short[has]] + k] + np.uint64(k)) * factors[k]
        out = np.concatenate([out, mix(extra + counts[short].astype(np.uint64))])
        who = np.concatenate([who, short])
    return out, who


def distinct_per_text(values: np.ndarray, owners: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each text, sorted within the text, and how many each text has."""
    order = np.lexsort((values, owners)) if len(values) else np.zeros(0, np.int64)
    values, owners = values[order], owners[order]
    fresh = np.ones(len(values), dtype=bool)
    fresh[1:] = (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])
    return values[fresh], np.bincount(owners[fresh], minlength=texts)
