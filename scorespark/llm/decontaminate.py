"""Benchmark decontamination: CGK embedding, bit-sampling LSH and exact edit verification.

Texts and benchmark items are sequences of words: A-Z lowered, ASCII characters
other than letters and digits separate words. A document holds an item of n words
if some stretch of it is within ``floor((1 - similarity) * n)`` word edits.

* Items are cut into pieces of at most ``PIECE`` words. Of an item within its edit budget some
  piece is within its share of it, and shares an unbroken run of words with the text
  (pigeonhole); windows of the piece's size are laid where such a run lines up.
* Windows and pieces are embedded by CGK random walks: in step t the current word is
  written down and a random bit of (walk, t, word) says whether to go on to the next. Few
  edits leave most written places equal, so edit distance becomes Hamming distance.
* Each of ``WALKS`` x ``TABLES`` hash tables samples ``BITS`` written places (bit-sampling LSH). Windows
  and pieces that meet in a table make a candidate region, decided by the exact edit
  distance to the best stretch of the region. Because a piece is short whatever the length of
  its item, recall does not fall with the length (tests measure it, over 0.9 by the tables alone).
* What the tables miss is looked at by a second, lossless path: an edit destroys at most two of
  the item's word pairs, so places where a run of the item lines up and that hold ``n - 1 - 2 * edits``
  of its pairs are decided by the exact distance too. The result is therefore whole.

Null or empty texts and items hold and are held by nothing; items of fewer than
``MIN_WORDS`` words are too short to prove a leak and match nothing. Items go to
the tasks in chunks of at most ``CHUNK_CHARS`` characters, one pass over the
documents each. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorespark.llm.text import LOWER, Words, bounded_batches, buffers, documents_view, mix, slices

SIMILARITY = 0.8
MIN_WORDS = 5
RUN = 4
PIECE = 24
WALKS, TABLES, BITS = 6, 10, 2
#: Windows embedded at a time.
WINDOWS_AT_A_TIME = 4096
CHUNK_CHARS = 1 << 20
#: Words of regions compared at a time.
CELLS_AT_A_TIME = 1 << 19
MATCH = "doc_id long, item_id long, similarity double, distance int, start_word long, n_words int"

_FOLD = LOWER.copy()
_FOLD[[c for c in range(128) if not chr(c).isalnum()]] = 32
_RUN_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)


def folded_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    return Words(_FOLD[data], offsets, lower=False)


def _runs(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each place on; the last places have none."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total += mix(hashes[k : k + n] + np.uint64(k + 1)) * _RUN_FACTORS[k]
    return mix(total)


def edit_budget(n: int, similarity: float) -> int:
    return int((1 - similarity) * n + 1e-9)


def shared_run(n: int, budget: int) -> int:
    """Words in a row that a stretch within ``budget`` edits of n words must share with them, at most RUN."""
    return min(RUN, -(-(n - budget) // (budget + 1)))


@dataclass
class Items:
    """A chunk of benchmark items ready for lookup inside a task."""

    ids: list[int]
    words: list[np.ndarray]
    similarity: float
    runs: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]  # by width: sorted run hash, item, place in it, piece
    filters: dict[int, np.ndarray]  # by width: which low 20 bits occur
    sizes: np.ndarray
    budgets: np.ndarray
    pieces: np.ndarray  # rows: item, first word, words
    keys: np.ndarray  # sorted keys of all tables
    key_pieces: np.ndarray  # the piece of each key


def piece_bounds(n: int) -> list[tuple[int, int]]:
    """First word and size of the pieces of an item, as even as can be."""
    edges = np.linspace(0, n, -(-n // PIECE) + 1).round().astype(int).tolist()
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _embedded(tokens: np.ndarray, sizes: np.ndarray, walk: int, steps: int) -> np.ndarray:
    """CGK walks over padded rows of word hashes: what is written in each step."""
    rows = np.arange(len(tokens))
    at = np.zeros(len(tokens), dtype=np.int64)
    written = np.zeros((steps, len(tokens)), dtype=np.uint64)
    width = tokens.shape[1]
    for t in range(steps):
        written[t] = np.where(at < sizes, tokens[rows, np.minimum(at, width - 1)], np.uint64(0))
        salt = np.uint64((walk * 1_000_003 + t * 7_919 + 1) * 0x9E3779B97F4A7C15 % 2**64)
        at += ((written[t] ^ salt) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(63)).astype(np.int64)
    return written


def table_keys(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Keys of rows (padded word hashes of ``sizes`` words) in each of the WALKS x TABLES tables."""
    places = np.random.default_rng(977).random((WALKS, TABLES, BITS))
    out = np.zeros((WALKS * TABLES, len(tokens)), dtype=np.uint64)
    if not len(tokens):
        return out
    columns = np.arange(len(tokens))
    for walk in range(WALKS):
        written = _embedded(tokens, sizes, walk, 2 * int(sizes.max()))
        for table in range(TABLES):
            key = sizes.astype(np.uint64) + np.uint64(((walk * TABLES + table) * 2 + 1) * 0x9E3779B97F4A7C15 % 2**64)
            for place in places[walk, table]:
                key = mix(key ^ written[(place * 1.5 * sizes).astype(np.int64), columns]) * np.uint64(0xC2B2AE3D27D4EB4F)
            out[walk * TABLES + table] = mix(key)
    return out


def _pairs(hashes: np.ndarray) -> np.ndarray:
    """Hash of each two neighbours along the last axis."""
    return mix(hashes[..., :-1] * _RUN_FACTORS[0] + mix(hashes[..., 1:] + np.uint64(1)))


def may_hold(item: np.ndarray, regions: np.ndarray, budget: int) -> np.ndarray:
    """Which rows hold as many of the item's word pairs as a stretch within ``budget`` edits must."""
    pairs, times = np.unique(_pairs(item), return_counts=True)
    own = _pairs(regions)
    at = np.minimum(np.searchsorted(pairs, own), len(pairs) - 1)
    held = np.zeros((len(regions), len(pairs)), dtype=bool)
    row, column = np.nonzero(pairs[at] == own)
    held[row, at[row, column]] = True
    return held @ times >= len(item) - 1 - 2 * budget


def _padded(hashes: np.ndarray, low: np.ndarray, high: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``width`` word hashes from ``start`` on; places outside [low, high) are 0."""
    at = start[:, None] + np.arange(width)
    inside = (at >= low[:, None]) & (at < high[:, None])
    if not len(hashes):
        return np.zeros(at.shape, np.uint64)
    return np.where(inside, hashes[np.clip(at, 0, len(hashes) - 1)], np.uint64(0))


def prepare_items(ids: list[int], texts: list[str | None], similarity: float) -> Items:
    words = folded_words(*buffers(pa.array(texts, pa.string())))
    hashes = words.hashes()
    kept, rows = [], []
    for k, item in enumerate(ids):
        own = hashes[words.first[k] : words.first[k + 1]]
        if len(own) >= MIN_WORDS:
            kept.append(item)
            rows.append(own)
    by_width: dict[int, list] = {}
    pieces, tokens = [], []
    for k, own in enumerate(rows):
        width = shared_run(len(own), edit_budget(len(own), similarity))
        bounds = piece_bounds(len(own))
        # a run belongs to the piece it begins in
        piece = len(pieces) + np.searchsorted([a for a, _ in bounds], np.arange(len(own)), side="right") - 1
        runs = _runs(own, width)
        by_width.setdefault(width, []).append((runs, np.full(len(runs), k), np.arange(len(runs)), piece[: len(runs)]))
        pieces += [(k, a, n) for a, n in bounds]
        tokens += [np.pad(own[a : a + n], (0, PIECE - n)) for a, n in bounds]
    runs, filters = {}, {}
    for width, parts in by_width.items():
        columns = [np.concatenate(c) for c in zip(*parts)]
        order = np.argsort(columns[0], kind="stable")
        runs[width] = tuple(c[order] for c in columns)
        filters[width] = np.zeros(1 << 20, dtype=bool)
        filters[width][(columns[0] & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
    sizes = np.array([len(r) for r in rows], dtype=np.int64)
    budgets = np.array([edit_budget(len(r), similarity) for r in rows], dtype=np.int64)
    pieces = np.array(pieces, dtype=np.int64).reshape(-1, 3)
    keys = table_keys(np.array(tokens, dtype=np.uint64).reshape(-1, PIECE), pieces[:, 2])
    flat, owner = keys.ravel(), np.tile(np.arange(len(pieces)), len(keys))
    order = np.argsort(flat, kind="stable")
    return Items(kept, rows, similarity, runs, filters, sizes, budgets, pieces, flat[order], owner[order])


def _expanded(sorted_keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All matches of ``wanted`` in ``sorted_keys``: index into wanted, index into sorted_keys."""
    low = np.searchsorted(sorted_keys, wanted, side="left")
    count = np.searchsorted(sorted_keys, wanted, side="right") - low
    who = np.repeat(np.arange(len(wanted)), count)
    inner = np.arange(len(who)) - np.repeat(np.cumsum(count) - count, count)
    return who, np.repeat(low, count) + inner


def _distinct(rows: np.ndarray) -> np.ndarray:
    rows = rows[np.lexsort(rows.T[::-1])]
    return rows[np.append(True, (rows[1:] != rows[:-1]).any(axis=1))] if len(rows) else rows


def _windows(hashes: np.ndarray, words: Words, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """Where runs line up: distinct (item, text, start of the item), and (text, start, size) of pieces' windows."""
    owners = words.owners()
    whole, parts = [np.zeros((0, 3), dtype=np.int64)], [np.zeros((0, 3), dtype=np.int64)]
    for width, (keys, item, place, piece) in items.runs.items():
        own = _runs(hashes, width)
        if not len(own):
            continue
        likely = np.flatnonzero(
            items.filters[width][(own & np.uint64((1 << 20) - 1)).astype(np.int64)]
            & (owners[: len(own)] == owners[width - 1 :])
        )
        who, hit = _expanded(keys, own[likely])
        at = likely[who]
        start = at - place[hit]
        whole.append(np.stack([item[hit], owners[at], start], axis=1))
        _, first, size = items.pieces[piece[hit]].T
        parts.append(np.stack([owners[at], start + first, size], axis=1))
    return _distinct(np.concatenate(whole)), _distinct(np.concatenate(parts))


def lsh_candidates(hashes: np.ndarray, words: Words, items: Items, parts: np.ndarray) -> np.ndarray:
    """Distinct (item, text, start of the item) of windows that meet a piece of the item in a table."""
    found = [np.zeros((0, 3), dtype=np.int64)]
    for at in range(0, len(parts), WINDOWS_AT_A_TIME):
        text, start, size = parts[at : at + WINDOWS_AT_A_TIME].T
        tokens = _padded(hashes, words.first[text], words.first[text + 1], start, PIECE)
        tokens[np.arange(PIECE) >= size[:, None]] = 0
        for row in table_keys(tokens, size):
            who, hit = _expanded(items.keys, row)
            item, first, _ = items.pieces[items.key_pieces[hit]].T
            found.append(np.stack([item, text[who], start[who] - first], axis=1))
        found = [_distinct(np.concatenate(found))]
    return found[0]


def _regions(windows: np.ndarray, budgets: np.ndarray) -> np.ndarray:
    """The first window of each region: windows of one item and text that start within its budget of the first."""
    item, text, start = windows.T
    fresh = np.ones(len(windows), dtype=bool)
    fresh[1:] = (item[1:] != item[:-1]) | (text[1:] != text[:-1]) | (start[1:] - start[:-1] > budgets[item[1:]])
    firsts = np.flatnonzero(fresh)
    ends = np.append(firsts[1:], len(windows))
    kept = []
    # all regions side by side: the next one of a chain begins at the first window out of reach
    span = int(start.max() - start.min()) + int(budgets.max()) + 2
    chain = np.repeat(np.arange(len(firsts)), ends - firsts)
    place = chain * span + (start - start.min())
    while len(firsts):
        kept.append(firsts)
        following = np.searchsorted(place, place[firsts] + budgets[item[firsts]], side="right")
        on = following < ends
        firsts, ends = following[on], ends[on]
    return windows[np.sort(np.concatenate(kept))]


def best_distance(item: np.ndarray, regions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest edit distance between ``item`` and any stretch of each row, and where the stretch ends.

    Rows are padded with 0, which equals no word.
    """
    rows, width = regions.shape
    steps = np.arange(width + 1, dtype=np.int32)
    above = np.zeros((rows, width + 1), dtype=np.int32)
    for k, word in enumerate(item):
        here = np.empty_like(above)
        here[:, 0] = k + 1
        here[:, 1:] = np.minimum(above[:, :-1] + (regions != word), above[:, 1:] + 1)
        above = np.minimum.accumulate(here - steps, axis=1) + steps
    return above.min(axis=1), above.argmin(axis=1)


def _covered(windows: np.ndarray, regions: np.ndarray, budgets: np.ndarray) -> np.ndarray:
    """Which windows start within the budget behind the start of a region of their item and text."""
    if not len(regions):
        return np.zeros(len(windows), dtype=bool)
    low = min(windows[:, 2].min(), regions[:, 2].min())
    span = int(max(windows[:, 2].max(), regions[:, 2].max()) - low) + 1
    texts = int(max(windows[:, 1].max(), regions[:, 1].max())) + 1
    code = lambda x: (x[:, 0] * texts + x[:, 1]) * span + (x[:, 2] - low)
    own, theirs = code(windows), np.sort(code(regions))
    before = np.searchsorted(theirs, own, side="right") - 1
    near = own - theirs[np.maximum(before, 0)]
    same = own // span == theirs[np.maximum(before, 0)] // span
    return (before >= 0) & same & (near <= budgets[windows[:, 0]])


def _verify(
    regions: np.ndarray, hashes: np.ndarray, words: Words, items: Items, best: dict[tuple[int, int], tuple[int, int]], filtered: bool
) -> None:
    """Add the exact distances of regions (sorted by item) that are within their budgets to ``best``."""
    owner, text, start = regions.T
    edges = np.searchsorted(owner, np.arange(len(items.ids) + 1))
    for k in np.unique(owner):
        item, budget = items.words[k], int(items.budgets[k])
        width = len(item) + 3 * budget
        at_a_time = max(1, CELLS_AT_A_TIME // width)
        for first in range(edges[k], edges[k + 1], at_a_time):
            window = np.arange(first, min(first + at_a_time, edges[k + 1]))
            low, high = words.first[text[window]], words.first[text[window] + 1]
            region = _padded(hashes, low, high, start[window] - budget, width)
            if filtered:
                likely = may_hold(item, region, budget)
                window, region = window[likely], region[likely]
            if not len(window):
                continue
            distance, end = best_distance(item, region)
            for w, d, e in zip(window, distance, end):
                if d <= budget:
                    key, value = (int(text[w]), int(k)), (int(d), int(start[w] - budget + e - len(item)))
                    best[key] = min(best.get(key, value), value)


def find_items(data: np.ndarray, offsets: np.ndarray, items: Items) -> list[tuple[int, int, int, int, int]]:
    """(text, item, distance, start word, words) for every item that a text holds."""
    if not items.ids:
        return []
    words = folded_words(data, offsets)
    hashes = words.hashes()
    windows, parts = _windows(hashes, words, items)
    if not len(windows):
        return []
    best: dict[tuple[int, int], tuple[int, int]] = {}
    met = lsh_candidates(hashes, words, items, parts)
    if len(met):
        met = _regions(met, items.budgets)
        _verify(met, hashes, words, items, best, False)
    # the second path: places that are not in a region already decided
    rest = windows[~_covered(windows, met, items.budgets)]
    if len(rest):
        _verify(_regions(rest, items.budgets), hashes, words, items, best, True)
    return [(t, k, d, max(s - int(words.first[t]), 0), len(items.words[k])) for (t, k), (d, s) in sorted(best.items())]


def _search(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for batch in batches:
            for piece in slices(batch):
                ids = piece.column("doc_id").to_pylist()
                rows = [
                    (ids[t], items.ids[k], 1 - d / n, d, s, n)
                    for t, k, d, s, n in find_items(*buffers(piece.column("text")), items)
                ]
                if rows:
                    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int64(), pa.int32()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[c.split()[0] for c in MATCH.split(", ")]
                    )

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document and item it holds: similarity, distance, first word and words of the item."""
    spark = docs.sparkSession
    bounded_batches(spark)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text")).where("item_id is not null and text is not null")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    chunks = chars // CHUNK_CHARS + 1
    out = None
    for k in range(chunks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(chunks)) == k).orderBy("item_id", "text").toArrow()
        prepared = prepare_items(part.column("item_id").to_pylist(), part.column("text").to_pylist(), similarity)
        found = documents_view(docs).mapInArrow(_search(spark.sparkContext.broadcast(prepared)), MATCH)
        out = found if out is None else out.unionByName(found)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` without the documents that hold an item; rows without doc_id stay."""
    leaks = contaminated(docs, benchmark, similarity).where("doc_id is not null").select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(leaks, docs["doc_id"] == leaks["_id"], "left_anti").select(*docs.columns)
