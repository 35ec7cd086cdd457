"""Removal of repeated byte strings by a distributed merge sort of sampled suffixes.

A byte goes when a string of ``LENGTH`` bytes that covers it also starts earlier:
in a document with a smaller doc_id, or earlier in the same one. The order of all
suffixes of a corpus does not fit next to it, so suffixes are sampled in a way
that loses no repeat: an *anchor* is a place whose ``GRAM`` bytes have the smallest
hash in some window of ``LENGTH`` bytes. Equal windows have the same anchors, so
two equal windows always meet at an anchor, which has at most ``REACH`` bytes of
the window to its left.

1. Tasks sort the anchors of their texts by gram hash. Of anchors with the same
   gram and the same surroundings (REACH bytes before, LENGTH from here on; by
   64-bit hash each) a task sends the earliest only; all others are repeats.
   Sorted runs are exchanged by hash range with their bytes in planes, which
   codes equal leading bytes away.
2. Where runs meet, later anchors with known surroundings are repeats as a whole.
   Grams with several surroundings are where repeats begin or end; the earliest
   anchor of each surrounding goes on with its bytes.
3. These suffixes (bytes from the anchor on, then the bytes before it read
   backwards) are sorted in each task and exchanged as front-coded runs: each key
   as the length of the prefix it shares with the one before and the rest. A loser
   tree merges the runs comparing shared-prefix lengths first and bytes only
   beyond what is known to be equal. Neighbours' shared prefixes then tell, for
   every number of bytes left of the anchor, which windows are equal; all but the
   earliest are repeats.
4. Repeats return to their documents as stretches, and what is left is hashed.

Documents equal to one with a smaller doc_id are repeats from end to end and take
no part beyond step 1. Rows that repeat doc_id and text are one document; different
texts under one doc_id are ordered by hash; rows without doc_id come last. Null
texts are empty, texts shorter than LENGTH bytes keep all bytes. Other columns are
not read. An anchor gram of very many documents is one entry per task in step 1, but
its borders, if all differ, meet in one task of step 3.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorespark.llm.text import Words, bounded_batches, buffers, mix, slices
from scorespark.session import stage

LENGTH, GRAM = 100, 32
REACH = LENGTH - GRAM
#: Bytes of text whose anchors one task sorts at a time, and that one range of hashes stands for.
RUN_BYTES = 8 << 20
RANGE_BYTES = 8 << 20
#: Documents without id come after all others, in the order of their hashes.
_NO_ID = 1 << 62
#: An anchor: gram hash, hash of the surroundings, document (id and hash of the text), place.
_ENTRY = np.dtype([("gram", "<u8"), ("around", "<u4"), ("around2", "<u2"), ("doc", "<i8"), ("text", "<i4"), ("pos", "<u4")])


def _running_least(x: np.ndarray, width: int, best=np.minimum) -> np.ndarray:
    """Least of each ``width`` values in a row; one result per place where they all exist."""
    n = len(x) - width + 1
    full = -(-len(x) // width) * width
    padded = np.full(full, x[-1], dtype=x.dtype)
    padded[: len(x)] = x
    table = padded.reshape(-1, width)
    before = best.accumulate(table, axis=1).ravel()
    after = best.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(after[:n], before[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, gram hash and hash of the surroundings of all anchors of a batch of texts."""
    empty = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    if len(data) < LENGTH:
        return empty
    words = _Hashes(data)
    grams = words.all_of(GRAM)
    rank = (grams >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    least = _running_least(rank, REACH + 1)  # of the window that starts here
    fits = np.zeros(len(least) + 1, dtype=np.int8)
    long = np.diff(offsets) >= LENGTH
    starts, stops = offsets[:-1][long], offsets[1:][long] - LENGTH + 1
    np.add.at(fits, starts, 1)
    np.add.at(fits, stops, -1)
    least[np.cumsum(fits[:-1]) == 0] = 0
    if not len(starts):
        return empty
    most = np.concatenate([np.zeros(REACH, np.uint32), least, np.zeros(REACH, np.uint32)])
    chosen = np.flatnonzero(_running_least(most, REACH + 1, np.maximum)[: len(rank)] == rank)
    owner = np.searchsorted(offsets, chosen, side="right") - 1
    low = np.maximum(chosen - REACH, offsets[owner])
    high = np.minimum(chosen + LENGTH, offsets[owner + 1])
    around = mix(words.spans(low, high) + (chosen - low).astype(np.uint64))
    return chosen, grams[chosen], around


class _Hashes(Words):
    """Hashes of stretches of bytes only, without looking for words."""

    def __init__(self, data: np.ndarray):
        self.data = data
        self._prefix = None

    def all_of(self, width: int) -> np.ndarray:
        at = np.arange(len(self.data) - width + 1)
        return self.spans(at, at + width)


def earlier(entries: np.ndarray) -> np.ndarray:
    """Order of entries in the corpus."""
    return np.lexsort((entries["pos"], entries["text"], entries["doc"]))


def _reach(pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretch that all windows through an anchor cover, but for the end of the text."""
    pos = pos.astype(np.int64)
    return np.maximum(pos - REACH, 0), pos + LENGTH


def settle(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries sorted by gram and surroundings, earliest first, and which are the earliest of theirs."""
    entries = entries[earlier(entries)]
    entries = entries[np.lexsort((entries["around2"], entries["around"], entries["gram"]))]
    first = np.ones(len(entries), dtype=bool)
    first[1:] = np.any([entries[c][1:] != entries[c][:-1] for c in ("gram", "around", "around2")], axis=0)
    return entries, first


def _not_copies(entries: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Later entries but for those of documents equal to that of the earliest, or of the same row repeated."""
    lead = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
    return ~first & ~((entries["text"] == entries["text"][lead]) & (entries["pos"] == entries["pos"][lead]))


def planes(entries: np.ndarray) -> bytes:
    """Bytes of sorted entries, plane by plane: what neighbours share stands together."""
    return np.ascontiguousarray(entries.view(np.uint8).reshape(len(entries), -1).T).tobytes()


def from_planes(raw: bytes) -> np.ndarray:
    table = np.frombuffer(raw, dtype=np.uint8).reshape(_ENTRY.itemsize, -1)
    return np.ascontiguousarray(table.T).view(_ENTRY).ravel()


_RUN = "range long, run binary, doc long, text int, low long, high long"


def _batch(schema: str, *columns) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def _spread(who: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of numbered documents joined where they touch."""
    order = np.lexsort((low, who))
    who, low, high = who[order], low[order], high[order]
    if not len(who):
        return who, low, high
    step = who * (np.int64(1) << 40)
    reach = np.maximum.accumulate(high + step)
    fresh = np.ones(len(who), dtype=bool)
    fresh[1:] = ((low + step)[1:] > reach[:-1]) | (who[1:] != who[:-1])
    edge = np.flatnonzero(fresh)
    return who[edge], low[edge], reach[np.append(edge[1:], len(who)) - 1] - step[edge]


def _stretches(later: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc, text, low, high) that repeated anchors cover."""
    later = later[np.lexsort((later["text"], later["doc"]))]
    fresh = np.ones(len(later), dtype=bool)
    fresh[1:] = (later["doc"][1:] != later["doc"][:-1]) | (later["text"][1:] != later["text"][:-1])
    number = np.cumsum(fresh) - 1
    lead = later[fresh]
    who, low, high = _spread(number, *_reach(later["pos"]))
    return lead["doc"][who], lead["text"][who], low, high


def range_of(gram: np.ndarray, ranges: int) -> np.ndarray:
    """The range of a gram, from a second mix: anchors are the smallest hashes of their windows, so
    the top bits of the hash itself would crowd them into the first ranges."""
    return ((mix(gram) >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _sorted_runs(ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        held = 0

        def packed() -> Iterator[pa.RecordBatch]:
            entries, first = settle(np.concatenate(waiting))
            waiting.clear()
            doc, text, low, high = _stretches(entries[_not_copies(entries, first)])
            if len(doc):
                yield _batch(_RUN, doc % ranges, [None] * len(doc), doc, text, low, high)
            kept = entries[first]
            of = range_of(kept["gram"], ranges)
            by = np.argsort(of, kind="stable")  # within a range still by gram
            kept, of = kept[by], of[by]
            edges = np.searchsorted(of, np.arange(ranges + 1))
            used = np.flatnonzero(np.diff(edges))
            for part in np.array_split(used, max(1, len(used) // 64)):
                if len(part):
                    none = [None] * len(part)
                    yield _batch(_RUN, part, [planes(kept[edges[k] : edges[k + 1]]) for k in part], none, none, none, none)

        for batch in batches:
            for piece in slices(batch):
                data, offsets = buffers(piece.column("text"))
                place, gram, around = anchors(data, offsets)
                owner = np.searchsorted(offsets, place, side="right") - 1
                entries = np.zeros(len(place), dtype=_ENTRY)
                entries["gram"] = gram
                entries["around"], entries["around2"] = around & np.uint64(0xFFFFFFFF), around >> np.uint64(48)
                entries["doc"] = np.asarray(piece.column("doc"))[owner]
                entries["text"] = np.asarray(piece.column("text_hash"))[owner]
                entries["pos"] = place - offsets[owner]
                waiting.append(entries)
                held += len(data)
                if held > RUN_BYTES:
                    yield from packed()
                    held = 0
        if waiting:
            yield from packed()

    return run


_MET = "doc long, text int, pos long, gram long, low long, high long"


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeats (low, high set) and borders (gram set) of each range; rows come sorted by range."""

    def settled(runs: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if not runs:
            return
        entries, first = settle(np.concatenate(runs))
        doc, text, low, high = _stretches(entries[_not_copies(entries, first)])
        none = [None] * len(doc)
        yield _batch(_MET, doc, text, none, none, low, high)
        lead = entries[first]
        same = lead["gram"][1:] == lead["gram"][:-1]
        several = np.zeros(len(lead), dtype=bool)
        several[1:] |= same
        several[:-1] |= same
        border = lead[several]
        none = [None] * len(border)
        yield _batch(_MET, border["doc"], border["text"], border["pos"].astype(np.int64), border["gram"].view(np.int64), none, none)

    key, runs = None, []
    for batch in batches:
        passed = batch.filter(pc.is_valid(batch.column("doc")))
        n = passed.num_rows
        if n:
            none = [None] * n
            yield _batch(_MET, passed.column("doc"), passed.column("text"), none, none, passed.column("low"), passed.column("high"))
        for new, raw in zip(batch.column("range").to_pylist(), batch.column("run")):
            if not raw.is_valid:
                continue
            if new != key:
                yield from settled(runs)
                key, runs = new, []
            runs.append(from_planes(raw.as_py()))
    yield from settled(runs)


# front-coded runs and their merge

_CODED = "range long, n int, shared binary, sizes binary, rest binary, doc binary, text binary, pos binary, right binary"


def front_coded(keys: list[bytes]) -> tuple[list[int], list[bytes]]:
    """Of sorted keys, the length of the prefix shared with the one before, and the rest."""
    shared, rest, before = [], [], b""
    for key in keys:
        k = common_prefix(before, key, 0)
        shared.append(k)
        rest.append(key[k:])
        before = key
    return shared, rest


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix of two keys that agree in their first ``known`` bytes."""
    n = min(len(a), len(b))
    step = 16
    while known < n:
        if a[known : known + step] == b[known : known + step]:
            known = min(known + step, n)
        elif step == 1:
            break
        else:
            step //= 4 if step > 4 else step
            step = max(step, 1)
    return known


class LoserTree:
    """Merge of sorted runs of (shared prefix with the run's last key, rest of the key).

    Every waiting key knows the prefix it shares with the key put out last. The one
    that shares more comes first without a look at its bytes; with equal prefixes
    comparison starts right behind them.
    """

    def __init__(self, runs: list[Iterator[tuple[int, bytes]]]):
        self.runs = runs
        self.keys: list[bytes | None] = [b""] * len(runs)
        self.known = [0] * len(runs)
        for k in range(len(runs)):
            self._pull(k)
        self.size = 1
        while self.size < max(1, len(runs)):
            self.size *= 2
        self.losers = [-1] * self.size
        self.winner = self._build(1)

    def _pull(self, k: int) -> None:
        item = next(self.runs[k], None)
        if item is None:
            self.keys[k] = None
        else:
            shared, rest = item
            self.keys[k] = self.keys[k][:shared] + rest
            self.known[k] = shared

    def _build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size if node - self.size < len(self.runs) else -1
        return self._play(node, self._build(2 * node), self._build(2 * node + 1))

    def _play(self, node: int, a: int, b: int) -> int:
        """Keep the loser at the node, return the winner; the loser's prefix then is the one it shares with the winner."""
        if a < 0 or self.keys[a] is None:
            a, b = b, a
        elif b >= 0 and self.keys[b] is not None:
            if self.known[a] < self.known[b]:
                a, b = b, a
            elif self.known[a] == self.known[b]:
                x, y = self.keys[a], self.keys[b]
                k = common_prefix(x, y, self.known[a])
                if x[k : k + 1] > y[k : k + 1] or (len(x) > len(y) and k == len(y)):
                    a, b = b, a
                self.known[b] = k
        self.losers[node] = b
        return a

    def __iter__(self) -> Iterator[tuple[int, int, bytes]]:
        """(run, prefix shared with the key before, key) in order."""
        while self.winner >= 0 and self.keys[self.winner] is not None:
            k = self.winner
            yield k, self.known[k], self.keys[k]
            self._pull(k)
            node = (k + self.size) // 2
            while node:
                k = self._play(node, k, self.losers[node])
                node //= 2
            self.winner = k


def _suffix_runs(ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, bytes, int, int, int, int]] = []
        held = 0

        def packed() -> Iterator[pa.RecordBatch]:
            rows.sort()
            edge = 0
            while edge < len(rows):
                stop, number = edge, rows[edge][0]
                while stop < len(rows) and rows[stop][0] == number:
                    stop += 1
                part = rows[edge:stop]
                shared, rest = front_coded([r[1] for r in part])
                numbers = [np.array([r[k] for r in part], dtype=np.int64).tobytes() for k in (2, 3, 4)]
                yield _batch(
                    _CODED,
                    [number],
                    [len(part)],
                    [np.array(shared, dtype=np.uint8).tobytes()],
                    [np.array([len(r) for r in rest], dtype=np.uint8).tobytes()],
                    [b"".join(rest)],
                    *[[x] for x in numbers],
                    [np.array([r[5] for r in part], dtype=np.uint8).tobytes()],
                )
                edge = stop
            rows.clear()

        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            places = zip(batch.column("doc").to_pylist(), batch.column("text_hash").to_pylist(), batch.column("borders"), texts)
            for doc, text_hash, borders, text in places:
                raw = text.as_py()
                listed = borders.as_py()
                grams = np.array([b["gram"] for b in listed], dtype=np.int64).view(np.uint64)
                for border, number in zip(listed, range_of(grams, ranges).tolist()):
                    pos = border["pos"]
                    left = raw[max(0, pos - REACH) : pos]
                    key = raw[pos : pos + LENGTH]
                    # where the text ends early, the key's right part is filled up so that the left part starts at one place
                    filled = key + b"\xff" * (LENGTH - len(key))
                    rows.append((number, filled + left[::-1], doc, text_hash, pos, len(key)))
                    held += 300
            if held > RUN_BYTES * 2:
                yield from packed()
                held = 0
        yield from packed()

    return run


def _decoded(row: dict) -> Iterator[tuple[int, bytes]]:
    shared, sizes, rest = row["shared"], row["sizes"], row["rest"]
    at = 0
    for k in range(row["n"]):
        yield shared[k], rest[at : at + sizes[k]]
        at += sizes[k]


def equal_windows(keys: np.ndarray, lengths: np.ndarray, right: np.ndarray, shared: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For sorted keys, which windows (by bytes left of the anchor, 0 to REACH) are not the earliest of their kind."""
    n = len(keys)
    out = np.zeros((n, REACH + 1), dtype=bool)
    left = keys[:, LENGTH:]
    hashes = np.zeros(n, dtype=np.uint64)
    left_size = lengths - LENGTH
    for o in range(REACH + 1):
        if o:
            hashes = mix(hashes * np.uint64(0x9E3779B97F4A7C15) + left[:, o - 1] + np.uint64(1))
        usable = np.flatnonzero((left_size >= o) & (right >= LENGTH - o))
        if len(usable) < 2:
            continue
        same_right = np.cumsum(shared < LENGTH - o)[usable]
        by = np.lexsort((order[usable], hashes[usable], same_right))
        at, block, code = usable[by], same_right[by], hashes[usable][by]
        follows = np.zeros(len(at), dtype=bool)
        follows[1:] = (block[1:] == block[:-1]) & (code[1:] == code[:-1])
        lead = np.maximum.accumulate(np.where(follows, 0, np.arange(len(at))))
        late = np.flatnonzero(follows & (order[usable][by] > order[usable][by][lead]))
        if o and len(late):
            late = late[(left[at[late], :o] == left[at[lead[late]], :o]).all(axis=1)]
        out[at[late], o] = True
    return out


_SPAN = "doc long, text int, low long, high long"


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of repeats among the borders of each range; rows come sorted by range."""
    key, runs = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["range"] != key:
                yield from _merged(runs)
                key, runs = row["range"], []
            runs.append(row)
    yield from _merged(runs)


def _merged(runs: list[dict]) -> Iterator[pa.RecordBatch]:
    if not runs:
        return
    total = sum(r["n"] for r in runs)
    keys = np.zeros((total, LENGTH + REACH), dtype=np.uint8)
    lengths, shared, source = np.zeros(total, np.int64), np.zeros(total, np.int64), np.zeros(total, np.int64)
    begin = np.cumsum([0] + [r["n"] for r in runs])
    taken = [0] * len(runs)
    for k, (run, known, value) in enumerate(LoserTree([_decoded(r) for r in runs])):
        keys[k, : len(value)] = np.frombuffer(value, dtype=np.uint8)
        lengths[k], shared[k], source[k] = len(value), known, begin[run] + taken[run]
        taken[run] += 1
    columns = {c: np.concatenate([np.frombuffer(r[c], dtype=np.int64) for r in runs])[source] for c in ("doc", "text", "pos")}
    right = np.concatenate([np.frombuffer(r["right"], dtype=np.uint8) for r in runs])[source].astype(np.int64)
    by = np.lexsort((columns["pos"], columns["text"], columns["doc"]))
    fresh = np.any([np.diff(columns[c][by], prepend=-1) != 0 for c in columns], axis=0)  # repeated rows share a rank
    rank = np.empty(total, dtype=np.int64)
    rank[by] = np.cumsum(fresh)
    table = equal_windows(keys, lengths, right, shared, rank)
    ends = np.zeros((total, REACH + 3), dtype=np.int8)
    ends[:, 1:-1] = table
    turn = np.diff(ends, axis=1)
    who, low_o = np.nonzero(turn == 1)
    _, high_o = np.nonzero(turn == -1)
    pos = columns["pos"][who]
    if len(who):
        yield _batch(_SPAN, columns["doc"][who], columns["text"][who], pos - high_o + 1, pos - low_o + LENGTH)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        texts = batch.column("text").cast(pa.binary())
        keys = zip(batch.column("doc").to_pylist(), batch.column("text_hash").to_pylist())
        for key, text, spans in zip(keys, texts, batch.column("spans")):
            raw = text.as_py()
            low = np.array([s["low"] for s in spans.as_py()], dtype=np.int64)
            high = np.minimum(np.array([s["high"] for s in spans.as_py()], dtype=np.int64), len(raw))
            _, low, high = _spread(np.zeros(len(low), np.int64), low, high)
            digest, at = hashlib.sha256(), 0
            for a, b in zip(low.tolist(), high.tolist()):
                digest.update(raw[at:a])
                at = b
            digest.update(raw[at:])
            out.append((*key, int((high - low).sum()), len(low), digest.digest(), low, high))
        columns = list(zip(*out)) or [()] * 7
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(columns[0], pa.int64()),
                pa.array(columns[1], pa.int32()),
                pa.array(columns[2], pa.int64()),
                pa.array(columns[3], pa.int64()),
                pa.array(columns[4], pa.binary()),
                pa.array(columns[5], pa.list_(pa.int64())),
                pa.array(columns[6], pa.list_(pa.int64())),
            ],
            names=["doc", "text_hash", "n_removed", "n_spans", "sha", "span_starts", "span_ends"],
        )


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    hashed = F.xxhash64(F.lit(5), text)
    last = F.lit(_NO_ID) + F.shiftrightunsigned(F.xxhash64(F.lit(7), text), 3)
    return docs.select(
        doc_id.alias("doc_id"),
        F.coalesce(doc_id, last).alias("doc"),
        hashed.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int").alias("text_hash"),
        hashed.alias("same"),
        text.alias("text"),
    )


def repeated_stretches(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, span_starts, span_ends (in bytes)."""
    bounded_batches(docs.sparkSession)
    keyed = _keyed(docs)
    slim = stage(
        keyed.select("doc_id", "doc", "text_hash", "same", F.octet_length("text").cast("long").alias("n_bytes"), F.xxhash64(F.lit(6), "text").alias("again"), F.sha2(F.col("text").cast("binary"), 256).alias("sha")),
        "suffix-slim",
    )
    size = slim.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    ranges = int(size // RANGE_BYTES) + 1

    runs = keyed.select("doc", "text_hash", "text").mapInArrow(_sorted_runs(ranges), _RUN)
    met = runs.repartition("range").sortWithinPartitions("range").mapInArrow(_meet, _MET)
    met = stage(met.withColumnRenamed("text", "text_hash"), "suffix-met")

    copies = slim.groupBy("same", "again", "n_bytes").agg(F.min("doc").alias("first_doc"))
    owners = slim.join(copies, ["same", "again", "n_bytes"])
    key = ["doc", "text_hash"]
    later = owners.where("doc > first_doc").select(*key).distinct()
    borders = met.where("gram is not null").join(later, key, "left_anti")
    lists = borders.groupBy(*key).agg(F.collect_set(F.struct("pos", "gram")).alias("borders"))
    texts = keyed.select(*key, "text")
    suffixes = texts.join(lists.hint("shuffle_hash"), key).select(*key, "text", "borders").mapInArrow(_suffix_runs(ranges), _CODED)
    merged = suffixes.repartition("range").sortWithinPartitions("range").mapInArrow(_merge, _SPAN)

    spans = met.where("gram is null").select(*key, "low", "high").unionByName(merged.withColumnRenamed("text", "text_hash"))
    per_text = spans.groupBy(*key).agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    cut = stage(
        texts.join(per_text.hint("shuffle_hash"), key)
        .select(*key, "text", "spans")
        .mapInArrow(_cut, "doc long, text_hash int, n_removed long, n_spans long, sha binary, span_starts array<long>, span_ends array<long>")
        .dropDuplicates(key),
        "suffix-cut",
    ).withColumnRenamed("sha", "cut_sha")
    copy = (F.col("doc") > F.col("first_doc")) & (F.col("n_bytes") >= LENGTH)
    zero = F.lit(0).cast("long")
    no_spans = F.array().cast("array<long>")
    return owners.join(cut, key, "left").select(
        "doc_id",
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", zero)).alias("n_removed"),
        F.when(copy, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", zero)).alias("n_spans"),
        F.when(copy, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce(F.lower(F.hex("cut_sha")), "sha")).alias("kept_sha256"),
        F.when(copy, F.array(zero)).otherwise(F.coalesce("span_starts", no_spans)).alias("span_starts"),
        F.when(copy, F.array("n_bytes")).otherwise(F.coalesce("span_ends", no_spans)).alias("span_ends"),
    )
