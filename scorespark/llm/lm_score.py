"""Language-model scores by online logistic context mixing.

The text of a document is its tokens: words with A-Z lowered, then one end. A token
is coded by yes-no decisions along a Huffman code over the ``VOCABULARY`` most frequent
training words that occur ``LEAST_COUNT`` times or more, the end and an escape.

* Every decision is predicted by four bit predictors: how often training texts went
  either way at the tree node alone, and under a hash of the node and the last very
  frequent word (which tells the language), the last word or the last two words.
  Counts are gathered from all training documents and added up block by block.
* Predictions (log odds) are combined by weights chosen by a gate: how sure the two
  longest predictors are. Every document starts with the same weights; they are refined
  online, after every block of ``STEP`` decisions, by the gradient of the document's own
  coding cost. Documents of a batch advance side by side but never see each other.
* An escaped word is either one of the document's earlier escaped words (adaptive
  counts of the document decide how likely, any of them is as likely), or drawn anew:
  from the training words outside the vocabulary, by their exact counts, or spelled.
  How likely a spelled one is follows from the share of words met once.
* Spelling goes byte by byte along a second tree, closed by a blank, so every text has a
  probability. Its five bit predictors see the last one to four bytes and the word so
  far. They are counted over all distinct training words; their gate weights are fitted
  in two folds of words, each predicted from the counts of the other, with decisions
  added up by cells of log odds. A word's spelling depends on the word alone, so it is
  computed once per distinct word and kept in the table of words, which grows with the input.

``score`` is the log10 probability, ``bits_per_byte`` the cost over the UTF-8 bytes
of the text. Beside it stands the base: add-one unigrams over the same tokens,
``sum log10((c + 1) / (N + V + 1))``. Counts and spellings of the ``BASE_WORDS`` most
frequent words travel to the tasks, other words are joined.

Tables of the word predictors have a slot per ``BYTES_A_SLOT`` bytes of training text,
between 2^``SLOTS_LOG[0]`` and 2^``SLOTS_LOG[1]`` of them, and those of the spelling
2^``SPELL_SLOTS_LOG``, since every task holds them.

Null and empty texts have one token, the end. Rows without doc_id are training
rows; repeated rows count and are scored each time. Without training rows all
counts are 0. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorespark.llm import text as texts
from scorespark.llm.text import Words, bounded_batches, buffers, documents_view, mix
from scorespark.session import stage

VOCABULARY = 1 << 16
LEAST_COUNT = 3
#: Words that serve as the context "last very frequent word".
MARKERS = 64
BASE_WORDS = 1 << 20
SLOTS_LOG = (19, 22)
BYTES_A_SLOT = 128
SPELL_SLOTS_LOG = 20
TABLE_BLOCK = 1 << 12
#: Hashed predictors of words, and of bytes.
WORD_TABLES, SPELL_TABLES = 3, 5
#: Weights of the word predictors a document starts with: node alone, marker, last word, last two words.
START = np.array([0.3, 0.6, 0.35, 0.25], dtype=np.float32)
GATES = 16
STEP = 256
ONLINE_RATE = 1.0
#: Cells of log odds by size, a sign bit beside it; where gates change, cells do.
CELL_EDGES = np.array([0.05, 0.7, 1.5, 2.5, 3.5, 5.0, 7.0], dtype=np.float32)
MARKS = 2 * (len(CELL_EDGES) + 1)
CELLS = MARKS**SPELL_TABLES
#: Prior counts of a document's escaped words that repeat an earlier one, and of all.
REPEATS, ESCAPES = 0.2, 4.0
#: Bytes of text, or distinct words, that one training task gathers counts over before it hands on its tables.
TRAIN_BYTES = 64 << 20
TRAIN_WORDS = 1 << 20
PIECE_BYTES = 1 << 19
#: Decisions a task counts in 32 bits before it hands on its tables; sums over tasks have 64 bits.
COUNTED_AT_A_TIME = 1 << 30
_END_HASH, _BEGIN_HASH = np.uint64(0x51ED270B35A1F3C5), np.uint64(0x2545F4914F6CDD1D)
_SLOT, _NODE = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77)


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def huffman(weights: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code of each symbol: first place and length in the flat lists of nodes and bits."""
    n = len(weights)
    heap = [(w, k) for k, w in enumerate(weights)]
    heapq.heapify(heap)
    parent, side = np.zeros(2 * n, dtype=np.int64), np.zeros(2 * n, dtype=np.int8)
    inner = n
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        for bit, (_, k) in enumerate((a, b)):
            parent[k], side[k] = inner, bit
        heapq.heappush(heap, (a[0] + b[0], inner))
        inner += 1
    root = inner - 1
    starts, lengths, nodes, bits = [], [], [], []
    for k in range(n):
        path, at = [], k
        while at != root:
            path.append((parent[at] - n, side[at]))
            at = parent[at]
        starts.append(len(nodes))
        lengths.append(len(path))
        nodes.extend(p for p, _ in reversed(path))
        bits.extend(b for _, b in reversed(path))
    return np.array(starts), np.array(lengths), np.array(nodes, dtype=np.int64), np.array(bits, dtype=np.int8)


@dataclass
class Code:
    """Token alphabet: hashes of coded words and the paths of all symbols."""

    words: np.ndarray  # sorted hashes
    symbols: np.ndarray  # symbol of each
    markers: int  # symbols below this are the very frequent words
    escape: int
    end: int
    start: np.ndarray
    length: np.ndarray
    key: np.ndarray  # hashed node of every step of a path
    bit: np.ndarray
    odds: np.ndarray  # log odds of the node alone


def _paths(weights: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    start, length, node, bit = huffman(weights)
    went = np.zeros((int(node.max(initial=0)) + 1, 2), dtype=np.int64)
    np.add.at(went, (node, bit), np.repeat(np.array(weights, dtype=np.int64), length))
    odds = np.log((went[:, 1] + 0.4) / (went[:, 0] + 0.4)).astype(np.float32)
    return start, length, node.astype(np.uint32) * _NODE, bit, odds[node]


def make_code(hashes: np.ndarray, counts: list[int], escaped: int, ends: int) -> Code:
    """One tree over the words (by falling count), the escape and the end."""
    order = np.argsort(hashes, kind="stable")
    k = len(counts)
    paths = _paths([*[max(1, c) for c in counts], max(1, escaped), max(1, ends)])
    return Code(hashes[order], order.astype(np.int64), min(MARKERS, k), k, k + 1, *paths)


def spelling_code() -> Code:
    """The tree over byte values, by a coarse guess of how frequent they are."""
    common = {c: 60 for c in b"abcdefghijklmnopqrstuvwxyz"} | {c: 120 for c in b" etaoinshr"} | {c: 10 for c in b".,0123456789"}
    none = np.zeros(0, dtype=np.uint64)
    return Code(none, none, 0, 0, 0, *_paths([common.get(c, 6 if 128 <= c < 192 else 1) for c in range(256)]))


def look_up(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted value in sorted keys, or -1."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


class _Steps:
    """Yes-no decisions of symbols in order, with hashed contexts of each symbol."""

    symbol: np.ndarray
    context: np.ndarray  # predictors x symbols, 32 bits

    def _walk(self, code: Code) -> None:
        self.bits = code.length[self.symbol]
        self.ends_at = np.concatenate([[0], np.cumsum(self.bits)])
        self.path = np.arange(self.ends_at[-1]) + np.repeat(code.start[self.symbol] - self.ends_at[:-1], self.bits)
        self.key, self.outcome = code.key[self.path], code.bit[self.path]

    def slots(self, k: int, log: int) -> np.ndarray:
        """Places in the table of predictor ``k``, which has 2^``log`` slots."""
        key = np.repeat(self.context[k] * _SLOT + np.uint32(k), self.bits)
        key += self.key
        key ^= key >> np.uint32(15)
        key *= np.uint32(0xC2B2AE35)
        key >>= np.uint32(32 - log)
        return key


class Decisions(_Steps):
    """The tokens of a batch of texts, text by text."""

    def __init__(self, words: Words, code: Code):
        hashes, n, docs = words.hashes(), len(words.starts), len(words.counts)
        self.unique, self.inverse = np.unique(hashes, return_inverse=True)
        found = look_up(code.words, self.unique)
        known = np.where(found >= 0, code.symbols[found] if len(code.symbols) else 0, code.escape)
        self.owners = words.owners()
        place = np.arange(n) + self.owners  # of words among tokens; ends fill the gaps
        ends = words.first[1:] + np.arange(docs)
        symbol = np.full(n + docs, code.end)
        symbol[place] = known[self.inverse]
        token = np.full(n + docs, _END_HASH)
        token[place] = hashes
        first = np.zeros(n + docs, dtype=bool)
        first[ends[:-1] + 1] = True
        if docs:
            first[0] = True
        last1 = np.empty_like(token)
        last1[1:] = token[:-1]
        last1[first] = _BEGIN_HASH
        last2 = np.empty_like(token)
        last2[1:] = last1[:-1]
        last2[first] = _BEGIN_HASH

        # of each token, the last marker before it in its text
        seen = np.where(symbol < code.markers, np.arange(n + docs), -1)
        latest = np.maximum.accumulate(np.concatenate([[-1], seen[:-1]])) if n + docs else seen
        begins = np.repeat(np.flatnonzero(first), words.counts + 1)
        marker = np.where(latest >= begins, token[np.maximum(latest, 0)], _BEGIN_HASH)

        self.symbol = symbol
        self.context = np.empty((WORD_TABLES, n + docs), dtype=np.uint32)
        self.context[0] = marker >> np.uint64(32)
        self.context[1] = last1 >> np.uint64(32)
        self.context[2] = mix(last1 * np.uint64(3) + last2) >> np.uint64(32)
        self.escaped = np.flatnonzero(symbol[place] == code.escape)  # among the words
        self._walk(code)
        self.offsets = self.ends_at[np.concatenate([[0], ends + 1])]  # of each text among the decisions


class Spelling(_Steps):
    """The bytes of a batch of words, each closed by a blank."""

    def __init__(self, words: Words, code: Code):
        size = np.diff(words.offsets) + 1
        first = np.cumsum(size) - size
        inside = np.arange(int(size.sum())) - np.repeat(first, size)
        begin = np.repeat(words.offsets[:-1], size)
        at = begin + inside
        padded = np.concatenate([words.data, np.zeros(1, np.uint8)])
        self.symbol = np.where(inside + 1 == np.repeat(size, size), 32, padded[at].astype(np.int64))

        def before(k: int) -> np.ndarray:
            byte = np.where(inside >= k, padded[np.maximum(at - k, 0)], np.uint8(0))
            return byte.astype(np.uint32) << np.uint32(8 * (k - 1))

        self.context = np.empty((SPELL_TABLES, len(at)), dtype=np.uint32)
        self.context[0] = before(1)
        for k in (1, 2, 3):
            self.context[k] = self.context[k - 1] | before(k + 1)
        self.context[4] = words.spans(begin, at) >> np.uint64(32)
        self._walk(code)
        self.offsets = self.ends_at[np.concatenate([[0], np.cumsum(size)])]


def gates(longer: np.ndarray, longest: np.ndarray) -> np.ndarray:
    """Gate by how sure two predictors are."""
    out = np.zeros(longest.shape, dtype=np.int8)
    for odds, factor in ((longer, 4), (longest, 1)):
        sure = np.abs(odds)
        for edge in (0.05, 1.5, 3.5):
            out += (sure > np.float32(edge)).view(np.int8) * np.int8(factor)
    return out


def start_weights() -> np.ndarray:
    """Weights of a document's first decisions: where the longer contexts are unsure, shorter ones weigh more."""
    gate = np.arange(GATES)[:, None]
    short = 1 + 0.1 * ((gate % 4 == 0) + 0.5 * (gate < 4))
    return (START * np.where(np.arange(len(START)) < 2, short, 1 / short)).astype(np.float32)


@dataclass
class Model:
    code: Code
    tables: np.ndarray  # log odds: predictors x slots
    base_words: np.ndarray  # sorted hashes
    base_logs: np.ndarray  # log10 of their base probability
    spelled: np.ndarray  # natural log of their probability once escaped
    end_log: float
    end_known: bool


def score_batch(decisions: Decisions, model: Model) -> np.ndarray:
    """Natural log probability of the decisions of each text, weights refined online within the text."""
    counts = np.diff(decisions.offsets)
    blocks = -(-counts // STEP)
    row = np.concatenate([[0], np.cumsum(blocks)])  # first block of each text
    log = int(model.tables.shape[1]).bit_length() - 1
    flat = np.zeros((WORD_TABLES + 3, int(row[-1]) * STEP), dtype=np.float32)  # log odds, mixed, sign
    odds = np.empty((WORD_TABLES + 1, len(decisions.path)), dtype=np.float32)
    odds[0] = model.code.odds[decisions.path]
    for k in range(WORD_TABLES):
        odds[k + 1] = model.tables[k][decisions.slots(k, log)]
    start = start_weights()
    gate = gates(odds[-2], odds[-1])
    mixed = odds[0] * start[gate, 0]
    for k in range(1, WORD_TABLES + 1):
        mixed += odds[k] * start[gate, k]
    sign = decisions.outcome.astype(np.float32) * 2 - 1
    for values, to in zip((*odds, mixed, sign), flat):
        for text, (low, high) in enumerate(zip(decisions.offsets[:-1].tolist(), decisions.offsets[1:].tolist())):
            place = int(row[text]) * STEP
            to[place : place + high - low] = values[low:high]
    flat = flat.reshape(len(flat), -1, STEP)  # where texts are filled up, sign is 0: no cost, no push
    own = np.zeros((len(counts), WORD_TABLES + 1), dtype=np.float32)
    out = np.zeros(len(counts))
    order = np.argsort(-blocks, kind="stable")
    going = np.searchsorted(-blocks[order], -np.arange(int(blocks.max(initial=0))), side="left")
    for turn, many in enumerate(going.tolist()):
        who = order[:many]
        some = flat[:, row[who] + turn]
        near, signs = some[: WORD_TABLES + 1], some[-1]
        x = some[-2] + np.einsum("kdb,dk->db", near, own[who])
        x *= signs
        np.clip(x, -16, 16, out=x)
        against = np.exp(-x)  # odds of the other outcome
        total = against + np.float32(1)
        # four factors of at most 1 + e**16 fit a float
        four = total[:, 0::4] * total[:, 1::4] * total[:, 2::4] * total[:, 3::4]
        filling = np.maximum(STEP * (turn + 1) - counts[who], 0) * np.log(2.0)
        out[who] -= np.log(four).sum(axis=1, dtype=np.float64) - filling
        against /= total
        against *= signs
        own[who] += np.float32(ONLINE_RATE / STEP) * np.einsum("kdb,db->dk", near, against)
    return out


def repeats(owners: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of escaped words in order: whether each is new to its text, and the natural log of that decision and choice."""
    n = len(hashes)
    order = np.lexsort((np.arange(n), hashes, owners))
    fresh = np.ones(n, dtype=bool)
    fresh[order[1:]] = (hashes[order[1:]] != hashes[order[:-1]]) | (owners[order[1:]] != owners[order[:-1]])
    begin = np.searchsorted(owners, owners)  # first escaped word of the text
    before = np.arange(n) - begin
    total = np.concatenate([[0], np.cumsum(fresh)])
    different = total[:-1] - total[begin]
    again = (before - different + REPEATS) / (before + ESCAPES)
    again = np.where(different > 0, again, 0.0)
    cost = np.where(fresh, np.log1p(-again), np.log(np.where(fresh, 1.0, again)) - np.log(np.maximum(different, 1)))
    return fresh, cost


def cell_marks(tables: np.ndarray) -> np.ndarray:
    """For every log odds its cell along one predictor."""
    out = np.empty(tables.shape, dtype=np.uint8)
    for k in range(len(tables)):
        row = tables[k].astype(np.float32)
        out[k] = np.searchsorted(CELL_EDGES, np.abs(row)) * 2 + (row < 0)
    return out


def add_cells(cells: np.ndarray, steps: Spelling, tables: np.ndarray, marks: np.ndarray) -> None:
    """Add the decisions to ``cells``: rows of zeros, ones and the log odds of each predictor."""
    log = int(tables.shape[1]).bit_length() - 1
    cell = np.zeros(len(steps.path), dtype=np.int64)
    values = []
    for k in range(SPELL_TABLES):
        slots = steps.slots(k, log)
        cell = cell * MARKS + marks[k][slots]
        values.append(tables[k][slots])
    unique, cell = np.unique(cell, return_inverse=True) if 16 * len(cell) < len(cells[0]) else (slice(None), cell)
    n = len(cells[0][unique])
    ones = np.bincount(cell, weights=steps.outcome, minlength=n)
    cells[0][unique] += np.bincount(cell, minlength=n) - ones
    cells[1][unique] += ones
    for k in range(SPELL_TABLES):
        cells[2 + k][unique] += np.bincount(cell, weights=values[k], minlength=n)


def fit_gate_weights(cells: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Logistic regression of outcomes on the mean log odds of cells for each gate, by Newton steps."""
    start = 1.2 / SPELL_TABLES
    weights = np.full((GATES, SPELL_TABLES), start)
    n = cells[0] + cells[1]
    rows = (cells[2:] / n).T
    gate = gates(rows[:, 2].astype(np.float32), rows[:, 4].astype(np.float32))
    for g in range(GATES):
        mine = np.flatnonzero(gate == g)
        x, y, m, w = rows[mine], cells[1][mine], n[mine], weights[g]
        for _ in range(rounds if len(mine) else 0):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -20, 20)))
            slope = x.T @ (y - m * p) - 2.0 * (w - start)
            curve = (x * (m * p * (1 - p))[:, None]).T @ x + 2.0 * np.eye(SPELL_TABLES)
            w = w + np.clip(np.linalg.solve(curve, slope), -0.5, 0.5)
        weights[g] = np.clip(w, -0.5, 2.0)
    return weights


def spell_batch(steps: Spelling, tables: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Natural log probability of the spelling of each word."""
    log = int(tables.shape[1]).bit_length() - 1
    odds = [tables[k][steps.slots(k, log)].astype(np.float32) for k in range(SPELL_TABLES)]
    gate = gates(odds[2], odds[4])
    x = sum(odds[k] * weights[:, k].astype(np.float32)[gate] for k in range(SPELL_TABLES))
    x *= steps.outcome.astype(np.float32) * 2 - 1
    cost = np.log1p(np.exp(-np.clip(x, -16, 16))).astype(np.float64)
    total = np.concatenate([[0.0], np.cumsum(cost)])
    return -np.diff(total[steps.offsets])


def _pieces(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    old = texts.SLICE_BYTES
    texts.SLICE_BYTES = PIECE_BYTES
    try:
        yield from texts.slices(batch, column)
    finally:
        texts.SLICE_BYTES = old


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[int, list] = {}

    def packed() -> pa.RecordBatch:
        rows = list(counts.values())
        counts.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64())], names=["word", "n"]
        )

    for batch in batches:
        for piece in texts.slices(batch):
            words = Words(*buffers(piece.column("text")))
            unique, first, inverse = np.unique(words.hashes(), return_index=True, return_inverse=True)
            learned = piece.column("learned").to_numpy(zero_copy_only=False).astype(bool)[words.owners()]
            n = np.bincount(inverse[learned], minlength=len(unique))
            raw = words.data.tobytes()
            starts, ends = words.starts[first].tolist(), words.ends[first].tolist()
            for h, a, b, c in zip(unique.tolist(), starts, ends, n.tolist()):
                row = counts.get(h)
                if row is None:
                    counts[h] = [raw[a:b], c]
                else:
                    row[1] += c
        if len(counts) > 200_000:
            yield packed()
    yield packed()


def _folds(piece: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    for fold in (0, 1):
        part = piece.filter(pc.equal(piece.column("fold"), fold))
        if part.num_rows:
            yield fold, part


def _spelled(piece: pa.RecordBatch, code: Code) -> Spelling:
    return Spelling(Words(*buffers(piece.column("word")), lower=False), code)


def _gather(shared, kind: str, log: int):
    """Counts of a task over its documents (``kind`` text) or distinct words (``kind`` word), by fold."""
    names = ["predictor", "block", "part", "fold", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = shared.value
        many = (1, WORD_TABLES) if kind == "text" else (2, SPELL_TABLES)
        counts = np.zeros((*many, 2 << log), dtype=np.int32)
        part = TaskContext.get().partitionId()
        width = 2 * TABLE_BLOCK

        def packed() -> Iterator[pa.RecordBatch]:
            for fold, k in np.ndindex(*many):
                rows = counts[fold, k].reshape(-1, width)
                used = np.flatnonzero(rows.any(axis=1))
                for low in range(0, len(used), 64):
                    some = used[low : low + 64]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(some), k, np.int32)),
                            pa.array(some.astype(np.int32)),
                            pa.array(np.full(len(some), part, np.int64)),
                            pa.array(np.full(len(some), fold, np.int32)),
                            pa.array([rows[b].tobytes() for b in some], pa.binary()),
                        ],
                        names=names,
                    )

        held = 0
        for batch in batches:
            for fold, piece in (x for piece in _pieces(batch, kind) for x in _folds(piece)):
                if kind == "text":
                    steps = Decisions(Words(*buffers(piece.column("text"))), code)
                else:
                    steps = _spelled(piece, code)
                if held + len(steps.path) > COUNTED_AT_A_TIME:
                    yield from packed()
                    counts[:] = 0
                    held = 0
                held += len(steps.path)
                for k in range(many[1]):
                    at = steps.slots(k, log).astype(np.int64) * 2 + steps.outcome
                    np.add.at(counts[fold, k], at, np.int32(1))
        yield from packed()

    return run


def _counts(raw: bytes) -> np.ndarray:
    """Counts of a block: 32 bits as a task gathers them, 64 bits once added up."""
    return np.frombuffer(raw, dtype=np.int32 if len(raw) == 8 * TABLE_BLOCK else np.int64)


def _add_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums, in 64 bits, of the blocks of each key; rows come sorted by key."""
    names = ["predictor", "block", "part", "fold", "counts"]
    key, total = None, None

    def packed() -> pa.RecordBatch:
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((*key, total.tobytes()), kinds)], names=names)

    for batch in batches:
        keys = zip(*[batch.column(c).to_pylist() for c in names[:4]])
        for new, raw in zip(keys, batch.column("counts")):
            row = _counts(raw.as_py())
            if new != key:
                if key is not None:
                    yield packed()
                key, total = new, row.astype(np.int64)
            else:
                total += row
    if key is not None:
        yield packed()


def _summed_tables(gathered: DataFrame, parts: int, tables: int, log: int) -> np.ndarray:
    """Log odds of every slot by all counts and by those of each fold; tables of many tasks are added in rounds of at most 64."""
    while True:
        parts = -(-parts // 64)
        dealt = gathered.withColumn("part", F.floor(F.col("part") / 64)).repartition("predictor", "block", "part")
        gathered = dealt.sortWithinPartitions("predictor", "block", "part", "fold").mapInArrow(_add_blocks, gathered.schema)
        if parts <= 1:
            break
    out = np.zeros((3, tables, 1 << log), dtype=np.float16)
    for row in gathered.mapInArrow(_odds, "predictor int, block int, odds binary").toLocalIterator():
        odds = np.frombuffer(row.odds, dtype=np.float16).reshape(3, TABLE_BLOCK)
        out[:, row.predictor, row.block * TABLE_BLOCK : (row.block + 1) * TABLE_BLOCK] = odds
    return out


def _odds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Log odds of the blocks by all counts, those of fold 0 and of fold 1; rows come sorted by predictor and block."""
    key, folds = None, np.zeros((2, TABLE_BLOCK, 2), dtype=np.int64)

    def packed() -> pa.RecordBatch:
        counts = np.stack([folds[0] + folds[1], *folds])
        odds = np.log((counts[..., 1] + 0.4) / (counts[..., 0] + 0.4)).astype(np.float16).tobytes()
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([odds], pa.binary())],
            names=["predictor", "block", "odds"],
        )

    for batch in batches:
        for *new, fold, raw in zip(*[batch.column(c).to_pylist() for c in ("predictor", "block", "fold", "counts")]):
            if new != key:
                if key is not None:
                    yield packed()
                key = new
                folds[:] = 0
            folds[fold] += _counts(raw).reshape(-1, 2)
    if key is not None:
        yield packed()


_CELL = ["cell", "zeros", "ones", *[f"odds{k}" for k in range(SPELL_TABLES)]]


def _calibrate(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, tables = shared.value
        marks = [cell_marks(t) for t in tables]
        cells = np.zeros((2 + SPELL_TABLES, CELLS))
        for batch in batches:
            for fold, piece in (x for piece in _pieces(batch, "word") for x in _folds(piece)):
                add_cells(cells, _spelled(piece, code), tables[1 - fold], marks[1 - fold])
        used = np.flatnonzero(cells[0] + cells[1])
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), *[pa.array(c[used]) for c in cells]], names=_CELL)

    return run


def _spell(shared, escaped: int, new: float):
    """Words with the natural log of their probability once an escape has been read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, tables, weights, vocabulary = shared.value
        for batch in batches:
            for piece in _pieces(batch, "word"):
                words = Words(*buffers(piece.column("word")), lower=False)
                log = spell_batch(Spelling(words, code), tables, weights)
                n = np.asarray(piece.column("n"), dtype=np.float64)
                with np.errstate(divide="ignore"):
                    counted = np.log((1 - new) * n / max(escaped, 1))
                log = np.logaddexp(log + np.log(new), counted)
                log[look_up(vocabulary, words.hashes()) >= 0] = 0  # never escaped
                yield pa.RecordBatch.from_arrays([piece.column("word"), piece.column("n"), pa.array(log)], names=["word", "n", "spelled"])

    return run


_SCORED = "row_id long, doc_id long, n_tokens long, n_known long, base double, score double, n_bytes long, others array<binary>"


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for piece in _pieces(batch):
                words = Words(*buffers(piece.column("text")))
                decisions = Decisions(words, model.code)
                found = look_up(model.base_words, decisions.unique)[decisions.inverse]
                owners, docs = decisions.owners, len(words.counts)
                hit = found >= 0
                base = np.bincount(owners[hit], weights=model.base_logs[found[hit]], minlength=docs) + model.end_log
                known = np.bincount(owners[hit], minlength=docs) + model.end_known
                escaped = decisions.escaped
                fresh, cost = repeats(owners[escaped], decisions.inverse[escaped])
                here = fresh & hit[escaped]  # the other new ones are joined
                cost[here] += model.spelled[found[escaped[here]]]
                log = score_batch(decisions, model) + np.bincount(owners[escaped], weights=cost, minlength=docs)
                raw = words.data.tobytes()
                others: list[list[bytes]] = [[] for _ in range(docs)]
                for w in np.flatnonzero(~hit).tolist():
                    others[owners[w]].append(raw[words.starts[w] : words.ends[w]])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + docs)),
                        piece.column("doc_id"),
                        pa.array(words.counts + 1),
                        pa.array(known.astype(np.int64)),
                        pa.array(base),
                        pa.array(log / np.log(10)),
                        pa.array(np.diff(words.offsets)),
                        pa.array(others, pa.list_(pa.binary())),
                    ],
                    names=[c.split()[0] for c in _SCORED.split(", ")],
                )
                row += docs

    return run


def _most_frequent(words: DataFrame, most: int) -> DataFrame:
    """Training words of the highest counts: whole levels of equal count while they are at most ``most`` words."""
    met = words.where("n > 0")
    levels = met.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.col("n").desc()).limit(most).collect()
    enough, least = 0, None
    for level in levels:
        if enough + level.words > most:
            break
        enough, least = enough + level.words, level.n
    return words.where(F.col("n") >= F.lit(least)) if least is not None else words.limit(0)


def _hashes(column: pa.ChunkedArray) -> np.ndarray:
    data, offsets = buffers(column.combine_chunks() if len(column) else pa.array([], pa.binary()))
    return Words(data, offsets, lower=False).spans(offsets[:-1], offsets[1:])


def _slots_log(size: int) -> int:
    return min(max(int(size // BYTES_A_SLOT).bit_length(), SLOTS_LOG[0]), SLOTS_LOG[1])


def fit_spelling(words: DataFrame, distinct: int) -> tuple[Code, np.ndarray, np.ndarray]:
    """Tree, tables and gate weights of the spelling, counted over the distinct training words."""
    context = words.sparkSession.sparkContext
    code = spelling_code()
    log = SPELL_SLOTS_LOG
    folded = words.where("n > 0").select("word", F.xxhash64(F.lit(11), "word").bitwiseAND(1).cast("int").alias("fold"))
    parts = distinct // TRAIN_WORDS + 1
    gathered = folded.coalesce(parts).mapInArrow(_gather(context.broadcast(code), "word", log), _GATHERED)
    tables, *fold_tables = _summed_tables(gathered, parts, SPELL_TABLES, log)
    shared = context.broadcast((code, fold_tables))
    counted = folded.mapInArrow(_calibrate(shared), "cell int, " + ", ".join(f"{c} double" for c in _CELL[1:]))
    summed = counted.groupBy("cell").agg(*[F.sum(c).alias(c) for c in _CELL[1:]]).orderBy("cell").toArrow()
    shared.unpersist()
    return code, tables, fit_gate_weights(np.stack([np.asarray(summed.column(c), dtype=np.float64) for c in _CELL[1:]]))


_GATHERED = "predictor int, block int, part long, fold int, counts binary"


def fit_model(docs: DataFrame, vocabulary: int = VOCABULARY, base_words: int = BASE_WORDS) -> tuple[Model, DataFrame, int, int]:
    """The model, the table (word, n, spelled) of all words, and N and V of the training tokens."""
    context = docs.sparkSession.sparkContext
    learned = documents_view(docs).select("text", (~held_out(F.col("doc_id"))).alias("learned"))
    train = learned.where("learned")
    ends, size = train.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()

    counted = learned.mapInArrow(_count_words, "word binary, n long")
    words = stage(counted.groupBy("word").agg(F.sum("n").alias("n")), "lm-words")
    distinct, total, once = words.where("n > 0").agg(
        F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") == 1, 1))
    ).first()

    table = _most_frequent(words.where(F.col("n") >= LEAST_COUNT), vocabulary).toArrow()
    table = table.sort_by([("n", "descending"), ("word", "ascending")])
    coded = np.asarray(table.column("n"), dtype=np.int64)
    escaped = int(total - coded.sum())
    code = make_code(_hashes(table.column("word")), coded.tolist(), escaped, ends)

    spelling = fit_spelling(words, distinct)
    new = (once + 0.5) / (escaped + 0.5)
    shared = context.broadcast((*spelling, code.words))
    spell = _spell(shared, escaped, min(new, 0.98) if escaped else 1.0)
    words = stage(words.mapInArrow(spell, "word binary, n long, spelled double"), "lm-spelled")
    shared.unpersist()

    log, parts = _slots_log(size), int(size // TRAIN_BYTES) + 1
    gather = _gather(context.broadcast(code), "text", log)
    gathered = train.select("text", F.lit(0).alias("fold")).coalesce(parts).mapInArrow(gather, _GATHERED)
    tables = _summed_tables(gathered, parts, WORD_TABLES, log)[0]

    total, distinct = total + ends, distinct + (ends > 0)
    table = _most_frequent(words, base_words).toArrow()
    hashes = _hashes(table.column("word"))
    order = np.argsort(hashes, kind="stable")
    scale = np.log10(total + distinct + 1)
    model = Model(
        code,
        tables,
        hashes[order],
        np.log10(np.asarray(table.column("n"), dtype=np.int64)[order] + 1) - scale,
        np.asarray(table.column("spelled"), dtype=np.float32)[order],
        float(np.log10(ends + 1) - scale),
        bool(ends),
    )
    return model, words, int(total), int(distinct)


def lm_scores(docs: DataFrame, vocabulary: int = VOCABULARY, base_words: int = BASE_WORDS) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    spark = docs.sparkSession
    bounded_batches(spark)
    model, words, total, distinct = fit_model(docs, vocabulary, base_words)
    scored = stage(documents_view(docs).mapInArrow(_score(spark.sparkContext.broadcast(model)), _SCORED), "lm-scored")
    # words beyond the carried ones: counted per document, then joined; coded words are never spelled
    others = scored.select("row_id", F.explode("others").alias("word")).groupBy("row_id", "word").agg(F.count(F.lit(1)).alias("times"))
    logs = F.log10((F.col("n") + 1) / F.lit(float(total + distinct + 1)))
    joined = others.join(words, "word").groupBy("row_id").agg(
        F.sum(F.col("times") * logs).alias("more"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more_known"),
        (F.sum("spelled") / float(np.log(10))).alias("more_spelled"),
    )
    score = F.col("score") + F.coalesce("more_spelled", F.lit(0.0))
    return scored.drop("others").join(joined, "row_id", "left").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        score.alias("score"),
        (-score * float(np.log2(10)) / F.greatest(F.col("n_bytes"), F.lit(1))).alias("bits_per_byte"),
    )
