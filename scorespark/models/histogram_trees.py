"""Boosted and bagged trees whose fit does not depend on how the rows are partitioned.

Features are cut at exact quantiles, so a row is a byte per feature; some thousand rows
are one row of the binned table, a line of bytes per feature. Each level of a tree is
one pass: every task adds up the gradients of its rows by (tree, node, feature, bin),
the tasks' cells are summed, and the driver, which sees cells only, picks the splits. Of two
siblings that may split on the same features only the smaller is counted; the other is the
rest of the parent. Gradients are whole multiples of ``1 / SCALE``, so the sums are exact in
any order, and row samples come from a hash of (key, tree): the same rows give the
same trees on any number of partitions, cores or files.

Boosting follows the second-order logistic loss with leaf penalties L1 and L2, a least
curvature per child, and samples of rows and of columns per tree. Bagging weighs
rows by Poisson counts and tries a random part of the columns at each node. Ties
of gain go to the first feature and the lowest cut.

Rows with a missing feature or label take no part. Without rows, or with one class only,
the result is a single leaf.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from math import ceil, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorespark.models.trees import Trees
from scorespark.operators.quantiles import exact_quantiles
from scorespark.session import drop_table, stage, stage_at
from scorespark.spec import RANDOM_STATE

BINS = 32
SCALE = 1 << 20
#: Rows a task counts at least, so that small tables are not cut into many small tasks.
ROWS_A_TASK = 20_000
#: Rows a task counts at most; in between there is a task per core.
MOST_A_TASK = 2_000_000
#: Tasks whose cells the driver adds up; those of more tasks meet in an aggregation.
TASKS = 64
#: Trees after which the margins of the rows are written down.
MARGINS_EVERY = 5
#: Bagged trees that grow side by side.
TREES_AT_ONCE = 10
#: Rows whose cells are added up as one piece at most; a sum of so many packed weights is exact as a double.
PIECE = 1 << 14
#: Place of the counts in a packed weight.
PACK = float(1 << 37)


@dataclass
class Growing:
    """A tree over bins; node 0 is the root, ``at`` is -1 in leaves. Bins up to the cut go left."""

    number: int
    at: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])
    sums: list[tuple[float, float]] = field(default_factory=lambda: [(0.0, 0.0)])

    def split(
        self, node: int, feature: int, cut: int, values: tuple[float, float], sums: Sequence[tuple[float, float]]
    ) -> tuple[int, int]:
        self.at[node], self.cut[node] = feature, cut
        self.left[node], self.right[node] = len(self.at), len(self.at) + 1
        self.sums += [(float(g), float(h)) for g, h in sums]
        for value in values:
            self.at.append(-1)
            self.cut.append(0)
            self.left.append(-1)
            self.right.append(-1)
            self.value.append(value)
        return self.left[node], self.right[node]

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row; ``bins`` has a line per feature."""
        at, cut, left, right = (np.array(x, dtype=np.int32) for x in (self.at, self.cut, self.left, self.right))
        node = np.zeros(bins.shape[1], dtype=np.int32)
        inner = np.arange(len(node)) if at[0] >= 0 else np.zeros(0, dtype=np.int64)
        while len(inner):
            here = node[inner]
            here = np.where(bins[at[here], inner] <= cut[here], left[here], right[here])
            node[inner] = here
            inner = inner[at[here] >= 0]
        return node

    def members(self, bins: np.ndarray, rows: np.ndarray) -> dict[int, np.ndarray]:
        """The given rows by the leaf each is in."""
        found, ahead = {}, [(0, rows)]
        while ahead:
            node, mine = ahead.pop()
            if self.at[node] < 0:
                found[node] = mine
                continue
            goes_left = bins[self.at[node]][mine] <= self.cut[node]
            ahead += [(self.left[node], mine[goes_left]), (self.right[node], mine[~goes_left])]
        return found


def row_words(keys: np.ndarray, number: int, seed: int) -> np.ndarray:
    """64 even bits for each key hash and number."""
    salt = (seed * 0x9E3779B97F4A7C15 + number * 0xD1B54A32D192ED03) % (1 << 64)
    x = keys.view(np.uint64) ^ np.uint64(salt)
    for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def uniform(keys: np.ndarray, number: int, seed: int) -> np.ndarray:
    """A number in [0, 1) for each key hash and tree."""
    return (row_words(keys, number, seed) >> np.uint64(11)) / float(1 << 53)


def poisson_counts(u: np.ndarray) -> np.ndarray:
    """Counts of mean 1 from uniform numbers; nine and more are nine."""
    chances = np.cumsum([np.exp(-1.0) / np.prod(np.arange(1, k + 1, dtype=float)) for k in range(9)])
    found = np.zeros(len(u), dtype=np.int8)
    for chance in chances:
        found += u >= chance
    return found.astype(np.int64)


@dataclass(frozen=True)
class Boosting:
    """Gradient and curvature of the logistic loss at the margin so far, on a sample of the rows."""

    rate: float
    rows: float
    alpha: float
    lam: float
    least: float
    seed: int
    #: Whole steps of a gradient when curvatures are counts; None when they are not.
    unit = None

    def weights(self, keys: np.ndarray, y: np.ndarray, margin: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-margin))
        taken = uniform(keys, number, self.seed) < self.rows
        return np.rint((p - y) * SCALE) * taken, np.rint(p * (1 - p) * SCALE) * taken

    def gain(self, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        return np.maximum(np.abs(g) - self.alpha, 0) ** 2 / (h + self.lam)

    def leaf(self, g: float, h: float) -> float:
        return -self.rate * float(np.sign(g) * max(abs(g) - self.alpha, 0.0) / (h + self.lam)) if h + self.lam else 0.0


@dataclass(frozen=True)
class Bagging:
    """Labels and counts of rows drawn with replacement; gains are those of the Gini index."""

    least: float
    seed: int
    unit = SCALE

    def weights(self, keys: np.ndarray, y: np.ndarray, margin: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
        n = poisson_counts(uniform(keys, number, self.seed)) * float(SCALE)
        return y * n, n

    def gain(self, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        return g**2 / np.where(h > 0, h, 1.0)

    def leaf(self, g: float, h: float) -> float:
        return float(g / h) if h else 0.0


Loss = Boosting | Bagging
#: Open nodes of a growing tree and the features each may split.
Open = dict[int, np.ndarray]


PIECES = "h binary, y binary, margin binary, bins binary"


def _piece(keys: np.ndarray, y: np.ndarray, margin: np.ndarray, bins: np.ndarray) -> pa.RecordBatch:
    parts = [pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in (keys, y, margin, bins)]
    return pa.RecordBatch.from_arrays(parts, names=["h", "y", "margin", "bins"])


def _binned(edges: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, PIECE):
                batch = whole.slice(first, PIECE)
                bins = np.empty((len(edges), batch.num_rows), dtype=np.uint8)
                for k, e in enumerate(edges):
                    bins[k] = np.searchsorted(e, np.asarray(batch.column(f"f{k}")), side="left")
                yield _piece(np.asarray(batch.column("h")), np.asarray(batch.column("y")), np.zeros(batch.num_rows), bins)

    return run


def _pieces(batches: Iterator[pa.RecordBatch], later: Sequence[Growing]) -> Iterator[tuple[np.ndarray, ...]]:
    """Key hashes, labels, margins after the ``later`` trees, and bins of each piece."""
    for batch in batches:
        for k in range(batch.num_rows):
            keys, y, margin, bins = (batch.column(c)[k].as_buffer() for c in ("h", "y", "margin", "bins"))
            keys, y = np.frombuffer(keys, dtype=np.int64), np.frombuffer(y)
            margin, bins = np.frombuffer(margin).copy(), np.frombuffer(bins, dtype=np.uint8).reshape(-1, len(y))
            for tree in later:
                margin += np.array(tree.value)[tree.leaves(bins)]
            yield keys, y, margin, bins


def _sums(loss: Loss, weights: list[np.ndarray], tree: Growing, counted: Open, bins: np.ndarray) -> np.ndarray:
    """Sums by (node, tried feature, bin) of the nodes ``counted``, from the rows of a piece.

    Nodes that share their features are counted side by side, others one by one from the rows in them.
    """
    width = len(next(iter(counted.values())))
    weighed = weights[-1] != 0
    same = {tuple(features) for features in counted.values()}
    if len(same) == 1 and len(counted) > 1:
        node = tree.leaves(bins)
        places = np.full(len(tree.at), -1)
        places[list(counted)] = np.arange(len(counted))
        mine = np.flatnonzero((places[node] >= 0) & weighed)
        weights = [w[mine] for w in weights]
        size = len(counted) * BINS
        found = np.empty((len(weights), width, size))
        first = places[node[mine]] * BINS
        for j, f in enumerate(next(iter(same))):
            cell = first + bins[f][mine]
            for k, w in enumerate(weights):
                found[k, j] = np.bincount(cell, weights=w, minlength=size)
        found = found.reshape(len(weights), width, -1, BINS).swapaxes(1, 2)
    else:
        rows = tree.members(bins, np.flatnonzero(weighed))
        found = np.empty((len(weights), len(counted), width, BINS))
        for place, (node, features) in enumerate(counted.items()):
            mine = rows[node]
            own = [w[mine] for w in weights]
            for j, f in enumerate(features):
                line = bins[f][mine]
                for k, w in enumerate(own):
                    found[k, place, j] = np.bincount(line, weights=w, minlength=BINS)
    if loss.unit is None:
        return found.astype(np.int64)
    n = np.rint(found[0] / PACK)
    return np.array([(found[0] - n * PACK) * loss.unit, n * SCALE]).astype(np.int64)


def _cells(loss: Loss, later: Sequence[Growing], growing: Sequence[tuple[Growing, Open]], width: int):
    """Sums of a task's gradients and curvatures by cell; cells of a node are ``width`` features of ``BINS`` bins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((2, len(counted), width, BINS), dtype=np.int64) for _, counted in growing]
        for keys, y, margin, bins in _pieces(batches, later):
            for (tree, counted), total in zip(growing, sums):
                if counted:
                    g, h = loss.weights(keys, y, margin, tree.number)
                    weights = [g, h] if loss.unit is None else [h / SCALE * PACK + g / loss.unit]
                    total += _sums(loss, weights, tree, counted, bins)
        both = np.concatenate(sums, axis=1).reshape(2, -1)
        used = np.flatnonzero(both[1])
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(both[0][used]), pa.array(both[1][used])], names=["cell", "g", "h"])

    return run


def _best(loss: Loss, g: np.ndarray, h: np.ndarray) -> tuple[int, int, np.ndarray, np.ndarray] | None:
    """Best (place of the feature, cut) of a node from its cells, with the sums of both sides."""
    left_g, left_h = np.cumsum(g, axis=1)[:, :-1], np.cumsum(h, axis=1)[:, :-1]
    total_g, total_h = g.sum(axis=1, keepdims=True), h.sum(axis=1, keepdims=True)
    right_g, right_h = total_g - left_g, total_h - left_h
    allowed = (left_h >= max(loss.least, 1 / SCALE)) & (right_h >= max(loss.least, 1 / SCALE))
    gain = loss.gain(left_g, left_h) + loss.gain(right_g, right_h) - loss.gain(total_g, total_h)
    gain = np.where(allowed, gain, -1.0)
    k, cut = np.unravel_index(int(np.argmax(gain)), gain.shape)
    if gain[k, cut] <= 1e-9:
        return None
    return int(k), int(cut), np.array([left_g[k, cut], right_g[k, cut]]), np.array([left_h[k, cut], right_h[k, cut]])


def split_node(loss: Loss, tree: Growing, node: int, features: np.ndarray, sums: np.ndarray) -> tuple[int, ...]:
    """Split a node by the sums of its cells; its children, or none."""
    g, h = sums
    if node == 0:
        tree.sums[0] = (float(g[0].sum()), float(h[0].sum()))
        tree.value[0] = loss.leaf(*tree.sums[0])
    found = _best(loss, g, h)
    if found is None:
        return ()
    place, cut, both_g, both_h = found
    values = tuple(loss.leaf(a, b) for a, b in zip(both_g, both_h))
    return tree.split(node, int(features[place]), cut, values, list(zip(both_g, both_h)))


def _grow(table: DataFrame, loss: Loss, later: Sequence[Growing], numbers: Sequence[int], depth: int, tried, many: bool) -> list[Growing]:
    """Trees grown side by side, one pass over the rows a level; ``tried(tree, node)`` are the features a node may split.

    With ``many`` tasks their cells meet in an aggregation before the driver sees them.
    """
    trees = [Growing(k) for k in numbers]
    opened: list[Open] = [{0: tried(tree.number, 0)} for tree in trees]
    width = len(opened[0][0])
    rest: list[dict[int, tuple[int, int]]] = [{} for _ in trees]  # node -> (parent, counted sibling)
    known: list[dict[int, np.ndarray]] = [{} for _ in trees]
    for _ in range(depth):
        counted = [{k: f for k, f in mine.items() if k not in others} for mine, others in zip(opened, rest)]
        nodes = sum(map(len, counted))
        if not nodes:
            break
        cells = table.mapInArrow(_cells(loss, later, list(zip(trees, counted)), width), "cell long, g long, h long")
        if many:
            cells = cells.groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
        found = cells.toArrow()
        sums = np.zeros((2, nodes * width * BINS), dtype=np.int64)
        for k, name in enumerate("gh"):
            np.add.at(sums[k], np.asarray(found.column("cell")), np.asarray(found.column(name)))
        sums = sums.reshape(2, nodes, width, BINS)
        at = 0
        for t, tree in enumerate(trees):
            cells_of = {k: sums[:, at + place] for place, k in enumerate(counted[t])}
            at += len(counted[t])
            cells_of |= {k: known[t][parent] - cells_of[sibling] for k, (parent, sibling) in rest[t].items()}
            children: Open = {}
            rest[t], known[t] = {}, cells_of
            for node, features in opened[t].items():
                both = split_node(loss, tree, node, features, cells_of[node] / SCALE)
                for child in both:
                    children[child] = tried(tree.number, child)
                if both and all(np.array_equal(children[child], features) for child in both):
                    less, more = sorted(both, key=lambda k: tree.sums[k][1])
                    rest[t][more] = (node, less)
            opened[t] = children
    return trees


def _grown(
    table: DataFrame, loss: Loss, start: Sequence[Growing], trees: int, at_once: int, depth: int, tried, adds_up: bool
) -> list[Growing]:
    """All trees of a fit; with ``adds_up`` each works on the margins the earlier ones leave."""
    grown, later, path = [], list(start), None
    many = table.rdd.getNumPartitions() > TASKS
    for first in range(0, trees, at_once):
        some = _grow(table, loss, later, range(first, min(trees, first + at_once)), depth, tried, many)
        grown += some
        if adds_up:
            later += some
            if len(later) > MARGINS_EVERY and first + at_once < trees:
                before = path
                table, path = stage_at(table.mapInArrow(_with_margins(later), PIECES), "margins")
                later = []
                if before:
                    drop_table(table.sparkSession, before)
    return grown


def _table(df: DataFrame, features: Sequence[str], label: str, key: str) -> tuple[DataFrame, list[np.ndarray]]:
    """The rows as (key hash, label, margin, bins), written once, and the cuts of each feature."""
    values = [F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(f"f{k}") for k, c in enumerate(features)]
    plain = df.select(F.xxhash64(key).alias("h"), F.col(label).cast("double").alias("y"), *values).na.drop()
    places = [k / BINS for k in range(1, BINS)]
    found = exact_quantiles(plain, {f"f{k}": places for k in range(len(features))})
    edges = [np.unique([e for e in found[f"f{k}"] if e is not None]) for k in range(len(features))]
    return _dealt(stage(plain.mapInArrow(_binned(edges), PIECES), "binned")), edges


def _counted(table: DataFrame) -> tuple[int, int]:
    """Rows and rows with label 1 of a binned table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [(len(y), int(y.sum())) for _, y, _, _ in _pieces(batches, [])]
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["n", "bad"])

    n, bad = table.select("h", "y", "margin", "bins").mapInArrow(run, "n long, bad long").agg(F.sum("n"), F.sum("bad")).first()
    return n or 0, bad or 0


def _dealt(table: DataFrame) -> DataFrame:
    """The pieces in a task per core, with bounds on a task's rows."""
    n, _ = _counted(table)
    cores = table.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(n // ROWS_A_TASK, cores), -(-n // MOST_A_TASK))
    return stage(table.repartition(parts), "dealt")


def _with_margins(later: Sequence[Growing]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _pieces(batches, later):
            yield _piece(*piece)

    return run


def _as_trees(grown: Sequence[Growing], edges: list[np.ndarray], features: Sequence[str], weight: float, logit: bool) -> Trees:
    roots, at, threshold, left, right, value = [], [], [], [], [], []
    for tree in grown:
        first = len(at)
        roots.append(first)
        at += tree.at
        threshold += [float(edges[f][c]) if f >= 0 else 0.0 for f, c in zip(tree.at, tree.cut)]
        left += [first + k if k >= 0 else -1 for k in tree.left]
        right += [first + k if k >= 0 else -1 for k in tree.right]
        value += [v * weight if f < 0 else 0.0 for f, v in zip(tree.at, tree.value)]
    return Trees(tuple(features), *map(tuple, (roots, at, threshold, left, right, value)), logit)


def fit_boosted_trees(
    df: DataFrame,
    features: Sequence[str],
    label: str = "bad",
    key: str = "dummy_id",
    trees: int = 100,
    depth: int = 4,
    rate: float = 0.1,
    rows: float = 0.8,
    columns: float = 0.8,
    alpha: float = 0.0,
    lam: float = 1.0,
    least: float = 1.0,
    seed: int = RANDOM_STATE,
) -> Trees:
    """Boosting from the log odds of all rows; ``alpha`` and ``lam`` are the L1 and L2 penalties of leaves.

    ``rows`` and ``columns`` are the parts sampled for each tree, ``least`` the least curvature of a child.
    """
    table, edges = _table(df, features, label, key)
    n, bad = _counted(table)
    start = Growing(-1)
    start.value[0] = log(bad / (n - bad)) if n and 0 < bad < n else 0.0 if not n else (-16.0, 16.0)[bad > 0]
    grown = [start]
    if n and 0 < bad < n:
        width = ceil(columns * len(features))

        def tried(number: int, _: int) -> np.ndarray:
            return np.sort(np.random.default_rng([seed, number]).permutation(len(features))[:width])

        grown += _grown(table, Boosting(rate, rows, alpha, lam, least, seed), [start], trees, 1, depth, tried, True)
    return _as_trees(grown, edges, features, 0.5, True)


def fit_bagged_trees(
    df: DataFrame,
    features: Sequence[str],
    label: str = "bad",
    key: str = "dummy_id",
    trees: int = 100,
    depth: int = 5,
    min_leaf: int = 1,
    seed: int = RANDOM_STATE,
) -> Trees:
    """A forest on rows drawn with replacement; every node tries sqrt(features) columns of its own."""
    table, edges = _table(df, features, label, key)
    width = max(1, int(sqrt(len(features))))

    def tried(number: int, node: int) -> np.ndarray:
        return np.sort(np.random.default_rng([seed, number, node]).permutation(len(features))[:width])

    grown = _grown(table, Bagging(float(min_leaf), seed), [], trees, TREES_AT_ONCE, depth, tried, False)
    return _as_trees(grown, edges, features, 1 / max(1, trees), False)
