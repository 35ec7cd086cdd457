"""Boosting on residuals of the logistic loss, by passes over binned rows.

The method is that of Spark's boosted trees: labels are -1 and 1, the first tree is fitted to the labels, each later one
to the residuals of the margin so far on a sample of the rows and counts by the step size; a tree splits
where the variance falls most. Here rows are bytes of bins in pieces (``forests``); at each level the tasks add up
residuals and rows by (node, feature, bin), and of two siblings only the smaller is counted. Residuals
are whole multiples of ``1 / UNIT`` and samples follow a hash of the row, so any partitioning gives the same trees.
The step is part of the leaves' values, which are whole multiples of ``1 / FINE``: a margin is the same in any order of the sum.

Where the binned rows fit beside each other in the tasks that run at once (``together``), these hold them for the whole fit
and pass their sums to one another, a level a time, in one barrier stage; otherwise a level is one pass over the table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorespark.models.forests import GROWN, _members, _pieces, binned_table, grown_rows, grown_tree, saved_model
from scorespark.models.histogram_trees import BINS, TASKS, Bagging, Growing, row_words, split_node
from scorespark.models.together import Exchange, together
from scorespark.session import drop_table, scratch_folder, stage_at

#: Steps of a residual, which lies between -4 and 4.
UNIT = 1 << 16
#: Steps of a leaf's value.
FINE = 1 << 40
#: Place of the rows in a packed sum over a piece; below stand the residuals.
PACK = float(1 << 36)
#: Trees after which the margins of the rows are written down.
MARGINS_EVERY = 8
_PIECES = "h binary, y binary, bins binary, margin binary"


def fit_boosted(
    df: DataFrame, features: Sequence[str], estimator: GBTClassifier, key: str = "dummy_id", binned: tuple | None = None
) -> GBTClassificationModel:
    """The boosted trees of ``estimator``: its label, number of trees, depth, step, part of the rows a tree sees and seed.

    ``binned`` is as in ``forests.fit_trees``.
    """
    spark = df.sparkSession
    trees, depth, seed = estimator.getMaxIter(), estimator.getMaxDepth(), estimator.getSeed()
    table, path, edges, n, _ = binned or binned_table(df, features, estimator.getLabelCol(), key)
    kept = binned and path
    if not n:
        raise ValueError("no rows to fit")
    # a row is in a tree's sample if its hash is below this
    below = min(int(estimator.getSubsamplingRate() * float(1 << 64)), (1 << 64) - 1)
    loss = Bagging(float(estimator.getMinInstancesPerNode()), seed)
    # a row has a key hash, a label, its margin and residual, and a byte a bin
    tasks = together(spark, n, len(features) + 26, (1 << max(0, depth - 2)) * len(features) * BINS * 16)
    if tasks:
        folder = scratch_folder(spark, "sums")
        run = _held(loss, trees, depth, estimator.getStepSize(), len(features), below, folder)
        found = table.repartition(tasks).mapInArrow(run, GROWN, barrier=True).collect()
        drop_table(spark, folder)
        if path != kept:
            drop_table(spark, path)
        return saved_model(spark, [grown_tree(*r) for r in found], edges, len(features), estimator)
    many = table.rdd.getNumPartitions() > TASKS
    grown: list[Growing] = []
    later: list[Growing] = []
    for k in range(trees):
        tree = _grow(table, loss, later, k, depth, len(features), below, many)
        grown.append(tree)
        tree.value = _values(tree, estimator.getStepSize())
        later.append(tree)
        if len(later) == MARGINS_EVERY and k + 1 < trees:
            before = path
            table, path = stage_at(table.mapInArrow(_with_margins(later), _PIECES), "margins")
            if before != kept:
                drop_table(spark, before)
            later = []
    if path != kept:
        drop_table(spark, path)
    return saved_model(spark, grown, edges, len(features), estimator)


def _values(tree: Growing, step: float) -> list[float]:
    """The nodes' means, by the step but in the first tree."""
    return [round(g / h * (step if tree.number else 1.0) * FINE) / FINE if h else 0.0 for g, h in tree.sums]


class _Piece:
    """Rows of a task with the margin so far, and during a tree the rows by node."""

    def __init__(self, h: np.ndarray, y: np.ndarray, bins: np.ndarray):
        self.h, self.y, self.margin = h.copy(), y.copy(), None
        # the bins of two features are one number, so that one count serves both
        pairs = bins[::2].astype(np.uint16) * BINS
        pairs[: len(bins) // 2] += bins[1::2]
        self.pairs = pairs

    def begin(self, number: int, seed: int, below: int) -> None:
        self.mass = _residuals(self.y, self.margin) + PACK
        # rows outside the sample are nothing to the sums
        self.mass[row_words(self.h, number, seed) > np.uint64(below)] = 0.0
        self.rows = {0: np.arange(len(self.y))}

    def sums(self, node: int, features: int) -> np.ndarray:
        mine = self.rows[node]
        own, out = self.mass.take(mine), np.empty((2 * len(self.pairs), BINS))
        for k, pair in enumerate(self.pairs):
            both = np.bincount(pair.take(mine), weights=own, minlength=BINS * BINS).reshape(BINS, BINS)
            out[2 * k], out[2 * k + 1] = both.sum(axis=1), both.sum(axis=0)
        return out[:features]

    def part(self, tree: Growing, node: int) -> None:
        mine = self.rows.pop(node)
        pair = self.pairs[tree.at[node] // 2].take(mine)
        goes_left = (pair & BINS - 1 if tree.at[node] % 2 else pair // BINS) <= tree.cut[node]
        self.rows[tree.left[node]], self.rows[tree.right[node]] = mine.compress(goes_left), mine.compress(~goes_left)

    def end(self, tree: Growing) -> None:
        if self.margin is None:
            self.margin = np.zeros(len(self.y))
        for node, mine in self.rows.items():
            self.margin[mine] += tree.value[node]


def _held(loss: Bagging, trees: int, depth: int, step: float, features: int, below: int, folder: str):
    """All trees, grown alike by every task from the sums of all; the first task gives them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exchange = Exchange(folder)
        pieces = [_Piece(*x) for x in _pieces(batches)]

        def added(counted: Sequence[int]) -> np.ndarray:
            sums = np.zeros((2, len(counted), features, BINS), dtype=np.int64)
            for piece in pieces:
                for place, node in enumerate(counted):
                    packed = piece.sums(node, features)
                    n = np.rint(packed / PACK)
                    sums[0, place] += (packed - n * PACK).astype(np.int64)
                    sums[1, place] += n.astype(np.int64)
            return exchange.added(sums)

        grown = []
        for number in range(trees):
            for piece in pieces:
                piece.begin(number, loss.seed, below)
            tree = Growing(number)
            _grown(loss, tree, depth, features, added, lambda node: [p.part(tree, node) for p in pieces])
            tree.value = _values(tree, step)
            for piece in pieces:
                piece.end(tree)
            grown.append(tree)
        if exchange.me == 0:
            yield from grown_rows(grown)

    return run


def _margins(batches: Iterator[pa.RecordBatch], later: Sequence[Growing]):
    """Key hashes, labels, bins and the margin after the ``later`` trees of each piece; no margin before the first tree."""
    leaves = [[k for k, at in enumerate(tree.at) if at < 0] for tree in later]
    for batch in batches:
        has = "margin" in batch.schema.names
        for k in range(batch.num_rows):
            h, y, bins = (np.frombuffer(batch.column(c)[k].as_buffer(), dtype=t) for c, t in (("h", np.int64), ("y", np.uint8), ("bins", np.uint8)))
            bins, every = bins.reshape(-1, len(y)), np.arange(len(y))
            margin = np.frombuffer(batch.column("margin")[k].as_buffer()).copy() if has else np.zeros(len(y)) if later else None
            for tree, ends in zip(later, leaves):
                for node, mine in _members(tree, ends, bins, every).items():
                    margin[mine] += tree.value[node]
            yield h, y, bins, margin


def _residuals(y: np.ndarray, margin: np.ndarray | None) -> np.ndarray:
    """Whole steps of what the next tree is fitted to: the label before the first, then the falls of the loss."""
    sign = y * 2.0 - 1
    if margin is None:
        return sign * UNIT
    return np.rint(sign * (4.0 * UNIT) / (1 + np.exp(np.minimum(2 * sign * margin, 700.0))))


def _with_margins(later: Sequence[Growing]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, y, bins, margin in _margins(batches, later):
            arrays = [pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in (h, y, bins, margin)]
            yield pa.RecordBatch.from_arrays(arrays, names=["h", "y", "bins", "margin"])

    return run


def _sums(later, tree: Growing, counted: Sequence[int], features: int, seed: int, below: int):
    """Residuals and rows of a task's sample by (node, feature, bin)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, len(counted), features, BINS), dtype=np.int64)
        packed = np.empty((len(counted), features, BINS))
        for h, y, bins, margin in _margins(batches, later):
            mass = _residuals(y, margin) + PACK
            taken = np.flatnonzero(row_words(h, tree.number, seed) <= np.uint64(below))
            rows = _members(tree, counted, bins, taken)
            for place, node in enumerate(counted):
                mine = rows[node]
                own = mass.take(mine)
                for f in range(features):
                    packed[place, f] = np.bincount(bins[f].take(mine), weights=own, minlength=BINS)
            n = np.rint(packed / PACK)
            sums[0] += (packed - n * PACK).astype(np.int64)
            sums[1] += n.astype(np.int64)
        both = sums.reshape(2, -1)
        used = np.flatnonzero(both[1])
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(both[0][used]), pa.array(both[1][used])], names=["cell", "g", "n"])

    return run


def _grow(table: DataFrame, loss: Bagging, later, number: int, depth: int, features: int, below: int, many: bool) -> Growing:
    """One tree, one pass over the rows a level."""

    def added(counted: Sequence[int]) -> np.ndarray:
        cells = table.mapInArrow(_sums(later, tree, counted, features, loss.seed, below), "cell long, g long, n long")
        if many:
            cells = cells.groupBy("cell").agg(F.sum("g").alias("g"), F.sum("n").alias("n"))
        found = cells.toArrow()
        sums = np.zeros((2, len(counted) * features * BINS), dtype=np.int64)
        for k, name in enumerate(("g", "n")):
            np.add.at(sums[k], np.asarray(found.column("cell")), np.asarray(found.column(name)))
        return sums.reshape(2, len(counted), features, BINS)

    tree = Growing(number)
    return _grown(loss, tree, depth, features, added)


def _grown(loss: Bagging, tree: Growing, depth: int, features: int, added, parted=None) -> Growing:
    """The tree by ``added(nodes)``, the sums of those nodes over all rows; ``parted(node)`` is told of each split."""
    every = np.arange(features)
    opened, rest, known = [0], {}, {}
    for _ in range(max(1, depth)):
        counted = [k for k in opened if k not in rest]
        if not counted:
            break
        sums = added(counted)
        cells_of = {k: sums[:, place] for place, k in enumerate(counted)}
        cells_of |= {k: known[parent] - cells_of[sibling] for k, (parent, sibling) in rest.items()}
        children, rest, known = [], {}, cells_of
        for node in opened:
            own = np.stack([cells_of[node][0] / UNIT, cells_of[node][1].astype(float)])
            if not depth:
                tree.sums[0] = tuple(float(x) for x in own[:, 0].sum(axis=1))
                continue
            both = split_node(loss, tree, node, every, own)
            children += both
            if both:
                less, more = sorted(both, key=lambda k: tree.sums[k][1])
                rest[more] = (node, less)
                if parted:
                    parted(node)
        opened = children
    return tree
