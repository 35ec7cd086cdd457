"""Random forests whose trees all grow in the same passes over the rows.

Rows are bytes of bins, packed some ten thousand to a row of the binned table, so a pass costs
tens of bytes a row however many trees there are. A pass adds up, for every open node of every
tree of a group, the drawn rows and those of class 1 by (tried feature, bin) in the tasks; the driver
sees sums only and picks the splits by the Gini index. Every tree weighs each row by a Poisson count of
mean 1, which follows from a hash of the row's key and features, so any partitioning gives the same trees.

Where the binned rows fit beside each other in the tasks that run at once, these hold them for the whole fit, grow a few
trees at a time and remember which rows a node has (``together``); otherwise a level is one pass over the table.

A feature of up to 32 values is cut between any two of them, others at their least value and 30 exact quantiles.
The result is Spark's own model class: it is scored, saved, loaded and explained like one that Spark has fitted.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator, Sequence
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorespark.models.histogram_trees import BINS, MOST_A_TASK, ROWS_A_TASK, Bagging, Growing, poisson_counts, row_words, split_node
from scorespark.models.together import Exchange, together
from scorespark.operators.quantiles import exact_quantiles
from scorespark.session import drop_table, scratch_folder, scratch_path, stage, stage_at, values_table

#: Rows of a piece at most.
PIECE = 1 << 16
#: Place of the drawn rows in a packed sum; below stand those of class 1.
PACK = float(1 << 26)
#: Pieces whose packed sums are added up before they are unpacked; with at most nine draws a row this is exact.
HELD = 64
#: Cells of a pass at most: trees beyond grow in a later group.
CELLS = 1 << 20
#: Trees that grow at a time where tasks hold the rows.
AT_ONCE = 4
#: Cells of all tasks that reach the driver one by one; more meet in an aggregation.
COLLECTED = 1 << 22
#: Poisson counts of a 16-bit part of a hash; four trees share one hash of a row.
_DRAWS = poisson_counts((np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.int8)
#: Parameters of an ensemble that its single trees do not have.
_OF_ENSEMBLES = (
    "bootstrap", "featureSubsetStrategy", "numTrees", "subsamplingRate", "lossType", "maxIter", "stepSize", "validationTol",
)
#: Those of classes that a regression tree does not have.
_OF_CLASSES = ("rawPredictionCol", "probabilityCol")
_PIECES = "h binary, y binary, bins binary"
GROWN = "number int, at array<int>, cut array<int>, left array<int>, right array<int>, value array<double>, g array<double>, n array<double>"
_NODES = (
    "treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, rawCount bigint, "
    "gain double, leftChild int, rightChild int, split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>"
)


def fit_trees(
    df: DataFrame, features: Sequence[str], estimator: RandomForestClassifier, key: str = "dummy_id", binned: tuple | None = None
) -> RandomForestClassificationModel:
    """The forest of ``estimator``: its label, numbers of trees, depth, least rows of a leaf and seed; sqrt(features) a node.

    ``binned`` is the :func:`binned_table` of the same rows, features, label and key, where several fits share it; it is kept.
    """
    spark = df.sparkSession
    trees, depth, seed = estimator.getNumTrees(), estimator.getMaxDepth(), estimator.getSeed()
    table, path, edges, n, bad = binned or binned_table(df, features, estimator.getLabelCol(), key)
    if not n:
        raise ValueError("no rows to fit")
    width = ceil(sqrt(len(features)))
    cells = width * BINS << max(0, depth - 1)
    least = float(estimator.getMinInstancesPerNode())
    # a row has a key hash, a weight, a byte a bin, and its place and weight in the growing trees
    tasks = together(spark, n, len(features) + 16 + 16 * AT_ONCE, cells * 16 * AT_ONCE)
    if tasks:
        folder = scratch_folder(spark, "sums")
        run = _held(trees, depth, len(features), width, least, seed, folder)
        grown = [grown_tree(*r) for r in table.repartition(tasks).mapInArrow(run, GROWN, barrier=True).collect()]
        drop_table(spark, folder)
    else:
        at_once, grown = max(1, CELLS // cells), []
        for first in range(0, trees, at_once):
            grown += _grow(table, range(first, min(trees, first + at_once)), depth, len(features), width, least, seed)
    if not binned:
        drop_table(spark, path)
    for tree in grown:
        if not tree.sums[0][1]:  # a tree that drew no row of a very small table
            tree.sums[0] = (float(bad), float(n))
    return saved_model(spark, grown, edges, len(features), estimator)


def binned_table(df: DataFrame, features: Sequence[str], label: str, key: str):
    """The rows as (key hash, label, bins) in pieces and its path, the cuts of each feature, rows and rows of class 1."""
    names = [f"f{k}" for k in range(len(features))]
    # rows without a key of their own are told apart by their place
    own = F.col(key) if key in df.columns else F.monotonically_increasing_id()
    values = [F.col(c).cast("double").alias(n) for c, n in zip(features, names)]
    plain = df.select(F.xxhash64(own, *features).alias("h"), F.col(label).cast("double").alias("y"), *values)
    edges = _edges(plain, names)
    binned, whole = stage_at(plain.mapInArrow(_binned(edges, features, label), _PIECES), "binned")
    n, bad = _counted(binned)
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(n // ROWS_A_TASK, cores), -(-n // MOST_A_TASK))
    table, path = stage_at(binned.repartition(parts), "dealt")
    drop_table(df.sparkSession, whole)
    return table, path, edges, n, bad


def _edges(plain: DataFrame, names: Sequence[str]) -> list[np.ndarray]:
    """The cuts of each feature; values up to a cut go left."""
    places = [k / (BINS - 1) for k in range(BINS - 1)]
    found = exact_quantiles(plain, {c: places for c in names})
    edges = {c: np.unique([e for e in found[c] if e is not None]) for c in names}
    few = [c for c in names if len(edges[c]) < BINS - 1]
    if few:
        pairs = F.inline(F.array(*[F.struct(F.lit(c).alias("f"), F.col(c).alias("v")) for c in few]))
        values = stage(plain.select(pairs).distinct(), "values")
        small = [r["f"] for r in values.groupBy("f").count().where(F.col("count") <= BINS).collect()]
        by_name: dict[str, list[float]] = {c: [] for c in small}
        for r in values.where(F.col("f").isin(small) & F.col("v").isNotNull()).collect() if small else ():
            by_name[r["f"]].append(r["v"])
        for c, some in by_name.items():
            own = np.unique(some)
            edges[c] = (own[:-1] + own[1:]) / 2
    return [edges[c] for c in names]


def _binned(edges: list[np.ndarray], features: Sequence[str], label: str):
    def piece(parts: list[tuple]) -> pa.RecordBatch:
        h, y, bins = (np.concatenate(x, axis=-1) for x in zip(*parts))
        arrays = [pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in (h, y, bins)]
        return pa.RecordBatch.from_arrays(arrays, names=["h", "y", "bins"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for whole in batches:
            for first in range(0, whole.num_rows, PIECE):
                batch = whole.slice(first, PIECE)
                if held + batch.num_rows > PIECE:
                    yield piece(parts)
                    parts, held = [], 0
                y = batch.column("y").to_numpy(zero_copy_only=False)
                if not np.isin(y, (0.0, 1.0)).all():
                    raise ValueError(f"labels in '{label}' other than 0 and 1")
                bins = np.empty((len(edges), batch.num_rows), dtype=np.uint8)
                for k, e in enumerate(edges):
                    x = batch.column(f"f{k}").to_numpy(zero_copy_only=False)
                    if np.isnan(x).any():
                        raise ValueError(f"missing values in feature '{features[k]}'")
                    bins[k] = np.searchsorted(e, x, side="left")
                parts.append((batch.column("h").to_numpy(), y.astype(np.uint8), bins))
                held += batch.num_rows
        if held:
            yield piece(parts)

    return run


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Key hashes, labels and bins (a line per feature) of each piece."""
    for batch in batches:
        for k in range(batch.num_rows):
            h, y, bins = (np.frombuffer(batch.column(c)[k].as_buffer(), dtype=t) for c, t in (("h", np.int64), ("y", np.uint8), ("bins", np.uint8)))
            yield h, y, bins.reshape(-1, len(y))


def _counted(table: DataFrame) -> tuple[int, int]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(y.as_buffer(), dtype=np.uint8) for y in batch.column("y")]
            counts = [pa.array(x, pa.int64()) for x in ([len(y) for y in found], [int(y.sum(dtype=np.int64)) for y in found])]
            yield pa.RecordBatch.from_arrays(counts, names=["n", "bad"])

    n, bad = table.select("y").mapInArrow(run, "n long, bad long").agg(F.sum("n"), F.sum("bad")).first()
    return n or 0, bad or 0


def _members(tree: Growing, wanted: Sequence[int], bins: np.ndarray, rows: np.ndarray) -> dict[int, np.ndarray]:
    """The given rows by the open node each is in."""
    found, ahead = {}, [(0, rows)]
    # a node's way to an open one
    ways = set(wanted)
    for node in range(len(tree.at) - 1, -1, -1):
        if tree.at[node] >= 0 and (tree.left[node] in ways or tree.right[node] in ways):
            ways.add(node)
    while ahead:
        node, mine = ahead.pop()
        if tree.at[node] < 0:
            found[node] = mine
            continue
        goes_left = bins[tree.at[node]].take(mine) <= tree.cut[node]
        if tree.left[node] in ways:
            ahead.append((tree.left[node], mine.compress(goes_left)))
        if tree.right[node] in ways:
            ahead.append((tree.right[node], mine.compress(~goes_left)))
    return found


def _sums(growing: Sequence[tuple[Growing, dict[int, np.ndarray]]], width: int, seed: int):
    """Drawn rows and drawn rows of class 1 of a task by cell; an open node has ``width`` features of ``BINS`` cells."""
    nodes = sum(len(opened) for _, opened in growing)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, held = np.zeros((2, nodes * width, BINS), dtype=np.int64), 0
        packed = np.zeros((nodes * width, BINS))

        def unpack() -> None:
            n = np.floor(packed / PACK)
            sums[0] += n.astype(np.int64)
            sums[1] += (packed - n * PACK).astype(np.int64)
            packed[:] = 0

        for h, y, bins in _pieces(batches):
            weight, shared, words = PACK + y, None, h
            at = 0
            for tree, opened in growing:
                if not opened:
                    continue
                if shared != tree.number // 4:
                    shared = tree.number // 4
                    words = row_words(h, shared, seed).view(np.uint16).reshape(-1, 4)
                drawn = _DRAWS.take(words[:, tree.number % 4])
                mass = weight * drawn
                rows = _members(tree, list(opened), bins, np.flatnonzero(drawn))
                for node, features in opened.items():
                    mine = rows[node]
                    own = mass.take(mine)
                    for f in features:
                        packed[at] += np.bincount(bins[f].take(mine), weights=own, minlength=BINS)
                        at += 1
            held += 1
            if held == HELD:
                unpack()
                held = 0
        unpack()
        n, bad = sums.reshape(2, -1)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(bad[used]), pa.array(n[used])], names=["cell", "bad", "n"])

    return run


def _grow(table: DataFrame, numbers: Sequence[int], depth: int, features: int, width: int, least: float, seed: int) -> list[Growing]:
    """Trees grown side by side, one pass over the rows a level."""
    parts = table.rdd.getNumPartitions()

    def added(growing: Sequence[tuple[Growing, dict[int, np.ndarray]]]) -> np.ndarray:
        nodes = sum(len(opened) for _, opened in growing)
        cells = table.mapInArrow(_sums(growing, width, seed), "cell long, bad long, n long")
        if parts * nodes * width * BINS > COLLECTED:
            cells = cells.groupBy("cell").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
        found = cells.toArrow()
        sums = np.zeros((2, nodes * width * BINS))
        for k, name in enumerate(("bad", "n")):
            np.add.at(sums[k], np.asarray(found.column("cell")), np.asarray(found.column(name)))
        return sums.reshape(2, nodes, width, BINS)

    return _grown([Growing(k) for k in numbers], depth, features, width, least, seed, added)


def _grown(trees: list[Growing], depth: int, features: int, width: int, least: float, seed: int, added, parted=None) -> list[Growing]:
    """The trees by ``added(growing)``, the sums of all open nodes over all rows; ``parted(tree, node)`` is told of each split."""

    def tried(number: int, node: int) -> np.ndarray:
        return np.sort(np.random.default_rng([seed, number, node]).permutation(features)[:width])

    loss = Bagging(least, seed)
    opened = [{0: tried(tree.number, 0)} for tree in trees]
    for level in range(max(1, depth)):
        if not any(opened):
            break
        sums = added(list(zip(trees, opened)))
        at = 0
        for t, tree in enumerate(trees):
            children = {}
            for node, some in opened[t].items():
                if depth:
                    both = split_node(loss, tree, node, some, sums[:, at])
                    for child in both:
                        children[child] = tried(tree.number, child)
                    if both and parted and level + 1 < depth:
                        parted(t, node)
                else:
                    tree.sums[0] = tuple(float(x) for x in sums[:, at, 0].sum(axis=1))
                at += 1
            opened[t] = children
    return trees


def _held(trees: int, depth: int, features: int, width: int, least: float, seed: int, folder: str):
    """All trees, grown alike by every task from the sums of all; the first task gives them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exchange = Exchange(folder)
        pieces = [(h.copy(), PACK + y, bins.copy()) for h, y, bins in _pieces(batches)]
        # of each piece and tree, the drawn rows of a node and their weights
        rows: list[list[dict[int, tuple[np.ndarray, np.ndarray]]]] = []
        group: list[Growing] = []

        def added(growing: Sequence[tuple[Growing, dict[int, np.ndarray]]]) -> np.ndarray:
            nodes = sum(len(opened) for _, opened in growing)
            sums, packed = np.zeros((2, nodes * width, BINS), dtype=np.int64), np.zeros((nodes * width, BINS))
            for place, (_, _, bins) in enumerate(pieces):
                at = 0
                for t, (_, opened) in enumerate(growing):
                    for node, some in opened.items():
                        mine, own = rows[place][t][node]
                        for f in some:
                            packed[at] += np.bincount(bins[f].take(mine), weights=own, minlength=BINS)
                            at += 1
                if place % HELD == HELD - 1 or place == len(pieces) - 1:
                    n = np.floor(packed / PACK)
                    sums[0] += (packed - n * PACK).astype(np.int64)
                    sums[1] += n.astype(np.int64)
                    packed[:] = 0
            return exchange.added(sums).reshape(2, nodes, width, BINS).astype(float)

        def parted(t: int, node: int) -> None:
            tree = group[t]
            for (_, _, bins), some in zip(pieces, rows):
                mine, own = some[t].pop(node)
                left = bins[tree.at[node]].take(mine) <= tree.cut[node]
                right = ~left
                some[t][tree.left[node]] = mine.compress(left), own.compress(left)
                some[t][tree.right[node]] = mine.compress(right), own.compress(right)

        grown = []
        for first in range(0, trees, AT_ONCE):
            group[:] = [Growing(k) for k in range(first, min(trees, first + AT_ONCE))]
            rows[:] = [_drawn(h, weight, group, seed) for h, weight, _ in pieces]
            grown += _grown(group, depth, features, width, least, seed, added, parted)
        if exchange.me == 0:
            yield from grown_rows(grown)

    return run


def _drawn(h: np.ndarray, weight: np.ndarray, group: Sequence[Growing], seed: int) -> list[dict[int, tuple[np.ndarray, np.ndarray]]]:
    """For each tree the rows that it draws, all in its root, and their packed weights."""
    found, shared = [], None
    for tree in group:
        if shared != tree.number // 4:
            shared = tree.number // 4
            words = row_words(h, shared, seed).view(np.uint16).reshape(-1, 4)
        drawn = _DRAWS.take(words[:, tree.number % 4])
        mine = np.flatnonzero(drawn)
        found.append({0: (mine, weight.take(mine) * drawn.take(mine))})
    return found


def grown_rows(grown: Sequence[Growing]) -> Iterator[pa.RecordBatch]:
    """The trees as rows of ``GROWN``."""
    kinds = [pa.int32(), *[pa.list_(pa.int32())] * 4, *[pa.list_(pa.float64())] * 3]
    for tree in grown:
        values = [tree.number, tree.at, tree.cut, tree.left, tree.right, tree.value, *zip(*tree.sums)]
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=[c.split()[0] for c in GROWN.split(", ")])


def grown_tree(number: int, at, cut, left, right, value, g, n) -> Growing:
    return Growing(number, *map(list, (at, cut, left, right, value)), list(zip(g, n)))


def _gini(bad: float, n: float) -> float:
    return 2 * (bad / n) * (1 - bad / n)


def _node(tree: Growing, node: int, edges: list[np.ndarray], boosted: bool) -> dict:
    """A node as Spark's models save it: with rows by class, or with rows, sum and sum of squares.

    The squares of residuals are not counted; those of the mean stand in their place, so impurities of boosted nodes are 0.
    """
    g, n = tree.sums[node]
    gain, feature, cuts = -1.0, tree.at[node], []
    if feature >= 0:
        cuts = [float(edges[feature][tree.cut[node]])]
        parts = [tree.sums[child] for child in (tree.left[node], tree.right[node])]
        # the fall of the variance; a class has twice that of its share
        gain = (1 if boosted else 2) * (sum(a * a / m for a, m in parts) - g * g / n) / n
    return {
        "id": node,
        "prediction": tree.value[node] if boosted else float(2 * g > n),
        "impurity": 0.0 if boosted else _gini(g, n),
        "impurityStats": [n, g, g * g / n if n else 0.0] if boosted else [n - g, g],
        "rawCount": int(n),
        "gain": gain,
        "leftChild": tree.left[node],
        "rightChild": tree.right[node],
        "split": {"featureIndex": feature, "leftCategoriesOrThreshold": cuts, "numCategories": -1},
    }


def _preorder(tree: Growing) -> Growing:
    """The same tree with nodes numbered as Spark's models are: a node, its left part, its right part."""
    order, ahead = [], [0]
    while ahead:
        node = ahead.pop()
        order.append(node)
        if tree.at[node] >= 0:
            ahead += [tree.right[node], tree.left[node]]
    place = {node: k for k, node in enumerate(order)} | {-1: -1}
    out = Growing(tree.number)
    out.at, out.cut, out.value, out.sums = ([x[k] for k in order] for x in (tree.at, tree.cut, tree.value, tree.sums))
    out.left, out.right = ([place[x[k]] for k in order] for x in (tree.left, tree.right))
    return out


def saved_model(spark, grown: Sequence[Growing], edges: list[np.ndarray], features: int, estimator):
    """Spark's model of the trees, by way of its saved form."""
    set_, defaults = ({p.name: v for p, v in x.items()} for x in (estimator._paramMap, estimator._defaultParamMap))
    boosted = isinstance(estimator, GBTClassifier)
    kind = GBTClassificationModel if boosted else RandomForestClassificationModel

    def described(name: str, uid: str, left_out: Sequence[str] = (), **more) -> str:
        own = [{k: v for k, v in x.items() if k not in left_out} for x in (set_, defaults)]
        about = {"class": f"org.apache.spark.ml.{name}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version}
        return json.dumps(about | {"uid": uid, "paramMap": own[0], "defaultParamMap": own[1]} | more)

    path, trees = scratch_path(spark, "forest"), [_preorder(tree) for tree in grown]
    sizes = {"numFeatures": features, "numTrees": len(trees)} | ({} if boosted else {"numClasses": 2})
    whole = described(f"classification.{kind.__name__}", estimator.uid, **sizes)
    single = "regression.DecisionTreeRegressionModel" if boosted else "classification.DecisionTreeClassificationModel"
    without = _OF_ENSEMBLES + (_OF_CLASSES if boosted else ())
    described_trees = [(k, described(single, f"{estimator.uid}_{k}", without), 1.0) for k in range(len(trees))]
    nodes = [(k, _node(tree, node, edges, boosted)) for k, tree in enumerate(trees) for node in range(len(tree.at))]
    values_table(spark, [(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    values_table(spark, described_trees, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    values_table(spark, nodes, _NODES).coalesce(1).write.parquet(f"{path}/data")
    return kind.load(path)
