"""Near-duplicate groups by a signature-coordinate inverted join over MinHash signatures.

Two documents are linked when their sets of word shingles have a Jaccard
similarity of at least ``percent`` / 100.

1. Every document gets a signature of ``COORDINATES`` minima. Documents with equal
   sets are one class from here on, so exact copies of any number are one posting.
2. Classes are posted under each (coordinate, value) pair. Linked classes agree in
   at least ``matches`` coordinates (mean less five standard deviations), so
   pairs no other class has are skipped, a class left with too few is out, and
   only the rarest pairs of each, its prefix, are merged: who agrees in ``matches``
   places agrees in the prefix. Very frequent pairs are never merged.
3. Classes joined by prefix postings form clusters, by links to the smallest class
   of each posting, not by pairs. Inside clusters blocks of at most about ``BLOCK``
   classes are compared in memory: collisions over the whole signature are
   counted, pairs above ``matches`` are confirmed on the full sets, and a block
   reports a tree over what is linked. A large cluster is compared in two steps:
   each block with a common sample of the cluster, then those pairs of blocks
   that are not of one component yet. No pairs of a group are ever written out.

A shingle is a run of ``width`` words with A-Z lowered; a text with fewer words is
one shingle, a text without words or null has none and is linked with nothing.
Sets hold 64-bit hashes. Rows that repeat a doc_id are one document with several
texts; rows without doc_id come back with themselves only (component null, kept).
Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorespark.llm.components import components
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

WIDTH, PERCENT = 5, 80
COORDINATES = 64
BLOCK, SAMPLE = 1024, 64

_rng = np.random.default_rng(41)
_FACTORS = _rng.integers(1, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(1, 2**63, COORDINATES, dtype=np.uint64)


def least_matches(percent: int) -> int:
    """Coordinates in which a linked pair agrees but for about one pair in a million."""
    share = percent / 100
    return int(COORDINATES * share - 5 * sqrt(COORDINATES * share * (1 - share)))


def text_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted, and how many each has."""
    values, owners = shingles(Words(data, offsets), width)
    return distinct_per_text(values, owners, len(offsets) - 1)


def signatures(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One row of minima per text; texts without shingles have zeros."""
    out = np.zeros((len(counts), COORDINATES), dtype=np.uint32)
    full = np.flatnonzero(counts)
    if len(full):
        starts = (np.cumsum(counts) - counts)[full]
        for k in range(COORDINATES):
            hashed = ((values * _FACTORS[k] + _SHIFTS[k]) >> np.uint64(32)).astype(np.uint32)
            out[full, k] = np.minimum.reduceat(hashed, starts)
    return out


def _binary(rows: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Stretches of an array as binary values."""
    raw = np.ascontiguousarray(rows)
    offsets = np.concatenate([[0], ends * raw.itemsize]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])


def _sketch(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                values, counts = text_sets(*buffers(piece.column("text")), width)
                sums = np.concatenate([np.zeros((1, 2), np.uint64), np.cumsum(np.stack([values, values * (values | np.uint64(1))], 1), axis=0)])
                ends = np.cumsum(counts)
                digest = (sums[ends] - sums[ends - counts]).view(np.int64)
                marks = signatures(values, counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        pa.array(counts.astype(np.int64)),
                        pa.array(digest[:, 0]),
                        pa.array(digest[:, 1]),
                        _binary(marks.ravel(), np.arange(1, len(counts) + 1) * COORDINATES),
                    ],
                    names=["doc_id", "n_shingles", "da", "db", "signature"],
                )

    return run


def _post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    coordinate = np.arange(COORDINATES, dtype=np.int64) << 32
    for batch in batches:
        _, offsets, data = batch.column("signature").buffers()
        marks, _ = buffers(batch.column("signature"))
        pairs = marks.view(np.uint32).reshape(-1, COORDINATES).astype(np.int64) | coordinate
        nodes = np.repeat(np.asarray(batch.column("node")), COORDINATES)
        yield pa.RecordBatch.from_arrays([pa.array(pairs.ravel()), pa.array(nodes)], names=["pair", "node"])


def _set_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                values, counts = text_sets(*buffers(piece.column("text")), width)
                marks = signatures(values, counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        _binary(marks.ravel(), np.arange(1, len(counts) + 1) * COORDINATES),
                        _binary(values, np.cumsum(counts)),
                    ],
                    names=["node", "signature", "members"],
                )

    return run


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of a block."""
    k = len(sets)
    if k <= 6:
        out = np.zeros((k, k), dtype=np.int64)
        for i in range(k):
            for j in range(i, k):
                out[i, j] = out[j, i] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        return out
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(k), [len(s) for s in sets])
    _, inverse, count = np.unique(values, return_inverse=True, return_counts=True)
    rank = np.cumsum(count > 1) - 1
    shared = count[inverse] > 1
    owner, column = owner[shared], rank[inverse[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((k, k), dtype=np.float32)
    wide = 4096
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, wide):
        part = slice(*np.searchsorted(column, [low, low + wide]))
        table = np.zeros((k, wide), dtype=np.float32)
        table[owner[part], column[part] - low] = 1
        total += table @ table.T
    out = total.astype(np.int64)
    np.fill_diagonal(out, [len(s) for s in sets])
    return out


def block_links(nodes: np.ndarray, known: np.ndarray, marks: np.ndarray, sets: list[np.ndarray], percent: int, matches: int) -> list[tuple[int, int]]:
    """Links that join what is similar in a block and not of one known component: a tree over each group."""
    sizes = np.array([len(s) for s in sets])
    agree = np.zeros((len(nodes), len(nodes)), dtype=np.int16)
    for k in range(marks.shape[1]):
        agree += marks[:, k, None] == marks[None, :, k]
    close = (agree >= matches) & (sizes > 0)[:, None]
    common = intersections(sets)
    close &= 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
    linked = close | (known[:, None] == known[None, :])
    out, unseen = [], np.ones(len(nodes), dtype=bool)
    for first in range(len(nodes)):
        if not unseen[first]:
            continue
        group = np.zeros(len(nodes), dtype=bool)
        edge = group.copy()
        edge[first] = True
        while edge.any():
            group |= edge
            edge = linked[edge].any(axis=0) & ~group
        unseen &= ~group
        roots = np.unique(known[group])
        out.extend((int(r), int(roots[0])) for r in roots[1:])
    return out


def _compare(percent: int, matches: int):
    def links(rows: list[tuple]) -> list[tuple[int, int]]:
        if len(rows) < 2:
            return []
        nodes = np.array([r[0] for r in rows], dtype=np.int64)
        known = np.array([r[1] for r in rows], dtype=np.int64)
        marks = np.stack([np.frombuffer(r[2], dtype=np.uint32) for r in rows])
        sets = [np.frombuffer(r[3], dtype=np.uint64) for r in rows]
        return block_links(nodes, known, marks, sets, percent, matches)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            keys = zip(batch.column("cluster").to_pylist(), batch.column("block").to_pylist())
            found: list[tuple[int, int]] = []
            columns = [batch.column(c) for c in ("node", "known", "signature", "members")]
            for new, *values in zip(keys, *columns):
                if new != key:
                    found += links(rows)
                    key, rows = new, []
                rows.append(tuple(v.as_py() for v in values))
            if found:
                yield _pairs(found)
        found = links(rows)
        if found:
            yield _pairs(found)

    return run


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _compared(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links found in each (cluster, block) of rows (cluster, block, node, known)."""
    filled = rows.join(sets, "node").select("cluster", "block", "node", "known", "signature", "members")
    dealt = filled.repartition("cluster", "block").sortWithinPartitions("cluster", "block", "known", "node")
    return dealt.mapInArrow(_compare(percent, least_matches(percent)), "a long, b long")


def prefix_postings(classes: DataFrame, matches: int) -> DataFrame:
    """(pair, node) of the rarest coordinate-value pairs of each class, as many as a linked class must meet."""
    posts = classes.select("node", "signature").mapInArrow(_post, "pair long, node long")
    frequency = posts.groupBy("pair").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = posts.join(frequency, "pair").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n", "pair"))).alias("pairs"))
    rare = shared.where(F.size("pairs") >= matches).select(
        "node", F.explode(F.slice("pairs", F.lit(1), F.size("pairs") - matches + 1)).alias("p")
    )
    return rare.select("p.pair", "node")


def _clusters(classes: DataFrame, matches: int) -> DataFrame:
    """(node, root) of classes that share prefix postings, directly or through others."""
    postings = stage(prefix_postings(classes, matches), "near-postings")
    hubs = postings.groupBy("pair").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub < last")
    links = postings.join(hubs, "pair").where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    return components(links)


def _links(docs: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) between classes, enough to connect all that are similar."""
    clusters = _clusters(classes, least_matches(percent))
    sizes = clusters.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"), F.count(F.lit(1)).alias("total"))
    members = stage(clusters.join(sizes, "root").withColumnRenamed("root", "cluster"), "near-members")
    wanted = members.select("node")
    texts = documents_view(docs).join(wanted.hint("shuffle_hash"), F.col("doc_id") == F.col("node"), "left_semi")
    sets = stage(texts.mapInArrow(_set_rows(width), "node long, signature binary, members binary"), "near-sets")

    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    in_sample = (F.col("blocks") > 1) & (F.pmod(F.xxhash64(F.lit(3), "node"), F.col("total")) < SAMPLE)
    everywhere = F.when(in_sample, F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array(own))
    rows = members.select("cluster", "node", F.col("node").alias("known"), F.explode(everywhere).alias("block"))
    first = stage(_compared(rows, sets, percent), "near-links")

    # clusters of several blocks: pairs of blocks that are not of one component yet
    roots = components(first).withColumnsRenamed({"node": "_node", "root": "_root"})
    large = members.where("blocks > 1")
    known = large.join(roots, large["node"] == roots["_node"], "left").select(
        "cluster", "node", "blocks", F.coalesce("_root", "node").alias("known")
    )
    # a component fills blocks of its own where it is large: its hash, then the node's, decide the block
    crowd = known.groupBy(F.col("cluster").alias("_cluster"), F.col("known").alias("_known")).agg(F.count(F.lit(1)).alias("_crowd"))
    known = known.join(crowd, (known["cluster"] == crowd["_cluster"]) & (known["known"] == crowd["_known"]))
    alone = F.col("_crowd") >= BLOCK // 2
    part = F.when(
        alone, F.xxhash64("known", F.pmod(F.xxhash64("node"), F.ceil(F.col("_crowd") / BLOCK)))
    ).otherwise(F.pmod(F.xxhash64("node"), F.col("blocks")))
    placed = stage(known.select("cluster", "node", "known", part.alias("part")), "near-placed")
    parts = placed.groupBy("cluster", "part").agg(F.min("known").alias("low"), F.max("known").alias("high"))
    left = parts.withColumnsRenamed({"part": "p", "low": "l", "high": "h"})
    pairs = (
        left.join(parts, "cluster")
        .where("p <= part and not (l = h and low = high and l = low)")
        .select("cluster", "p", "part", F.xxhash64("p", "part").alias("block"))
    )
    sides = pairs.select("cluster", "block", F.explode(F.array_distinct(F.array("p", "part"))).alias("part"))
    second = _compared(sides.join(placed, ["cluster", "part"]).select("cluster", "block", "node", "known"), sets, percent)
    return first.unionByName(second)


def near_groups(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable), kept."""
    bounded_batches(docs.sparkSession)
    sketched = stage(
        documents_view(docs).mapInArrow(_sketch(width), "doc_id long, n_shingles long, da long, db long, signature binary"),
        "near-sketch",
    )
    named = sketched.where("doc_id is not null and n_shingles > 0")
    classes = stage(
        named.groupBy("n_shingles", "da", "db").agg(F.min("doc_id").alias("node"), F.first("signature").alias("signature")),
        "near-classes",
    )
    same = (
        named.select("doc_id", "n_shingles", "da", "db")
        .join(classes.drop("signature"), ["n_shingles", "da", "db"])
        .where("doc_id <> node")
        .select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    )
    roots = components(_links(docs, classes, width, percent).unionByName(same))
    rows = sketched.select("doc_id", "n_shingles").join(roots, F.col("doc_id") == F.col("node"), "left")
    component = F.coalesce("root", "doc_id")
    return rows.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``docs`` with the smallest doc_id of each group only; rows without doc_id stay."""
    dropped = near_groups(docs, width, percent).where("not kept").select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(dropped, docs["doc_id"] == dropped["_id"], "left_anti").select(*docs.columns)
