"""Merkle manifest of a dataset with incremental witnesses.

Every row is a leaf; the leaves of a source, ascending by doc_id, are joined in runs of
``FAN_OUT`` until one node remains, the sources' nodes likewise give the root. A leaf's
witness is what is needed to get from the leaf to the root: the digests before and
after it in its run, level by level.

* :class:`Appender` takes leaves one after another. An appended leaf holds a partial witness,
  its place in an open subtree. Every sibling that is completed later extends the witnesses
  of all leaves below its run, which share it, so extending is one list entry.
* Leaves are dealt in aligned blocks of 256. A task appends the leaves of its blocks; block
  roots are then leaves of further appends, dealt in the same way, until every source, and
  then the list of sources, has one root. So no task sees more than single blocks,
  however many rows a source has.
* Witnesses of block roots are handed down: the block is appended once more and the
  block root's witness extends those of its leaves.

Fields are hashed as ``-`` if null, else byte count, ``:`` and value. Rows without doc_id come
first in their source; rows that share a doc_id are ordered by their leaf. A null source is
a source of its own, before all others; an empty one is another. An empty table has no
rows in the manifest. Columns other than the five are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorespark.llm.ordered import placed_rows
from scorespark.llm.text import bounded_batches
from scorespark.session import stage

FAN_OUT = 16
#: Levels of an aligned block: 256 leaves.
BLOCK_LEVELS = 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLOCKS = "tree string, block long, ids array<long>, leaves array<string>, claims array<string>"
_WITNESS = "array<struct<before:string,after:string>>"


def joined(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


class Node:
    """A subtree that is complete: its digest and, once known, its run, its place there and what the run became."""

    __slots__ = ("digest", "run", "place", "above")

    def __init__(self, digest: str):
        self.digest = digest
        self.run: list[Node] | None = None
        self.place = 0
        self.above: Node | None = None


class Appender:
    """A tree that grows by one leaf at a time; per level, the run that is still open."""

    def __init__(self, fan_out: int = FAN_OUT):
        self.fan_out = fan_out
        self.open: list[list[Node]] = [[]]

    def append(self, digest: str) -> Node:
        leaf = Node(digest)
        self._extend(0, leaf)
        return leaf

    def _extend(self, level: int, node: Node) -> None:
        """Complete ``node`` in its run: the witnesses below its siblings grow by it, its own by them."""
        if level == len(self.open):
            self.open.append([])
        run = self.open[level]
        node.run, node.place = run, len(run)
        run.append(node)
        if len(run) == self.fan_out:
            self._close(level)

    def _close(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        above = Node(joined([n.digest for n in run]))
        for node in run:
            node.above = above
        self._extend(level + 1, above)

    def finish(self, levels: int | None = None) -> Node:
        """Close what is open; the root. ``levels``: of a block that stands among others."""
        level = 0
        while True:
            run = self.open[level]
            alone = len(run) == 1 and not any(self.open[level + 1 :])
            if alone and (levels is None or level >= levels):
                run[0].run = None
                return run[0]
            if run:
                self._close(level)
            level += 1


def witness(leaf: Node, known: dict[int, list[tuple[str, str]]], rest: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """(digests before, digests after) level by level, ``rest`` above the root. ``known`` keeps those of inner nodes."""
    if leaf.run is None:
        return rest
    before = "".join(n.digest for n in leaf.run[: leaf.place])
    after = "".join(n.digest for n in leaf.run[leaf.place + 1 :])
    above = known.get(id(leaf.above))
    if above is None:
        above = known[id(leaf.above)] = witness(leaf.above, known, rest)
    return [(before, after), *above]


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its witness give."""
    return F.aggregate(steps, leaf, lambda at, s: F.sha2(F.concat(s["before"], at, s["after"]).cast("binary"), 256))


def witness_digest(steps: Column) -> Column:
    """Digest of all siblings of a witness, left to right and level by level."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["before"], s["after"])), "").cast("binary"), 256)


def leaf_digest(text: Column | None = None) -> Column:
    """Digest of a row, with ``text`` in place of its text."""
    fields = [text if c == "text" and text is not None else F.col(c).cast("string") for c in FIELDS]
    return F.sha2(
        F.concat(
            *[F.when(f.isNull(), "-").otherwise(F.concat(F.octet_length(f).cast("string"), F.lit(":"), f)) for f in fields]
        ).cast("binary"),
        256,
    )


def lower_cased(every: int = 5) -> Column:
    """The leaf of a row whose text has lost its capitals A-Z where ``every`` divides crc32 of doc_id, else its own."""
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0, F.lit(False))
    return leaf_digest(F.when(hit, F.translate("text", UPPER, LOWER)).otherwise(F.col("text")))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block from rows sorted by block."""
    names = ["tree", "block", "ids", "leaves", "claims"]
    kinds = [pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.string())]
    held: tuple | None = None
    for batch in batches:
        out = []
        for tree, block, doc_id, leaf, claim in zip(*[batch.column(c).to_pylist() for c in ("tree", "block", "id", "leaf", "claim")]):
            if held is None or held[0] != tree or held[1] != block:
                if held is not None:
                    out.append(held)
                held = (tree, block, [], [], [])
            held[2].append(doc_id)
            held[3].append(leaf)
            held[4].append(claim)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(held, kinds)], names=names)


def _appended(block: int, leaves: list[str]) -> tuple[list[Node], Node]:
    """The first block of a tree is as high as it needs to be, others as high as their place asks."""
    appender = Appender()
    nodes = [appender.append(leaf) for leaf in leaves]
    return nodes, appender.finish(BLOCK_LEVELS if block else None)


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        blocks, leaves = batch.column("block").to_pylist(), batch.column("leaves").to_pylist()
        roots = [_appended(b, own)[1].digest for b, own in zip(blocks, leaves)]
        yield pa.RecordBatch.from_arrays([batch.column("tree"), batch.column("block"), pa.array(roots, pa.string())], names=["tree", "place", "leaf"])


_HANDED = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
#: Leaves whose witnesses a task holds at a time.
LEAVES_AT_A_TIME = 1024


def _handed_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with the witness of their root to leaves with theirs."""
    names = ["tree", "block", "ids", "leaves", "claims", "subroot", "steps"]
    rows: list[tuple] = []

    def out() -> pa.RecordBatch:
        columns = list(zip(*rows))
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        steps = columns.pop()
        sizes = pa.array([0, *_sums(len(s) for s in steps)], pa.int32())
        flat = [pair for s in steps for pair in s]
        pairs = pa.StructArray.from_arrays([pa.array([p[k] for p in flat], pa.string()) for k in (0, 1)], fields=list(_HANDED.value_type))
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        return pa.RecordBatch.from_arrays([*arrays, pa.ListArray.from_arrays(sizes, pairs, type=_HANDED)], names=["tree", "place", "id", "leaf", "claim", "subroot", "steps"])

    for batch in batches:
        for tree, block, ids, leaves, claims, subroot, above in zip(*[batch.column(c).to_pylist() for c in names]):
            rest = [(s["before"], s["after"]) for s in above]
            nodes, root = _appended(block, leaves)
            known = {id(root): rest}
            first = block * FAN_OUT**BLOCK_LEVELS
            for k, (node, doc_id, claim) in enumerate(zip(nodes, ids, claims)):
                rows.append((tree, first + k, doc_id, node.digest, claim, subroot or root.digest, witness(node, known, rest)))
            if len(rows) >= LEAVES_AT_A_TIME:
                yield out()
                rows.clear()
    if rows:
        yield out()


def _sums(sizes: Iterator[int]) -> Iterator[int]:
    total = 0
    for n in sizes:
        total += n
        yield total


_DOWN = f"tree string, place long, id long, leaf string, claim string, subroot string, steps {_WITNESS}"


@dataclass
class Rounds:
    """Blocks of each round of appends, and the roots (tree, leaf) they end in."""

    blocks: list[DataFrame]
    roots: DataFrame


def append_rounds(nodes: DataFrame) -> Rounds:
    """Append (tree, place, id, leaf, claim) block by block, then block roots, until each tree has one root."""
    blocks = []
    while True:
        size = FAN_OUT**BLOCK_LEVELS
        dealt = nodes.withColumn("block", F.floor(F.col("place") / size)).repartition("tree", "block")
        packed = stage(dealt.sortWithinPartitions("tree", "block", "place").mapInArrow(_packed, _BLOCKS), "merkle-blocks")
        blocks.append(packed)
        roots = stage(packed.select("tree", "block", "leaves").mapInArrow(_roots, "tree string, place long, leaf string"), "merkle-roots")
        if roots.where("place > 0").isEmpty():
            return Rounds(blocks, roots)
        nothing = F.lit(None)
        nodes = roots.select("tree", "place", nothing.cast("long").alias("id"), "leaf", nothing.cast("string").alias("claim"))


def hand_down(rounds: Rounds, top: DataFrame) -> DataFrame:
    """Leaves of the first round with their witnesses; ``top`` has (tree, place, subroot, steps) of the last roots."""
    above = top
    for k, blocks in enumerate(reversed(rounds.blocks)):
        above = above.select("tree", F.col("place").alias("block"), "subroot", "steps")
        below = blocks.join(above, ["tree", "block"]).select("tree", "block", "ids", "leaves", "claims", "subroot", "steps")
        above = below.mapInArrow(_handed_down, _DOWN)
        if k < len(rounds.blocks) - 1:
            above = stage(above, "merkle-down")
    return above


def manifest(docs: DataFrame, claim: Column | None = None) -> DataFrame:
    """One row per document: doc_id, leaf, claim, subroot, root and witness.

    ``witness`` lists (before, after) in hexadecimal from the leaf's run up to the root. ``claim`` is
    an expression over the row for the leaf that is to be checked (by default the leaf itself).
    """
    bounded_batches(docs.sparkSession)
    kinds = {"doc_id": "long", "n_chars": "long"}
    rows = docs.select(*[F.col(c).cast(kinds.get(c, "string")).alias(c) for c in FIELDS])
    leaves = rows.select(
        # null sorts before every source
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("tree"),
        F.col("doc_id").alias("id"),
        leaf_digest().alias("leaf"),
        (leaf_digest() if claim is None else claim).alias("claim"),
    )
    leaves = stage(leaves, "merkle-leaves")  # texts are read once: range borders are sampled from this
    sources = append_rounds(placed_rows(leaves, "tree", ["id", "leaf", "claim"], "merkle-places"))
    subroots = sources.roots.select(
        F.lit("").alias("tree"), F.lit(None).cast("long").alias("id"), F.col("leaf"), F.col("tree").alias("claim")
    )
    listed = append_rounds(placed_rows(subroots, "tree", ["claim"], "merkle-sources"))
    last = listed.roots.first()
    root = last["leaf"] if last else None
    nothing = F.array().cast(_WITNESS)
    top = listed.roots.select("tree", "place", F.lit(None).cast("string").alias("subroot"), nothing.alias("steps"))
    of_sources = hand_down(listed, top).select(
        F.col("claim").alias("tree"), F.lit(0).cast("long").alias("place"), F.col("leaf").alias("subroot"), "steps"
    )
    rows = hand_down(sources, stage(of_sources, "merkle-sources"))
    return rows.select(
        F.col("id").alias("doc_id"), "leaf", "claim", "subroot", F.lit(root).cast("string").alias("root"), F.col("steps").alias("witness")
    )


def verified(rows: DataFrame) -> DataFrame:
    """What a manifest's claims fold up to: proof_sha256, folded_root, and whether that is the root."""
    folded = rows.withColumns({"proof_sha256": witness_digest(F.col("witness")), "folded_root": fold(F.col("claim"), F.col("witness"))})
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
