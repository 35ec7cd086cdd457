"""Trie of conversation prefixes, totals of subtrees by time-forward processing.

Every distinct sequence of first d turns is a node. A turn's digest together with its place
is summed up along the conversation; the sum after d turns (256 bits) names the node,
so conversations that begin alike meet without comparing them. Rows of one conversation
may lie in many partitions.

Totals flow from children to parents as messages through time, which runs against the
levels: a shard's nodes are sorted externally by level, deepest first, a node takes its
messages from a priority queue that spills to files, and sends its own total on.

* A shard holds whole pieces of the trie: connected nodes whose numbers of conversations
  have the same tier (between two powers of ``TIER``), cut every ``LEVELS`` levels. A piece has
  at most ``TIER`` nodes a level, however many conversations share a prefix.
* Totals of piece roots are messages for the pieces above. Rounds go by tier, the
  deepest band first, so all messages for a piece are there when it is processed; those
  for one node are added up before they are shuffled.

Rows without conv_id take no part; null role or text counts as empty. Turns go by number,
null first; turns of one number by their digest. Conversations without any turn left
are members of the root. Without conversations there is no root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorespark.llm.ordered import DIGEST, placed_rows
from scorespark.llm.text import bounded_batches
from scorespark.session import stage

#: Pieces hold nodes whose numbers of conversations lie between two powers of this.
TIER = 64
#: Levels of a piece.
LEVELS = 256
#: Powers of TIER that tell tiers apart: 64**10 conversations.
TIERS = 10
#: Messages that a queue holds in memory.
IN_MEMORY = 200_000
#: Bytes of listed conversations that make a part.
PART_BYTES = 1 << 20
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_digest(role: Column, text: Column) -> Column:
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.sha2(whole.cast("binary"), 256))


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, bytes, place): turns in the order of their conversation, place from 0."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        turn_digest(role, text).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    return placed_rows(stage(turns, "trie-turns"), "conv_id", ["turn", "digest"], "trie-places")


def with_shared_starts(turns: DataFrame, group: int = 5, most: int = 8) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of their group's first one.

    Conversation c begins with the first h turns of c - c % group, h = crc32 of c % (most + 1), and goes
    on with its own turns after its first h. Returns the turns (conv_id, place, digest, bytes) and the
    conversations (conv_id, length).
    """
    c = F.col("conv_id")
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("own")).withColumns(
        {"h": F.crc32(c.cast("string").cast("binary")) % (most + 1), "base": c - c % group}
    )
    convs = stage(convs, "trie-convs")
    bases = convs.select(F.col("conv_id").alias("base"), F.col("own").alias("there"))
    convs = convs.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("there", F.lit(0))))
    length = (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length")
    convs = stage(convs.select("conv_id", "base", "h", "taken", length), "trie-convs")
    own = turns.join(convs, "conv_id").where("place >= h").withColumn("place", F.col("taken") + F.col("place") - F.col("h"))
    starts = turns.where(F.col("place") < most).withColumnRenamed("conv_id", "base")
    starts = starts.join(convs, "base").where("place < h")
    columns = ["conv_id", "place", "digest", "bytes"]
    return own.select(columns).unionByName(starts.select(columns)), convs.select("conv_id", "length")


def paths(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, depth, key, before, bytes) for every conversation and number of first turns; root rows have no ``before``."""
    step = F.unhex(F.sha2(F.concat_ws(":", F.col("place").cast("string"), F.hex("digest")).cast("binary"), 256))
    rows = turns.select("conv_id", F.col("place").alias("nth"), "bytes", step.alias("step"))
    summed = placed_rows(stage(rows, "trie-rebuilt"), "conv_id", ["nth"], "trie-sums", digest="step")
    below = summed.select("conv_id", (F.col("place") + 1).alias("depth"), F.col("sum").alias("key"), "before", "bytes")
    nothing = F.lit(None).cast("binary")
    root = convs.select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(bytes(DIGEST)).alias("key"), nothing.alias("before"), F.lit(0).cast("long").alias("bytes")
    )
    return stage(root.unionByName(below), "trie-paths")


def trie_nodes(rows: DataFrame) -> DataFrame:
    """One row per node: key, before, depth, conv_id (smallest member), n_convs, own (tokens saved at the node)."""
    nodes = rows.groupBy("key", "before", "depth", "bytes").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    return nodes.select("key", "before", "depth", "conv_id", "n_convs", ((F.col("n_convs") - 1) * F.col("bytes")).alias("own"))


def _cut(nodes: DataFrame, rows: DataFrame, tier: int, levels: int) -> DataFrame:
    """Nodes with tier, band and piece (key of the piece's root)."""
    powers = [tier**k for k in range(1, TIERS + 1) if tier**k < 1 << 62]
    tiers = sum((F.col("n_convs") > p).cast("int") for p in powers)
    nodes = stage(nodes.withColumn("tier", tiers), "trie-nodes")
    # along a conversation tiers go down: where the last node of a higher tier is
    heavy = nodes.where("tier > 0").select("key", "tier")
    last = rows.select("conv_id", "depth", "key").join(heavy, "key").groupBy("conv_id").agg(
        *[F.max(F.when(F.col("tier") > k, F.col("depth"))).alias(f"last{k}") for k in range(len(powers))]
    )
    start = F.lit(0).cast("long")
    for k in range(len(powers)):
        start = F.when(F.col("tier") == k, F.coalesce(F.col(f"last{k}") + 1, F.lit(0))).otherwise(start)
    placed = nodes.join(last, "conv_id", "left").withColumn("start", start)
    placed = placed.withColumn("band", F.floor((F.col("depth") - F.col("start")) / levels)).select(
        *nodes.columns, "band", (F.col("start") + F.col("band") * levels).alias("top")
    )
    roots = rows.select("conv_id", F.col("depth").alias("top"), F.col("key").alias("piece"))
    return stage(placed.join(roots, ["conv_id", "top"]).drop("top"), "trie-pieces")


class SpillingQueue:
    """Messages by (time, address), smallest first; beyond ``limit`` they wait in sorted files."""

    def __init__(self, limit: int, folder: str):
        self.limit, self.folder = limit, folder
        self.heap: list[tuple] = []
        self.runs: list[tuple[tuple, int, Iterator[tuple]]] = []
        self.files = 0

    def push(self, message: tuple) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        path = os.path.join(self.folder, str(self.files))
        self.files += 1
        with open(path, "wb") as f:
            for message in sorted(self.heap):
                pickle.dump(message, f, protocol=5)
        self.heap.clear()
        self._next(self.files, self._read(path))

    @staticmethod
    def _read(path: str) -> Iterator[tuple]:
        with open(path, "rb") as f:
            while True:
                try:
                    yield pickle.load(f)
                except EOFError:
                    break
        os.remove(path)

    def _next(self, number: int, run: Iterator[tuple]) -> None:
        message = next(run, None)
        if message is not None:
            heapq.heappush(self.runs, (message, number, run))

    def take(self, address: tuple) -> Iterator[tuple]:
        """All messages for ``address``, which is not after any other that still waits."""
        while True:
            if self.heap and self.heap[0][:2] == address:
                yield heapq.heappop(self.heap)
            elif self.runs and self.runs[0][0][:2] == address:
                message, number, run = heapq.heappop(self.runs)
                self._next(number, run)
                yield message
            else:
                return


_TOTALS = (
    "key binary, before binary, depth long, conv_id long, n_convs long, piece binary,"
    " n_children long, n_leaves long, saved_tokens long"
)


def _forward(limit: int):
    """Totals of nodes that come deepest first, with what pieces below have sent them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _TOTALS.split(",")]
        with tempfile.TemporaryDirectory(prefix="trie-") as folder:
            queue = SpillingQueue(limit, folder)
            for batch in batches:
                children_, leaves_, saved_ = [], [], []
                columns = ("key", "before", "depth", "piece", "own", "sent_children", "sent_leaves", "sent_saved")
                for key, before, depth, piece, own, children, leaves, saved in zip(*[batch.column(c).to_pylist() for c in columns]):
                    children, leaves, saved = children or 0, leaves or 0, own + (saved or 0)
                    for _, _, more, total in queue.take((-depth, key)):
                        children, leaves, saved = children + 1, leaves + more, saved + total
                    leaves = leaves or 1
                    if key != piece:
                        queue.push((1 - depth, before, leaves, saved))
                    children_.append(children)
                    leaves_.append(leaves)
                    saved_.append(saved)
                kept = [batch.column(c) for c in names[:6]]
                yield pa.RecordBatch.from_arrays([*kept, *[pa.array(c, pa.int64()) for c in (children_, leaves_, saved_)]], names=names)

    return run


def subtree_totals(nodes: DataFrame, limit: int = IN_MEMORY) -> DataFrame:
    """Nodes cut into pieces to nodes with n_children, n_leaves and saved_tokens."""
    steps = sorted({(r["tier"], -r["band"]) for r in nodes.select("tier", "band").distinct().collect()})
    done: DataFrame | None = None
    for tier, band in steps:
        own = nodes.where((F.col("tier") == tier) & (F.col("band") == -band))
        if done is None:
            sent = [F.lit(None).cast("long").alias(c) for c in ("sent_children", "sent_leaves", "sent_saved")]
            own = own.select("*", *sent)
        else:
            roots = done.where("key = piece").groupBy(F.col("before").alias("key"))
            messages = roots.agg(
                F.count("*").alias("sent_children"), F.sum("n_leaves").alias("sent_leaves"), F.sum("saved_tokens").alias("sent_saved")
            )
            own = own.join(messages, "key", "left")
        shards = own.repartition("piece").sortWithinPartitions(F.desc("depth"), "key")
        totals = stage(shards.mapInArrow(_forward(limit), _TOTALS), "trie-totals")
        done = totals if done is None else done.unionByName(totals)
    return done


def _listed(part_bytes: int):
    """Sorted (key, conv_id) to parts of the list of each key: (key, first, part)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.binary(), pa.int64(), pa.string()]
        held: list = []
        size = 0

        def out(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*[(key, ids[0], ",".join(map(str, ids))) for key, ids in rows]), kinds)],
                names=["key", "first", "part"],
            )

        for batch in batches:
            for key, conv_id in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
                if not held or held[-1][0] != key:
                    held.append((key, []))
                held[-1][1].append(conv_id)
                size += 20
                if size >= part_bytes:
                    yield out(held)
                    held, size = [], 0
        if held:
            yield out(held)

    return run


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, state = None, hashlib.sha256()
    for batch in batches:
        keys, digests = [], []
        for own, part in zip(batch.column("key").to_pylist(), batch.column("part").to_pylist()):
            if own == key:
                state.update(b",")
            else:
                if key is not None:
                    keys.append(key)
                    digests.append(state.hexdigest())
                key, state = own, hashlib.sha256()
            state.update(part.encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests, pa.string())], names=["key", "ends_sha256"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], names=["key", "ends_sha256"])


def ends_digests(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """(key, ends_sha256) of nodes at which conversations end.

    A digest takes its input in order, so a node's parts meet in one task, as a few rows of up to
    a megabyte that are read one after another; the lists are made in range partitions.
    """
    last = rows.join(convs, (rows["conv_id"] == convs["conv_id"]) & (rows["depth"] == convs["length"])).select("key", rows["conv_id"])
    parts = stage(last, "trie-ends").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    parts = parts.mapInArrow(_listed(PART_BYTES), "key binary, first long, part string")
    return parts.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_hashed, "key binary, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame, tier: int = TIER, levels: int = LEVELS, limit: int = IN_MEMORY) -> DataFrame:
    """One row per node of the conversations (conv_id, length) with ``turns`` (conv_id, place, digest, bytes).

    Columns: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    bounded_batches(turns.sparkSession)
    rows = paths(turns, convs)
    if rows.isEmpty():
        empty = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
        return turns.sparkSession.createDataFrame([], empty)
    totals = subtree_totals(_cut(trie_nodes(rows), rows, tier, levels), limit)
    parents = totals.select(F.col("key").alias("before"), F.col("conv_id").alias("parent_conv_id"))
    out = totals.join(parents, "before", "left").join(ends_digests(rows, convs), "key", "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    )


def shared_trie(conversations: DataFrame, **kwargs) -> DataFrame:
    """:func:`trie` of conversations rebuilt by :func:`with_shared_starts`."""
    bounded_batches(conversations.sparkSession)
    turns, convs = with_shared_starts(numbered_turns(conversations))
    return trie(turns, convs, **kwargs)
