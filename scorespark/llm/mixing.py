"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Everything is DataFrame expressions.

1. Sources, in code-point order with null last, weigh ``weights`` in turn and
   share all words; no target exceeds ``max_repeat`` times its source's size, and
   what is cut off is shared again by weight (closed form: sources sorted by cap
   over weight, running sums).
2. Documents fall by a keyed hash into blocks of about ``block_docs`` documents of
   one source. A source's target is so many whole rounds of all its blocks, then
   further blocks in a keyed order; the block at the border is cut by documents,
   the document at the border by words. So a source that holds a third of all
   rows is many blocks, and targets are met to the word.
3. Every taking of a block is a draw. A binary tree over the output shards splits
   each node's draws in two halves whose counts by source follow the multivariate
   hypergeometric distribution (drawn source by source by the Gumbel-max rule from
   the exact probabilities); the leaves hold exact quotas. A source's draws, in a
   keyed permutation, go to the shards in disjoint stretches of these lengths.

Null text has size 0; null sources are one source; rows without doc_id count like
others, rows that repeat doc_id and text share their place in the order. With no
words at all every target is 0. Columns of the input named like an added column
are replaced. The number of sources must fit one task (a row each); only such
tables are broadcast, after their rows have been counted.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorespark.llm.text import WORD_PATTERN
from scorespark.session import stage

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
SHARDS = 16
BLOCK_DOCS = 1024
SEED = 20240229
#: Rows of a table of sources or blocks that may be broadcast; each has a few dozen bytes.
BROADCAST_ROWS = 4_000
#: Blocks or draws of a source that one task sums up.
STRETCH = 4096
ADDED = ("size", "source_size", "target", "taken", "shards", "places")


def _uniform(*parts: Column | str | int) -> Column:
    """A number strictly between 0 and 1 for a key."""
    key = F.xxhash64(F.lit(SEED), *[F.lit(p) if isinstance(p, int) else p for p in parts])
    return (F.shiftrightunsigned(key, 12).cast("double") + 0.5) / float(1 << 52)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def _sized(docs: DataFrame) -> DataFrame:
    """The rows as one column ``_doc``, so that no column of theirs clashes, and what is computed on."""
    text = F.col("text")
    return docs.select(
        F.struct("*").alias("_doc"),
        F.col("source").cast("string").alias("_mix_source"),
        word_count(text).alias("_mix_size"),
        F.xxhash64(F.lit(SEED), F.col("doc_id").cast("long"), text).alias("_mix_h"),
    )


def _small(df: DataFrame) -> DataFrame:
    """``df``, a written table, to be broadcast if its counted rows allow."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def source_targets(sized: DataFrame, weights: Sequence[float], max_repeat: int, block_docs: int) -> DataFrame:
    """One row per source: size, target, whole rounds and the words of the round that is cut."""
    sources = sized.groupBy("_mix_source").agg(
        F.sum("_mix_size").alias("source_size"), F.count(F.lit(1)).alias("_docs")
    )
    by_name = Window.orderBy(F.col("_mix_source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    everything = Window.partitionBy()
    ranked = sources.withColumns(
        {"source_no": F.row_number().over(by_name) - 1, "_total": F.sum("source_size").over(everything)}
    ).withColumns(
        {
            "_weight": F.get(cycle, F.col("source_no") % len(weights)),
            "_cap": (F.col("source_size") * max_repeat).cast("double"),
        }
    )
    by_room = Window.orderBy(F.col("_cap") / F.col("_weight"), "source_no")
    before, rest = by_room.rowsBetween(Window.unboundedPreceding, -1), by_room.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_weight").over(rest)
    filled = ranked.withColumn("_level", level).withColumn("_capped", F.col("_level") * F.col("_weight") > F.col("_cap"))
    common = F.max(F.when(~F.col("_capped"), F.col("_level"))).over(everything)
    target = F.when(F.col("_capped"), F.col("_cap")).otherwise(F.least("_cap", common * F.col("_weight")))
    words = F.round("target").cast("long")
    return filled.withColumn("target", target).select(
        "_mix_source",
        "source_no",
        "source_size",
        "target",
        F.greatest(F.lit(1), F.ceil(F.col("_docs") / block_docs)).cast("long").alias("_blocks"),
        F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0).cast("long").alias("_rounds"),
        F.when(F.col("source_size") > 0, words % F.col("source_size")).otherwise(0).cast("long").alias("_rest"),
    )


def _hypergeometric(total: Column, of_kind: Column, drawn: Column, *key: Column) -> Column:
    """How many of ``of_kind`` are among ``drawn`` of ``total`` things, as a keyed draw.

    All values within ten standard deviations compete by log probability plus
    Gumbel noise.
    """
    n, k, m = total, of_kind, drawn
    mean = m * k / F.greatest(n, F.lit(1.0))
    spread = F.sqrt(F.greatest(mean * (n - k) / F.greatest(n, F.lit(1.0)) * (n - m) / F.greatest(n - 1, F.lit(1.0)), F.lit(0.0)))
    low = F.greatest(F.lit(0.0), m - (n - k), F.floor(mean - 10 * spread - 10).cast("double"))
    high = F.least(k, m, F.ceil(mean + 10 * spread + 10).cast("double"))
    start = F.struct(F.lit(0.0).alias("logp"), F.lit(float("-inf")).alias("best"), low.alias("value"))

    def step(state: Column, x: Column) -> Column:
        score = state["logp"] - F.log(-F.log(_uniform(*key, x)))
        factor = (k - x) * (m - x) / ((x + 1) * F.greatest(n - k - m + x + 1, F.lit(1.0)))
        return F.struct(
            (state["logp"] + F.log(F.greatest(factor, F.lit(1e-300)))).alias("logp"),
            F.greatest(score, state["best"]).alias("best"),
            F.when(score > state["best"], x.cast("double")).otherwise(state["value"]).alias("value"),
        )

    return F.aggregate(F.sequence(low.cast("long"), high.cast("long")), start, step, lambda s: s["value"])


def split_quotas(draws: DataFrame, shards: int) -> DataFrame:
    """From (source_no, n) to (source_no, shard, n): exact quotas of draws at the leaves of the tree."""
    depth = int(log2(shards))
    if 2**depth != shards:
        raise ValueError("the number of shards must be a power of two")
    nodes = draws.agg(
        F.sort_array(F.collect_list(F.struct("source_no", F.col("n").cast("double").alias("n")))).alias("kinds")
    ).select(F.lit(1).alias("node"), "kinds")
    kind_type = "array<struct<source_no:int,n:double>>"
    for _ in range(depth):
        total = F.aggregate("kinds", F.lit(0.0), lambda a, x: a + x["n"])
        start = F.struct(
            total.alias("total"), F.floor((total + 1) / 2).cast("double").alias("drawn"), F.array().cast(kind_type).alias("left")
        )

        def step(state: Column, kind: Column) -> Column:
            took = _hypergeometric(state["total"], kind["n"], state["drawn"], F.col("node"), kind["source_no"])
            return F.transform(
                F.array(took),
                lambda t: F.struct(
                    (state["total"] - kind["n"]).alias("total"),
                    (state["drawn"] - t).alias("drawn"),
                    F.concat(state["left"], F.array(F.struct(kind["source_no"].alias("source_no"), t.alias("n")))).alias("left"),
                ),
            )[0]

        left = F.aggregate("kinds", start, step, lambda s: s["left"])
        right = F.zip_with("kinds", F.col("_left"), lambda a, b: F.struct(a["source_no"].alias("source_no"), (a["n"] - b["n"]).alias("n")))
        nodes = (
            nodes.withColumn("_left", left)
            .select(
                F.explode(
                    F.array(
                        F.struct((F.col("node") * 2).alias("node"), F.col("_left").alias("kinds")),
                        F.struct((F.col("node") * 2 + 1).alias("node"), right.alias("kinds")),
                    )
                ).alias("child")
            )
            .select("child.node", F.col("child.kinds").cast(kind_type).alias("kinds"))
        )
    leaves = nodes.select((F.col("node") - shards).alias("shard"), F.explode("kinds").alias("kind"))
    return leaves.select("kind.source_no", "shard", F.col("kind.n").cast("long").alias("n"))


def _block(blocks: str = "_blocks") -> Column:
    return F.pmod(F.xxhash64(F.col("_mix_h")), F.col(blocks))


def _running(rows: DataFrame, value: str, column: str, stretch: int = STRETCH) -> DataFrame:
    """``column``: the sum of ``value`` over the rows of the source that come before in the order of ``_at``.

    ``_at`` is a hash, so its top bits deal a source's rows into stretches of about ``stretch`` rows; sums
    run inside a stretch and over the table of stretches. No task sees a whole source. ``rows``
    is a written table; rows equal in ``_at`` are told apart by block and copy.
    """
    counts = rows.groupBy("source_no").agg(F.count(F.lit(1)).alias("_n"))
    bits = F.least(F.lit(40), F.greatest(F.lit(0), F.ceil(F.log2(F.col("_n") / stretch)))).cast("int").alias("_bits")
    counts = stage(counts.select(F.col("source_no").alias("_of"), bits), "mix-stretches")
    ties = [c for c in ("block", "copy") if c in rows.columns]
    # ascending hash order: the sign bit is turned round before the top bits are taken
    top = F.expr("CASE WHEN _bits = 0 THEN 0L ELSE shiftrightunsigned(_at ^ -9223372036854775808L, 64 - _bits) END")
    dealt = rows.join(_small(counts), rows["source_no"] == counts["_of"]).withColumn("_stretch", top).drop("_of", "_bits")
    sums = dealt.groupBy("source_no", "_stretch").agg(F.sum(value).alias("_sum"))
    over = Window.partitionBy("source_no").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("source_no", "_stretch", F.coalesce(F.sum("_sum").over(over), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("source_no", "_stretch").orderBy("_at", *ties).rowsBetween(Window.unboundedPreceding, -1)
    summed = dealt.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    out = summed.join(starts, ["source_no", "_stretch"]).withColumn(column, F.col("_start") + F.col("_inside"))
    return out.drop("_stretch", "_start", "_inside")


def _block_plan(sized: DataFrame, sources: DataFrame, shards: int) -> DataFrame:
    """One row per block: how often it is taken whole, where the cut round ends in it, shards of its draws."""
    blocks = (
        sized.join(_small(sources), sized["_mix_source"].eqNullSafe(sources["_mix_source"]))
        .withColumn("block", _block())
        .groupBy("source_no", "block", "_rounds", "_rest")
        .agg(F.sum("_mix_size").alias("words"))
    )
    blocks = stage(blocks.withColumn("_at", F.xxhash64(F.lit(SEED + 1), "source_no", "block")), "mix-block-sizes")
    blocks = _running(blocks, "words", "_before")
    left = F.col("_rest") - F.col("_before")  # words of the cut round from this block on
    cut = stage(
        blocks.select(
            "source_no",
            "block",
            "_rounds",
            F.when((left >= F.col("words")) & (F.col("words") > 0), 1).otherwise(0).cast("long").alias("_once_more"),
            F.when((left > 0) & (left < F.col("words")), left).otherwise(0).alias("_part"),
        ),
        "mix-blocks",
    )
    draws = cut.withColumn("copies", F.col("_rounds") + F.col("_once_more") + (F.col("_part") > 0).cast("long"))
    per_source = draws.groupBy("source_no").agg(F.sum("copies").alias("n"))
    quotas = split_quotas(per_source, shards)
    ends = quotas.groupBy("source_no").agg(F.sort_array(F.collect_list(F.struct("shard", "n"))).alias("quota"))
    ends = ends.select(
        F.col("source_no").alias("_no"),
        F.transform(
            F.sequence(F.lit(1), F.lit(shards)),
            lambda k: F.aggregate(F.slice("quota", F.lit(1), k), F.lit(0).cast("long"), lambda a, x: a + x["n"]),
        ).alias("ends"),
    )
    each = draws.where("copies > 0").select("source_no", "block", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
    each = each.withColumns({"_at": F.xxhash64(F.lit(SEED + 2), "source_no", "block", "copy"), "_one": F.lit(1).cast("long")})
    placed = _running(stage(each, "mix-draws"), "_one", "_earlier").withColumn("rank", F.col("_earlier") + 1)
    placed = placed.join(ends, placed["source_no"] == ends["_no"]).select(
        "source_no", "block", "copy", F.size(F.filter("ends", lambda e: e < F.col("rank"))).alias("shard")
    )
    where = placed.groupBy(F.col("source_no").alias("_no"), F.col("block").alias("_b")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("copy", "shard"))), lambda x: x["shard"]).alias("shards")
    )
    return draws.join(where, (draws["source_no"] == where["_no"]) & (draws["block"] == where["_b"]), "left").select(
        "source_no", "block", "_once_more", "_part", F.coalesce("shards", F.array().cast("array<int>")).alias("_block_shards")
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    max_repeat: int = MAX_REPEAT,
    shards: int = SHARDS,
    block_docs: int = BLOCK_DOCS,
    with_text: bool = True,
) -> DataFrame:
    """``docs`` with size, source_size, target (of its source), taken (words, repeats counted) and
    shards and places (of each copy, whole copies first): the leaf of the tree that drew the copy and
    its keyed place in the order of that shard. ``taken`` adds up what the leaves have drawn. The
    copies as rows: :func:`shard_rows`. ``with_text=False`` returns doc_id and these only.
    """
    sized = stage(
        _sized(docs).select(
            F.struct(F.col("_doc.doc_id").cast("long").alias("doc_id")).alias("_doc"), "_mix_source", "_mix_size", "_mix_h"
        ),
        "mix-sizes",
    )
    sources = stage(source_targets(sized, weights, max_repeat, block_docs), "mix-sources")
    plan = stage(_block_plan(sized, sources, shards), "mix-plan")
    cut_blocks = plan.where("_part > 0").select("source_no", "block", "_part")
    placed = (
        sized.join(_small(sources), sized["_mix_source"].eqNullSafe(sources["_mix_source"]))
        .withColumn("block", _block())
        .select("source_no", "block", "_mix_h", "_mix_size")
        .join(cut_blocks, ["source_no", "block"])
    )
    in_block = Window.partitionBy("source_no", "block").orderBy("_mix_h").rangeBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_mix_size").over(in_block), F.lit(0))
    border = (
        placed.withColumn("_extra", F.greatest(F.lit(0), F.least(F.col("_mix_size"), F.col("_part") - before)))
        .where("_extra > 0")
        .groupBy(F.col("source_no").alias("_border_no"), F.col("_mix_h").alias("_border_h"))
        .agg(F.max("_extra").alias("_extra"))
    )
    rows = _sized(docs) if with_text else sized
    source_columns = sources.withColumnRenamed("_mix_source", "_name")
    out = rows.join(_small(source_columns), rows["_mix_source"].eqNullSafe(source_columns["_name"])).withColumn("_at", _block())
    plan = plan.withColumnsRenamed({"source_no": "_plan_no", "block": "_plan_block"})
    out = out.join(_small(plan), (out["source_no"] == plan["_plan_no"]) & (out["_at"] == plan["_plan_block"]))
    border = stage(border, "mix-border")
    out = out.join(
        _small(border), (out["source_no"] == border["_border_no"]) & (out["_mix_h"] == border["_border_h"]), "left"
    )
    size, extra = F.col("_mix_size"), F.coalesce("_extra", F.lit(0))
    drawn = F.size("_block_shards")  # what the leaves have drawn of the block; a cut copy is the last
    is_cut = F.col("_part") > 0
    whole = drawn - F.when(is_cut & (drawn > 0), 1).otherwise(0)
    shards_of = F.when(is_cut & (extra == 0), F.slice("_block_shards", F.lit(1), whole)).otherwise(F.col("_block_shards"))
    kept = [c for c in docs.columns if c not in ADDED] if with_text else ["doc_id"]
    return out.select(
        *[F.col("_doc").getField(c).alias(c) for c in kept],
        size.alias("size"),
        "source_size",
        "target",
        (whole * size + F.when(is_cut & (drawn > 0), extra).otherwise(0)).alias("taken"),
        shards_of.alias("shards"),
        F.transform(shards_of, lambda shard, copy: F.xxhash64(F.lit(SEED + 3), shard, copy, F.col("_mix_h"))).alias("places"),
    )


def shard_rows(mixed: DataFrame) -> DataFrame:
    """The mix itself: a row per copy with its ``shard`` and ``place``, the keyed order inside the shard, and ``words``.

    Sort or write by (shard, place): each shard is then shuffled by itself. A copy has all words of its
    document but for the last one of a document at a cut.
    """
    copies = F.arrays_zip("shards", "places")
    columns = [c for c in mixed.columns if c not in ADDED]
    rows = mixed.select(*columns, "size", "taken", F.posexplode(copies).alias("_copy", "_drawn"))
    words = F.least(F.col("size"), F.greatest(F.lit(0), F.col("taken") - F.col("_copy") * F.col("size")))
    return rows.select(*columns, F.col("_drawn.shards").alias("shard"), F.col("_drawn.places").alias("place"), words.alias("words"))


def write_shards(mixed: DataFrame, path: str, parts_per_shard: int = 1) -> None:
    """Write the copies as one folder per shard; inside a shard they lie in the order of ``place``.

    With more parts, the places of a shard are cut into as many stretches, a task each.
    """
    rows = shard_rows(mixed)
    top = F.shiftrightunsigned(F.col("place").bitwiseXOR(F.lit(-(1 << 63))), 33)
    part = F.floor(top * parts_per_shard / float(1 << 31)).cast("int")
    dealt = rows.withColumn("part", part).repartition("shard", "part").sortWithinPartitions("shard", "part", "place")
    dealt.write.partitionBy("shard", "part").parquet(path)
