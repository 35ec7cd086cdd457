"""Token counts from an exact histogram of encoded lengths.

Documents are encoded in Arrow batches and counted by length inside each task, so
one row per task and length is shuffled. Suffix sums over the histogram answer, for
every context limit, how many documents reach it, their tokens, and the tokens left
if every text is cut at the limit; quantiles are read from the same sums.

The encoding is a byte-level BPE read from a vocabulary file (``VOCABULARY`` or the
``vocabulary`` argument); special-token strings in a text are ordinary text. Null and
empty texts have length 0 and count as documents; repeated rows count each time. An
empty table gives no rows. Only the text column is read.
"""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorespark.llm.text import bounded_batches
from scorespark.session import stage

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Split of texts into pieces that byte pairs never cross; the one the vocabulary was made with.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
#: Lengths per stretch of the histogram that one task sums up.
STRETCH = 4096


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _encoder(ranks: dict[bytes, int]):
    import tiktoken

    return tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _lengths(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(shared.value).encode_ordinary
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column("text"):
                value = text.as_py()
                counts[len(encode(value)) if value else 0] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], names=["n_tokens", "docs"]
        )

    return run


def length_histogram(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(n_tokens, docs): how many documents have each encoded length."""
    spark = docs.sparkSession
    bounded_batches(spark, rows=500)
    shared = spark.sparkContext.broadcast(read_ranks(vocabulary))
    counted = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_lengths(shared), "n_tokens long, docs long")
    return counted.groupBy("n_tokens").agg(F.sum("docs").alias("docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """For every length that occurs, taken as a context limit: sums over the documents that reach it.

    Columns: n_tokens, docs, docs_from (documents at least as long), tokens_from
    (their tokens), truncated_total (tokens of all documents cut at n_tokens),
    share_below (share of documents that are shorter). Stretches of lengths are
    summed first and only these sums are ordered in one task.
    """
    tall = stage(histogram.withColumn("stretch", F.floor(F.col("n_tokens") / STRETCH)), "token-histogram")
    mass = F.col("n_tokens") * F.col("docs")
    parts = tall.groupBy("stretch").agg(F.sum("docs").alias("d"), F.sum(mass).alias("t"))
    later = Window.orderBy(F.col("stretch").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    parts = parts.select(
        "stretch",
        F.coalesce(F.sum("d").over(later), F.lit(0)).alias("docs_later"),
        F.coalesce(F.sum("t").over(later), F.lit(0)).alias("tokens_later"),
        F.sum("d").over(whole).alias("all_docs"),
        F.sum("t").over(whole).alias("all_tokens"),
    )
    inside = Window.partitionBy("stretch").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, 0)
    summed = tall.withColumns({"_d": F.sum("docs").over(inside), "_t": F.sum(mass).over(inside)}).join(parts, "stretch")
    docs_from, tokens_from = F.col("_d") + F.col("docs_later"), F.col("_t") + F.col("tokens_later")
    return summed.select(
        "n_tokens",
        "docs",
        docs_from.alias("docs_from"),
        tokens_from.alias("tokens_from"),
        (F.col("all_tokens") - tokens_from + F.col("n_tokens") * docs_from).alias("truncated_total"),
        (1 - docs_from / F.col("all_docs")).alias("share_below"),
    )


def truncated_total(sums: DataFrame, limit: int) -> int:
    """Tokens of all documents if each is cut at ``limit``, for limits between the lengths too."""
    reach = sums.where(F.col("n_tokens") >= limit)
    row = reach.orderBy("n_tokens").select("docs_from", "tokens_from").first()
    total = sums.agg(F.max("tokens_from")).first()[0] or 0
    return total - row.tokens_from + limit * row.docs_from if row else total


def length_quantile(sums: DataFrame, share: float) -> int | None:
    """Smallest length that at least ``share`` of the documents do not exceed."""
    total = F.max("docs_from").over(Window.partitionBy())
    reached = sums.withColumn("_n", total).where(F.col("_n") - F.col("docs_from") + F.col("docs") >= share * F.col("_n"))
    return reached.agg(F.min("n_tokens")).first()[0]
