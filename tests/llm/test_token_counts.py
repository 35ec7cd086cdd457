import sys
from collections import Counter

from scorespark.llm.token_counts import (
    VOCABULARY,
    _encoder,
    length_histogram,
    length_quantile,
    read_ranks,
    suffix_sums,
    truncated_total,
)


def test_sums_equal_brute_force(spark, folder, monkeypatch):
    from scorespark.llm import token_counts

    monkeypatch.setattr(token_counts, "STRETCH", 64)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    encode = _encoder(read_ranks(VOCABULARY)).encode_ordinary
    lengths = [len(encode(r.text)) for r in docs.select("text").collect()]
    sums = suffix_sums(length_histogram(docs)).cache()
    assert {r.n_tokens: r.docs for r in sums.collect()} == Counter(lengths)
    for r in sums.collect():
        longer = [n for n in lengths if n >= r.n_tokens]
        assert (r.docs_from, r.tokens_from) == (len(longer), sum(longer))
        assert r.truncated_total == sum(min(n, r.n_tokens) for n in lengths)
        assert abs(r.share_below - (1 - len(longer) / len(lengths))) < 1e-12
    for limit in (0, 1, 77, 1000, 10**7):
        assert truncated_total(sums, limit) == sum(min(n, limit) for n in lengths)
    ordered = sorted(lengths)
    for share in (0.1, 0.5, 0.99, 1.0):
        assert length_quantile(sums, share) == ordered[max(0, -(-int(share * 1000) * len(ordered) // 1000) - 1)]


def test_same_tokens_as_the_published_tokenizer():
    sys.path.insert(0, "/opt/tokenizers")
    from tokenizers import Tokenizer

    ours = _encoder(read_ranks(VOCABULARY))
    theirs = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    theirs.encode_special_tokens = True
    for text in ("Hello  world\n\n x", "it's 3,14 €  ", "<|endoftext|> é", "\t\ttab", "a" * 3000, "   "):
        assert ours.encode_ordinary(text) == theirs.encode(text, add_special_tokens=False).ids


def test_edge_rows(spark):
    rows = [(1, None, 5), (2, "", 5), (3, "one", 5), (3, "one", 5), (4, "word " * 50000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = {r.n_tokens: r.docs for r in suffix_sums(length_histogram(docs)).collect()}
    assert got[0] == 2 and got[1] == 2 and sum(got.values()) == 5
    empty = suffix_sums(length_histogram(docs.limit(0)))
    assert empty.count() == 0 and truncated_total(empty, 10) == 0 and length_quantile(empty, 0.5) is None
