"""Registered queries of this subpackage: thin digests of what its operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from scorespark.llm import decontaminate, exact_dedup, html_main, lm_score, merkle, mixing, near_dedup, pii, prefix_trie, quality, suffix_dedup, token_counts, vectors

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(_table(spark, sf_dir, "documents"), width=3, percent=85)


def op3_html_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract_pages(_table(spark, sf_dir, "pages"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_entities(_table(spark, sf_dir, "documents")).select("doc_id", "text", "n_entities")


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.lm_scores(_table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"), with_text=False)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "shards", "places")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.suffix_sums(token_counts.length_histogram(_table(spark, sf_dir, "documents")))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    stretches = suffix_dedup.repeated_stretches(_table(spark, sf_dir, "documents"))
    return stretches.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.shared_trie(_table(spark, sf_dir, "conversations"))


def op12_vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return vectors.top_k(rows, rows.where("vec_id % 50 = 0"), k=5)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = merkle.verified(merkle.manifest(_table(spark, sf_dir, "documents"), claim=merkle.lower_cased()))
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_quality,
        op2_near_dedup,
        op3_html_main,
        op4_exact_dedup,
        op5_decontaminate,
        op6_pii,
        op7_lm_score,
        op8_mixing,
        op9_token_counts,
        op10_suffix_dedup,
        op11_prefix_trie,
        op12_vector_topk,
        op13_merkle_manifest,
    )
}

def crc32_sql(text: str) -> str:
    """Unsigned crc32 of an ASCII string in the checking SQL."""
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: CAST(ord(substr({text}, i, 1)) AS BIGINT))"
    bits = "list_concat([xor(c, b)], [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0])"
    step = f"list_reduce({bits}, lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, CAST(3988292384 AS BIGINT)) ELSE v >> 1 END)"
    start = "[CAST(4294967295 AS BIGINT)]"
    return f"xor(list_reduce(list_concat({start}, {codes}), lambda c, b: {step}), CAST(4294967295 AS BIGINT))"


def _leaf_sql(text: str) -> str:
    def field(value: str) -> str:
        return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}) || ':' || {value} END"

    return "sha256(" + " || ".join(field(f) for f in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)) + ")"


SQL: dict[str, str] = {
    "op4_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) = 1 AS kept,
       text_sha256
FROM d""",
    "op11_prefix_trie": f"""
WITH own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                            sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT DISTINCT conv_id, conv_id - conv_id % 5 AS base, {crc32_sql("CAST(conv_id AS VARCHAR)")} % 9 AS h FROM own),
joined AS (
  SELECT c.conv_id, 0 AS part, o.place, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.base AND o.place < c.h
  UNION ALL
  SELECT c.conv_id, 1, o.place, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.place >= c.h),
turns AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY part, place) AS depth FROM joined),
rows AS (
  SELECT conv_id, depth, strlen(text) AS bytes,
         string_agg(sha256(strlen(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM turns
  UNION ALL
  SELECT conv_id, 0, 0, '' FROM convs),
ends AS (SELECT conv_id, max(depth) AS length FROM rows GROUP BY conv_id),
nodes AS (
  SELECT r.depth, r.path, min(r.conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(r.bytes) AS own,
         sha256(coalesce(string_agg(CAST(r.conv_id AS VARCHAR), ',' ORDER BY r.conv_id) FILTER (e.length = r.depth), '')) AS ends_sha256
  FROM rows r JOIN ends e ON e.conv_id = r.conv_id GROUP BY r.depth, r.path),
kids AS (SELECT p.path, count(*) AS n FROM nodes p JOIN nodes k ON k.depth = p.depth + 1 AND k.path[:64 * p.depth] = p.path GROUP BY p.path),
below AS (SELECT DISTINCT a.path, b.path AS under FROM rows a JOIN rows b ON a.conv_id = b.conv_id AND b.depth >= a.depth),
totals AS (
  SELECT b.path, count(*) FILTER (k.n IS NULL) AS n_leaves, sum(n.own) AS saved
  FROM below b JOIN nodes n ON n.path = b.under LEFT JOIN kids k ON k.path = b.under GROUP BY b.path)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children,
       t.n_leaves, CAST(t.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN totals t ON t.path = n.path LEFT JOIN kids k ON k.path = n.path
LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[:64 * (n.depth - 1)] AND p.depth = n.depth - 1""",
    "op12_vector_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op13_merkle_manifest": f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, {_leaf_sql("text")} AS leaf,
         CASE WHEN {crc32_sql("CAST(doc_id AS VARCHAR)")} % 5 = 0
              THEN {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
              ELSE {_leaf_sql("text")} END AS claim
  FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS pos FROM leaves),
nodes AS (
  SELECT tree, 0 AS lvl, pos, leaf AS digest, count(*) OVER (PARTITION BY tree) AS n FROM placed
  UNION ALL
  SELECT tree, lvl + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)), count(*) OVER (PARTITION BY tree)
  FROM nodes WHERE n > 1 GROUP BY tree, lvl, pos // 16),
tops AS (SELECT tree, digest, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos FROM nodes WHERE n = 1),
upper_nodes AS (
  SELECT 0 AS lvl, pos, digest, count(*) OVER () AS n FROM tops
  UNION ALL
  SELECT lvl + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)), count(*) OVER ()
  FROM upper_nodes WHERE n > 1 GROUP BY lvl, pos // 16),
kin AS (
  SELECT a.tree, a.lvl, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS before,
         coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS after
  FROM nodes a JOIN nodes b ON a.tree = b.tree AND a.lvl = b.lvl AND a.pos // 16 = b.pos // 16
  WHERE a.n > 1 GROUP BY a.tree, a.lvl, a.pos
  UNION ALL
  SELECT NULL, a.lvl, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), ''),
         coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '')
  FROM upper_nodes a JOIN upper_nodes b ON a.lvl = b.lvl AND a.pos // 16 = b.pos // 16
  WHERE a.n > 1 GROUP BY a.lvl, a.pos),
path AS (
  SELECT doc_id, tree, 0 AS lvl, pos, '' AS proof, claim AS folded FROM placed
  UNION ALL
  SELECT p.doc_id, p.tree, p.lvl + 1, p.pos // 16, proof || before || after, sha256(before || folded || after)
  FROM path p JOIN kin k ON k.tree = p.tree AND k.lvl = p.lvl AND k.pos = p.pos),
inner_end AS (SELECT doc_id, tree, arg_max(proof, lvl) AS proof, arg_max(folded, lvl) AS folded FROM path GROUP BY doc_id, tree),
upper_path AS (
  SELECT e.doc_id, e.tree, 0 AS lvl, t.pos, e.proof, e.folded FROM inner_end e JOIN tops t ON t.tree = e.tree
  UNION ALL
  SELECT p.doc_id, p.tree, p.lvl + 1, p.pos // 16, proof || before || after, sha256(before || folded || after)
  FROM upper_path p JOIN kin k ON k.tree IS NULL AND k.lvl = p.lvl AND k.pos = p.pos),
ends AS (SELECT doc_id, tree, arg_max(proof, lvl) AS proof, arg_max(folded, lvl) AS folded FROM upper_path GROUP BY doc_id, tree)
SELECT l.doc_id, l.leaf, t.digest AS subroot, r.digest AS root, sha256(e.proof) AS proof_sha256, e.folded AS folded_root,
       e.folded = r.digest AS verified
FROM leaves l JOIN ends e ON e.doc_id = l.doc_id AND e.tree = l.tree JOIN tops t ON t.tree = l.tree
JOIN (SELECT digest FROM upper_nodes WHERE n = 1) r ON true""",
}
