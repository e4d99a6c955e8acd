"""The `opN_*` queries: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from weir.llm import ann, bpe, covertree, ctw, dialogue, itq, langid, packing, secret_scan, simhash, suffix, topk, warc
from weir.sources.tables import read_table

TOKENIZER = "word_bpe_49k.json"


def op1_nra_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_topk(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op2_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op3_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, budget=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(read_table(spark, sf_dir, "documents"), width=100)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(read_table(spark, sf_dir, "documents"))


def op6_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(read_table(spark, sf_dir, "pages"))


def op7_lp_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), capacity=2048)


def op8_bitmask_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read_table(spark, sf_dir, "documents"))


def op9_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(read_table(spark, sf_dir, "documents"))


def op10_transducer_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded_digests(read_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op11_itq_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq.near_duplicates(read_table(spark, sf_dir, "embeddings"), cosine=0.95)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return covertree.hard_negatives(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)


def op13_audit_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue.audits(dialogue.damaged(read_table(spark, sf_dir, "conversations")), present=F.col("present"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_nra_topk, op2_learned_partitions, op3_simhash_trie, op4_suffix_dedup, op5_secret_scan, op6_warc_archive,
        op7_lp_packing, op8_bitmask_language, op9_context_tree, op10_transducer_bpe,
        op11_itq_dedup, op12_hard_negatives, op13_audit_repair)
}

ORACLE = {
    "op1_nra_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.x) = len(c.x)
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 10""",
    "op12_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.x, c.x)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id AND len(a.x) = len(c.x)
), positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank,
  s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3""",
    "op6_warc_archive": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes FROM pages
), h AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS holder FROM p)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> holder THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> holder THEN holder END AS refers_to
FROM h""",
}
