"""The registered queries of the corpus operators: each applies its operator, with
production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .conversations import damage, repair_conversations
from .embedding_dedup import embedding_components
from .html_text import extract_pages
from .mixing import mix_sizes
from .ngram_join import ngram_components
from .packing import pack_documents
from .periodic_runs import periodic_runs, repeat_tails, run_digests
from .quality import classify_quality
from .sharding import shard_rows
from .suffix_dedup import suffix_dedup
from .topk import top_k
from .toxicity import classify_toxicity
from .warc import derivative_records


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(_table(spark, sf_dir, "pages"))


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_table(spark, sf_dir, "embeddings"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(_table(spark, sf_dir, "documents"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_components(_table(spark, sf_dir, "embeddings"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"))


def op6_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derivative_records(_table(spark, sf_dir, "pages"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sizes(_table(spark, sf_dir, "documents"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(_table(spark, sf_dir, "documents"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(_table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(periodic_runs(repeat_tails(_table(spark, sf_dir, "documents"))))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(damage(_table(spark, sf_dir, "conversations")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    all_of_them = (op1_html_extraction, op2_top_k, op3_sharding, op4_embedding_dedup, op5_packing, op6_warc_derivatives, op7_mixing, op8_suffix_dedup, op9_ngram_join, op10_quality, op11_periodic_runs, op12_toxicity, op13_conversation_repair)
    return {f.__name__: f for f in all_of_them}


def oracle_sql() -> dict[str, str]:
    return {"op2_top_k": TOP_K_SQL, "op4_embedding_dedup": EMBEDDING_DEDUP_SQL}


TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

EMBEDDING_DEDUP_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, e, sqrt(list_inner_product(e, e)) AS norm FROM (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  ) WHERE len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.93
), reached AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION SELECT r.vec_id, l.b FROM reached r JOIN links l ON r.other = l.a
), lowest AS (SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id)
SELECT w.vec_id, coalesce(n.n_links, 0) AS n_links, w.component_id, w.vec_id = w.component_id AS kept
FROM lowest w LEFT JOIN (SELECT a, count(*) AS n_links FROM links GROUP BY a) n ON w.vec_id = n.a
"""
