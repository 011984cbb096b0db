"""Columns that the caller adds come back as they were, whatever they are called."""

from __future__ import annotations

from pyspark.sql import functions as F

from annolytics.llm.mixing import mix_documents
from annolytics.llm.ngram_join import one_of_each
from annolytics.llm.quality import good_documents
from annolytics.llm.sharding import write_shards
from annolytics.llm.suffix_dedup import without_repeats

NAMES = "of_id of_key worded own_id own_key spans doc_key copy run runs pass size got low high offset block score keep text_score meta_score fp n rep component component_id start kept_text given_0 given_1 shard part salt rows".split()
BASE = "doc_id text lang source n_chars".split()


def wide(docs):
    """Each added column says its own name and the row's id."""
    return docs.select(*BASE, *(F.concat_ws(":", F.lit(c), F.col("doc_id")).alias(c) for c in NAMES))


def unchanged(out):
    assert out.columns == [*BASE, *NAMES]
    bad = F.exists(F.array(*(~F.col(c).eqNullSafe(F.concat_ws(":", F.lit(c), F.col("doc_id"))) for c in NAMES)), lambda x: x)
    assert out.filter(bad).isEmpty()
    return out.count()


def test_columns_pass_through(spark, sf_dir, tmp_path):
    docs = wide(spark.read.parquet(f"{sf_dir}/documents.parquet").select(*BASE)).limit(120)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    assert 0 < unchanged(one_of_each(docs)) <= 120
    assert unchanged(without_repeats(docs)) == 120
    assert unchanged(mix_documents(docs)) > 50
    assert unchanged(good_documents(docs, labels)) > 0
    write_shards(docs, str(tmp_path / "s"), 3)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 120 and "given_shard" in back.columns
    for operator in (one_of_each, without_repeats, mix_documents):
        assert operator(docs.limit(0)).count() == 0
