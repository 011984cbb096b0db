"""From raw documents to packed training sequences, in five stages. Each stage's rows are
written as Parquet in the shared folder and read back as the next one's documents."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from annolytics.llm.common import discard, shared_folder
from annolytics.llm.mixing import mix_documents
from annolytics.llm.ngram_join import one_of_each
from annolytics.llm.packing import pack_documents
from annolytics.llm.quality import good_documents
from annolytics.llm.suffix_dedup import without_repeats


#: Bytes of a repeated passage, and of the grams by which windows find each other.
PASSAGE_BYTES, PASSAGE_ANCHOR = 256, 64


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier finds good. Nulls are values of their own, repeated
    rows are judged alike; an empty table stays empty."""
    return good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies. Null and wordless texts stay."""
    return one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that they share: of 50 words and more, which are fewer
    bytes than the 400 of the operator's own query. Null texts stay null."""
    return without_repeats(docs, length=PASSAGE_BYTES, anchor=PASSAGE_ANCHOR)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their weights; null texts and those without words have no share."""
    return mix_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of fixed length; a null text is an empty one."""
    return pack_documents(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages), ("mixing", mixing), ("packing", packing)]

#: Classifier, transform and packing are not SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over documents. A stage's table is deleted once the next one is written;
    the last one stays."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = f"{shared_folder(spark)}/pipeline/{uuid.uuid4().hex}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        docs.settled_at = path
        if before is not None:
            discard(before)
        before = docs
    return docs
