"""The stages of the pipeline, each on what its predecessor kept, against plain versions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
import plain


@pytest.fixture(scope="module")
def tables(spark, sf_dir, tmp_path_factory):
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    folder = tmp_path_factory.mktemp("stages")
    for name, stage in P.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"file://{folder}/{name}")
        out[name] = docs, spark.read.parquet(f"file://{folder}/{name}")
        docs = out[name][1]
    return out


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_all_but_the_last_stage_keep_the_columns(tables):
    first = tables["quality"][0].columns
    assert [n for n, _ in P.STAGES] == ["quality", "near_duplicates", "repeated_passages", "mixing", "packing"]
    assert all(tables[n][1].columns == first for n in tables if n != "packing")


def test_quality_keeps_rows_whole(tables, spark, sf_dir):
    docs, kept = tables["quality"]
    assert 0 < kept.count() < docs.count() and kept.exceptAll(docs).count() == 0
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = docs.join(labels, "doc_id").join(kept.select("doc_id", F.lit(True).alias("kept")), "doc_id", "left").collect()
    assert sum((r.kept is True) == (r.quality == 1) for r in judged) > 0.9 * len(judged)


def test_one_document_of_each_group_stays(tables):
    docs, kept = tables["near_duplicates"]
    want = {r[2] for r in plain.ngram_rows([tuple(r) for r in docs.select("doc_id", "text").collect()])}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)


def test_repeated_passages_go(tables):
    docs, kept = tables["repeated_passages"]
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = plain.suffix_rows(rows, P.PASSAGE_BYTES)
    got = {r.doc_id: r.text for r in kept.collect()}
    gone = {d for d, _, removed, _, _ in want if removed}
    assert len(got) == len(rows) and gone
    for d, n_bytes, removed, *_ in want:
        text = dict(rows)[d]
        if removed:
            assert n_bytes - removed - 6 <= len(got[d].encode()) <= n_bytes - removed
        else:
            assert got[d] == text


def test_mixing_takes_what_its_sizes_say(tables):
    from annolytics.llm.mixing import mix_sizes

    docs, mixed = tables["mixing"]
    taken = sum(len(plain.WORD.findall(r.text.encode())) for r in mixed.collect())
    assert taken == mix_sizes(docs).agg(F.sum("taken")).first()[0]


def test_packing_holds_every_document(tables):
    docs, packed = tables["packing"]
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0
    assert packed.filter("piece = 0").count() == docs.count()


def test_run_is_the_stages_in_turn(tables, spark, sf_dir):
    out, docs = P.run(spark, sf_dir), tables["packing"][1]
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert rows_of(out, *columns) == rows_of(docs, *columns) and out.count() > 20
    # sequences are full of pieces, one after the other
    placed = {}
    for r in sorted(out.collect(), key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == placed.get(r.sequence_id, 0) and r.offset + r.length <= 2048
        placed[r.sequence_id] = r.offset + r.length
