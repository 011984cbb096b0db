"""Corpus operators against plain versions, on the smallest tables and on awkward rows."""

from __future__ import annotations

import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import plain
from annolytics.llm import html_text, quality, warc
from annolytics.llm.embedding_dedup import embedding_components
from annolytics.llm.mixing import mix_documents, mix_sizes
from annolytics.llm.ngram_join import ngram_components, one_of_each
from annolytics.llm.packing import pack_documents
from annolytics.llm.quality import classify_quality
from annolytics.llm.sharding import jump_hash, shard_rows
from annolytics.llm.suffix_dedup import suffix_dedup, without_repeats
from annolytics.llm.topk import threshold_search, top_k

DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard int, part string, n int, offset long"


def awkward_docs() -> list[tuple]:
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    base = [rnd.choice(words) for _ in range(300)]
    near = base[:150] + ["other"] + base[151:]
    passage = " ".join(rnd.choice(words) for _ in range(150))
    texts = [None, "", " \n\t", "One", "one", "a b c d", "A b C d", "a b c d e", " ".join(base), " ".join(near), " ".join(base).upper(), "é " + passage + " ü", "x " + passage, passage + passage, "long " * 60_000]
    rows = [(i, t, None if i % 3 == 0 else "en", [None, "b", "a", "c"][i % 4], None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[8], rows[8], (3, "another text under one id", "en", "a", 25), (None, "no id here at all", "en", "a", 17), (None, " ".join(base), "en", None, 9)]
    return [(*r, 1, "p", 2, 3) for r in rows]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(awkward_docs(), DOCS)


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.mark.parametrize("name", ["awkward", "documents"])
def test_ngram_components(request, name):
    docs = request.getfixturevalue(name)
    want = plain.ngram_rows([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert rows_of(ngram_components(docs), "doc_id", "n_shingles", "component_id") == want
    assert rows_of(ngram_components(docs, paired=2), "doc_id", "n_shingles", "component_id") == want


def near_copies(n: int) -> list[tuple]:
    """A cloud of copies of one text, some beyond the threshold of all others, and texts that
    share one passage alone."""
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    base, passage = [rnd.choice(words) for _ in range(120)], [rnd.choice(words) for _ in range(60)]
    rows = []
    for i in range(n):
        copy = list(base)
        for _ in range(rnd.choice([1, 1, 2, 3, 4, 5])):
            copy[rnd.randrange(24) * 5] = "edit"
        rows.append((3 * i, " ".join(copy[: 120 - rnd.randrange(3)])))
        rows.append((3 * i + 1, " ".join([rnd.choice(words) for _ in range(rnd.randrange(10, 60))] + passage)))
    return rows


def test_ngram_components_of_large_groups(spark):
    rows = near_copies(150)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain.ngram_rows(rows)
    assert 2 < len({r[2] for r in want if r[2] % 3 == 0}) < 150
    assert rows_of(ngram_components(docs), "doc_id", "n_shingles", "component_id") == want
    assert rows_of(ngram_components(docs, paired=3), "doc_id", "n_shingles", "component_id") == want


def test_one_of_each(awkward):
    kept = one_of_each(awkward)
    assert kept.columns == awkward.columns
    texts = [r.text for r in kept.collect()]
    worded = [plain.shingles(t) for t in texts if plain.shingles(t)]
    assert len(worded) == len(set(worded))
    # two texts under one id that are not alike are two components
    numbered = plain.ngram_rows([(i, r[1]) for i, r in enumerate(awkward_docs())])
    assert len([t for t in texts if plain.shingles(t)]) == len({r[2] for r in numbered if r[1]})


@pytest.mark.parametrize("name", ["awkward", "documents"])
def test_suffix_dedup(request, name):
    docs = request.getfixturevalue(name)
    want = plain.suffix_rows([tuple(r) for r in docs.select("doc_id", "text").collect()])
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert rows_of(suffix_dedup(docs), *columns) == want
    if name == "documents":
        assert rows_of(suffix_dedup(docs, hot=1), *columns) == want
    cut = without_repeats(docs)
    assert cut.columns == docs.columns
    assert rows_of(cut, F.length("text")) == rows_of(suffix_dedup(docs), F.length("text"))


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_passages_within_and_across_batches(spark, parts):
    """A passage that many texts share, one that two share, and one that a text has twice; all in
    one batch, some in each, and each text in a batch of its own."""
    rnd = random.Random(11)

    def some(n: int) -> str:
        return " ".join(str(rnd.randrange(10**6)) for _ in range(n))

    common, of_two, twice = some(120), some(90), some(80)
    rows = [(i, f"{some(40)} {common if i % 3 else of_two if i in (6, 21) else some(50)} {some(30)}") for i in range(38)]
    rows += [(38, f"{twice} {some(20)} {twice}"), (39, rows[5][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts, "doc_id")
    want = plain.suffix_rows(rows)
    assert sum(r[2] > 0 for r in want) > 25
    assert rows_of(suffix_dedup(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


def vectors_of(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(300, 16)).astype("f4")
    v[100:180] = v[0] + rng.normal(size=(80, 16)).astype("f4") * 0.12
    v[180:200] = v[1]
    rows = [(i, [float(x) for x in v[i]], i % 3 if i < 100 else 1) for i in range(300)]
    rows += [(300, None, 1), (301, [0.0] * 16, 1), (302, [float("nan")] * 16, 1), (303, [None] * 16, 1), (304, rows[150][1], None), (305, [1.0, 2.0], 1), (306, [], 1), (150, rows[150][1], 1), (None, rows[150][1], 1), (350, rows[0][1], 0), (350, rows[0][1], 0)]
    return spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, score string")


def test_embedding_components(spark):
    vectors = vectors_of(spark)
    rows = [(r.vec_id, r.embedding, r.label) for r in vectors.collect()]
    want, got = plain.embedding_rows(rows), rows_of(embedding_components(vectors), "vec_id", "n_links", "component_id", "kept")
    assert len(got) == len(want)
    links = [sum(r[1] for r in x) for x in (got, want)]
    assert 0.9 * links[1] <= links[0] <= links[1]
    assert sum(a[0::2] == b[0::2] for a, b in zip(got, want, strict=True)) > 0.95 * len(want)


@pytest.mark.parametrize("shared", [0.0, 0.5, 0.7])
def test_embedding_recall_of_anisotropic_vectors(spark, shared):
    """Vectors share a direction of this squared mean; pairs are planted from 0.93 on."""
    rng = np.random.default_rng(11)

    def unit(x):
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    n, dim = 5000, 64
    a = unit(np.sqrt(shared) * np.eye(dim)[:1] + np.sqrt((1 - shared) / dim) * rng.normal(size=(n, dim)))
    away, cosine = rng.normal(size=(n, dim)), rng.uniform(0.93, 0.97, (n, 1))
    away = unit(away - (away * a).sum(1, keepdims=True) * a)
    v = np.concatenate([a, cosine * a + np.sqrt(1 - cosine**2) * away])
    table = spark.createDataFrame([(i, x.tolist(), 1) for i, x in enumerate(v)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r.component_id for r in embedding_components(table).collect()}
    found = np.array([got[i] == got[n + i] for i in range(n)])
    bands = [found[(cosine[:, 0] >= low) & (cosine[:, 0] < low + 0.01)].mean() for low in (0.93, 0.94, 0.95, 0.96)]
    print("RECALL", shared, np.round(bands, 3).tolist())
    assert min(bands) >= 0.93 and found.mean() >= 0.95


def test_top_k(spark):
    vectors = vectors_of(spark)
    rows = [(r.vec_id, np.floor(256 * np.array(r.embedding, float))) for r in vectors.collect() if r.vec_id is not None and r.embedding is not None and all(x is not None and np.isfinite(x) for x in r.embedding)]
    want = []
    for q, v in {(q, tuple(v)) for q, v in rows if q % 50 == 0}:
        scored = sorted((-int(np.dot(v, w)), c) for c, w in rows if c != q and len(w) == len(v))[:5]
        want += [(q, i + 1, c, -s) for i, (s, c) in enumerate(scored)]
    got = top_k(vectors, query_rows=3, cell_rows=50)
    assert rows_of(got, "query_id", "rank", "vec_id", "score") == sorted(want, key=str)
    assert rows_of(top_k(vectors), "query_id", "rank", "vec_id", "score") == sorted(want, key=str)


def test_threshold_search_stops_on_the_bound():
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(8, 6)) * 40
    rows = np.floor(centres[rng.integers(0, 8, 4000)] + rng.normal(size=(4000, 6)))
    queries, ids = rows[:50], np.arange(4000)
    q, found, score, scored = threshold_search(queries, ids[:50], rows, ids, 5, block_rows=1000)
    full = queries @ rows.T
    full[np.arange(50), np.arange(50)] = -np.inf
    for i in range(50):
        want = np.lexsort((ids, -full[i]))[:5]
        assert found[q == i].tolist() == want.tolist() and score[q == i].tolist() == full[i, want].tolist()
    print("ROWS SCORED", scored.sum() / (50 * 3999))
    assert scored.sum() < 0.5 * 50 * 3999


def test_top_k_of_an_id_on_two_vectors(spark):
    table = spark.createDataFrame([(50, [1.0, 0.0]), (50, [0.0, 1.0]), (1, [2.0, 1.0]), (2, [1.0, 3.0])], "vec_id long, embedding array<double>")
    assert rows_of(top_k(table), "query_id", "rank", "vec_id", "score") == sorted([(50, 1, 1, 2 * 65536), (50, 2, 2, 65536), (50, 1, 2, 3 * 65536), (50, 2, 1, 65536)], key=str)


def test_threshold_search_keeps_ties_of_negative_scores():
    # longest first: the first block holds id 9, the second the same score with a smaller id
    rows, ids = np.array([[-5.0, 3.0], [-5.0, 0.0], [-5.0, 0.0], [-5.0, 0.0]]), np.array([9, 1, 2, 3])
    _, found, score, _ = threshold_search(np.array([[1.0, 0.0]]), np.array([100]), rows, ids, 1, block_rows=1)
    assert found.tolist() == [1] and score.tolist() == [-5]
    _, found, _, _ = threshold_search(np.array([[1.0, 0.0]]), np.array([100]), rows, ids, 2, block_rows=2)
    assert sorted(found.tolist()) == [1, 2]


def test_jump_hash_moves_rows_into_the_new_shard_alone():
    keys = np.random.default_rng(2).integers(0, 2**63, 20_000).astype(np.uint64)
    a, b = jump_hash(keys, 40), jump_hash(keys, 41)
    assert set(b[a != b]) == {40} and 0.015 < (a != b).mean() < 0.035
    key, bucket, j = int(keys[0]), -1, 0  # the published loop
    while j < 40:
        bucket, key = j, (key * 2862933555777941757 + 1) % 2**64
        j = int((bucket + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    assert a[0] == bucket


def test_sharding(awkward):
    rows = shard_rows(awkward).collect()
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == sorted((str(d[0]), len((d[1] or "").encode()) + 16, zlib.crc32((d[1] or "").encode())) for d in awkward_docs())
    for shard in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    assert all(r.grown_shard in (r.shard, 40) for r in rows)


def test_every_shard_is_that_of_the_published_loop(spark, documents):
    keys = {r.doc_id: r.key for r in documents.select("doc_id", F.xxhash64("doc_id").alias("key")).collect()}
    for r in shard_rows(documents).collect():
        for shards, got in ((40, r.shard), (41, r.grown_shard)):
            key, bucket, j = keys[r.doc_id] % 2**64, -1, 0
            while j < shards:
                bucket, key = j, (key * 2862933555777941757 + 1) % 2**64
                j = int((bucket + 1) * (float(1 << 31) / ((key >> 33) + 1)))
            assert bucket == got


def test_written_shards_hold_all_rows(spark, awkward, tmp_path):
    from annolytics.llm.sharding import write_shards

    plain_rows = awkward.drop("shard", "part")
    write_shards(plain_rows, f"file://{tmp_path}/out", 5)
    assert rows_of(spark.read.parquet(f"file://{tmp_path}/out"), *plain_rows.columns) == rows_of(plain_rows, *plain_rows.columns)


def plain_best_fit(sizes: list[int], length: int, most: int) -> list[tuple[int, int]]:
    """Bounded-space best-fit by lists: bin and offset of each item."""
    bins: list[list[int]] = []  # number, free places, in order of their last change
    made, out = 0, []
    for size in sizes:
        fit = [b for b in bins if b[1] >= size]
        if fit:
            least = min(b[1] for b in fit)
            b = [b for b in fit if b[1] == least][-1]
            bins.remove(b)
        else:
            if len(bins) == most:
                least = min(b[1] for b in bins)
                bins.remove([b for b in bins if b[1] == least][-1])
            b, made = [made, length], made + 1
        out.append((b[0], length - b[1]))
        if b[1] > size:
            bins.append([b[0], b[1] - size])
    return out


def test_packing_is_bounded_best_fit(documents):
    rows = pack_documents(documents, open_bins=7).select("*", F.xxhash64("doc_id", F.lit(0))).collect()
    assert {r.sequence_id >> 32 for r in rows} == {0}  # one group
    text = F.coalesce("text", F.lit(""))
    keys = {r.doc_id: (r.place, r.doc_key) for r in documents.select("doc_id", F.xxhash64("doc_id", text).alias("doc_key")).withColumn("place", F.pmod(F.xxhash64("doc_key", F.lit(1)), F.lit(1 << 20))).collect()}
    rows.sort(key=lambda r: (keys[r.doc_id][0], r.doc_id, keys[r.doc_id][1], r.piece))
    assert [(r.sequence_id, r.offset) for r in rows] == plain_best_fit([r.length for r in rows], 2048, 7)


@pytest.mark.parametrize("name", ["awkward", "documents"])
def test_packing(request, name):
    docs = request.getfixturevalue(name)
    rows = pack_documents(docs, with_ids=True, group_rows=100).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted([(str(r.doc_id), *tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0) for r in docs.collect()], key=str)
    ends: dict[int, int] = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0) and r.offset + r.length <= 2048
        ends[r.sequence_id] = r.offset + r.length
        assert r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.length
    if name == "documents":
        texts: dict[str, list[int]] = {}
        for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
            assert len(texts.setdefault(str(r.doc_id), [])) == r.start
            texts[str(r.doc_id)] += np.frombuffer(r.ids, "<u4").tolist()
        assert sorted(((k, *v) for k, v in texts.items()), key=str) == want
        assert sum(ends.values()) / (2048 * len(ends)) > 0.9
    else:
        assert sum(r.length for r in rows) == sum(len(w) - 1 for w in want)


@pytest.mark.parametrize("name", ["awkward", "documents"])
def test_mixing(request, name):
    docs = request.getfixturevalue(name)
    mixed = mix_sizes(docs).cache()
    rows = mixed.collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    total = sum(r.size for r in rows)
    assert sum(r["size"] for r in rows) == sum(len(plain.WORD.findall((r.text or "").encode())) for r in docs.collect())
    by_source = {}
    for r in rows:
        by_source.setdefault((r.source_size, r.target), []).append(r.taken)
    for (size, target), taken in by_source.items():
        assert target <= 2 * size + 1e-6 and abs(sum(taken) - target) <= len(by_source) + 1
    assert sum(t for _, t in by_source) == pytest.approx(1.5 * total, rel=0.05)
    assert rows_of(mix_sizes(docs), "doc_id", "taken") == rows_of(mixed, "doc_id", "taken")
    texts = mix_documents(docs)
    assert texts.columns == docs.columns
    assert sum(len(plain.WORD.findall(r.text.encode())) for r in texts.collect()) == sum(r.taken for r in rows)


def test_quality(spark, awkward, documents, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    part = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(4))
    scored = classify_quality(documents, labels.filter(part > 0)).join(labels.filter(part == 0), "doc_id").collect()
    assert np.mean([r.keep == (r.quality == 1) for r in scored]) > 0.9
    assert np.mean([r.keep for r in scored if r.quality == 1]) > 0.95
    none = labels.limit(0)
    assert all(r.keep for r in classify_quality(awkward, none).collect())
    odd = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (4, None, 0), (None, 1, 1), (5, 1, 0), (99, 1, 0), (8, 0, 0)], "doc_id long, quality int, toxic int")
    assert classify_quality(awkward, odd).count() == awkward.count()


def plain_co_training(text, meta, y, pool, rounds=4):
    """All in memory: every pool row that a view is sure of is an example of the other."""
    turn = np.random.default_rng(5).permutation(len(y))
    held, train = turn[: int(len(y) * 0.3)], turn[int(len(y) * 0.3) :]
    given, views = [np.full(len(pool[0]), np.nan) for _ in pool], []
    for r in range(rounds + 1):
        views = []
        for v, x in enumerate((text, meta)):
            extra = np.flatnonzero(~np.isnan(given[v]))
            rows, weight = np.concatenate([x[train], pool[v][extra]]), np.r_[np.ones(len(train)), np.full(len(extra), 0.5)]
            scale = np.where(rows.std(0) < 1e-9, 1.0, rows.std(0))
            view = quality.Logistic(rows.mean(0), scale, np.zeros(0))
            view.weights = quality.newton(np.c_[np.ones(len(rows)), view.standard(rows)], np.r_[y[train], given[v][extra]], weight, 1.0)
            quality.calibrate(view, x[held], y[held])
            views.append(view)
        for v in (0, 1) if r < rounds else ():
            p = 1 / (1 + np.exp(-np.clip(views[v].margin(pool[v]), -30, 30)))
            sure = (np.maximum(p, 1 - p) >= 0.97) & np.isnan(given[1 - v])
            given[1 - v][sure] = p[sure] >= 0.5
    return views, [int((~np.isnan(g)).sum()) for g in given]


def test_quality_learns_from_all_unlabelled_rows(spark, sf_dir, monkeypatch):
    larger = sf_dir.replace("sf0.001", "sf0.01")  # on fewer labels no view is ever sure
    documents, labels = spark.read.parquet(f"{larger}/documents.parquet"), spark.read.parquet(f"{larger}/labels.parquet")
    more = documents.crossJoin(spark.range(1, 13).withColumnRenamed("id", "again"))
    more = more.withColumn("doc_id", F.when(F.col("again") < 12, F.col("doc_id") + 1_000_000 * F.col("again"))).drop("again")
    docs = documents.unionByName(more)
    good = labels.select("doc_id", F.col("quality").alias("y"))
    typed = quality._typed(docs)
    text, meta, y = quality._gathered(quality._features(typed.join(good, "doc_id")))
    rest = quality._matrix([r.x for r in quality._features(typed.join(good.select("doc_id"), "doc_id", "left_anti").withColumn("y", F.lit(-1))).collect()])
    want, given = plain_co_training(text, meta, y, (rest[:, : quality.TEXT_FEATURES], rest[:, quality.TEXT_FEATURES :]))
    assert len(rest) > 8_000 and max(given) > 4_000
    for direct in (64, 0):
        monkeypatch.setattr(quality, "DIRECT_SUMS", direct)
        model = quality.train_quality(docs, labels)
        for a, b in zip(model.views, want, strict=True):
            assert np.allclose(a.margin(a.mean + 0.5 * a.scale), b.margin(a.mean + 0.5 * a.scale), atol=1e-3)
            assert np.allclose(a.weights, b.weights, atol=1e-4) and np.allclose(a.mean, b.mean)


def test_tables_may_be_empty(spark, documents):
    none = documents.limit(0)
    for out in (ngram_components(none), suffix_dedup(none), shard_rows(none), pack_documents(none), mix_sizes(none), mix_documents(none), one_of_each(none), without_repeats(none)):
        assert out.count() == 0
    vectors = vectors_of(spark).limit(0)
    assert top_k(vectors).count() == 0 and embedding_components(vectors).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_text.extract_pages(pages).count() == 0 and warc.derivative_records(pages).count() == 0


PAGE = """<html><head><title>T</title><style>p{}</style><script>var x="</p>";</script></head><body><header>Top, of the site</header>
<nav><ul><li><a href="/a">Menu, item</a></li></ul></nav><div class="cookie-notice">We use cookies, as all do, here and there.</div>
<article><h1>A &amp; B</h1><p>First <b>bold</b>  words,<br>and more, of them, to be a paragraph &#233; of some length.<p>Unclosed one, with a
line end in it, and <a href="/x">a link</a> too.<div class="ad">Buy, buy, buy, this is an advert.</div><p>Short.</p></article>
<section id="comments"><p>Reader, one, says a lot of things, with, many, commas, in, it.</p></section><aside>Side, bar</aside>
<form><p>Sign up, now</p></form><footer>Foot, note</footer>"""


def test_html_text(spark, sf_dir):
    want = "A & B First bold words, and more, of them, to be a paragraph é of some length. Unclosed one, with a line end in it, and a link too. Short."
    assert html_text.main_text(PAGE) == want
    pages = [(1, "u", PAGE), (2, None, None), (3, "v", ""), (None, "w", "<p>only this</p>"), (4, "x", "<div>" * 3000 + "deep, text of enough length to count" + "</div>" * 3000), (1, "u", PAGE), (5, "y", "plain < text & no tags"), (6, "z", "<article><p>" + "word, " * 100_000)]
    rows = {(r.page_id, r.url): r for r in html_text.extract_pages(spark.createDataFrame([(*p, "e") for p in pages], "page_id long, url string, html string, text string")).collect()}
    assert rows[1, "u"].text == want and rows[1, "u"].n_chars == len(want)
    assert rows[2, None].text == "" and rows[3, "v"].n_chars == 0
    assert rows[None, "w"].text == "only this" and rows[4, "x"].text.startswith("deep,")
    assert rows[6, "z"].n_chars == 599_999
    import re

    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        inside = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = [re.sub(r"<[a-z/][^>]*>", " ", x) for x in re.split(r"</?(?:p|h1)>", inside.replace("<b>", "").replace("</b>", ""))]
        import html

        assert html_text.main_text(r.html) == " ".join(w for b in blocks for w in html.unescape(b).split())


STORY = "<p>Some story, with words, and commas, that is long enough to be a paragraph.</p><p>And more of it, as stories go, for a second paragraph.</p>"
STORY_TEXT = "Some story, with words, and commas, that is long enough to be a paragraph. And more of it, as stories go, for a second paragraph."


@pytest.mark.parametrize(
    "page, want",
    [
        (f"<body><div class='content has-sidebar'>{STORY}<div class='sidebar'><p>Other things, of the site, in a side bar.</p></div></div>", STORY_TEXT),
        (f"<body><div id='page' class='no-comments'><div>{STORY}</div></div>", STORY_TEXT),
        (f"<body><div class='has-sidebar'><article>{STORY}</article></div>", STORY_TEXT),
        (f"<body><div><div class='post-header'><h1>Head line</h1></div><div>{STORY}</div></div>", "Head line " + STORY_TEXT),
        (f"<body><article><div class='post-header'><h1>Head line</h1></div>{STORY}</article>", "Head line " + STORY_TEXT),
        (f"<body><form action='/'>{STORY}</form>", STORY_TEXT),
        (f"<html><head><title>T</title><body>{STORY}", STORY_TEXT),
        (f"<head><title>T</title><noscript><img src='x'></noscript><meta name='a'>{STORY}", STORY_TEXT),
        (f"<body><article>{STORY}</article><ol class='comments'><li><article><p>A reader, with a comment, of a fair length.</p></article></ol>", STORY_TEXT),
        ("<body><nav><a href='/'>Home</a></nav><form>Short text</form>", "Short text"),
        ("<body><nav><a href='/'>Home</a></nav>", ""),
        ("<body><div><a href='/'>Menu</a> <a href='/b'>only</a></div>", ""),
        (f"<body><article>{STORY}<p class='share-price'>The price of a share rose, on the day, by two parts in a hundred.</p></article>", STORY_TEXT + " The price of a share rose, on the day, by two parts in a hundred."),
        (f"<body><article>{STORY}<p class='share'>Share this, with all of your friends, on every network there is.</p></article>", STORY_TEXT),
    ],
)
def test_names_beside_the_article_lose_no_article(page, want):
    assert html_text.main_text(page) == want


def test_an_open_head_ends_with_the_body():
    for page in ("<head><title>T</title><body><p>Seen", "<head><title>T</title><p>Seen", "<head><title>T</title>Seen", "<head><title>T</title><noscript>x</noscript><style>p{}</style><div>Seen"):
        assert html_text.visible_text(page) == "Seen"
        assert {k: b for k, _, b in warc.derive(warc.response_record(1, "u", page))}["conversion"] == b"Seen"


def test_links_come_from_the_tree():
    page = """<title>A &amp; B</title><!-- <a href="no">x</a> --><a data-href="d" href="/a?b=1&amp;c=2">y</a><script>'<a href="s">'</script><A HREF=bare>z</A><a name="n">w</a>"""
    body = {k: b for k, _, b in warc.derive(warc.response_record(1, "u", page))}["metadata"]
    assert json.loads(body)["Envelope"]["Payload-Metadata"]["HTML-Metadata"] == {"Title": "A & B", "Links": ["/a?b=1&c=2", "bare"]}


def test_long_pages_give_records(spark):
    pages = spark.createDataFrame([(1, "u", "<p>" + "word " * 400_000), (2, "v", "<div>" * 2000 + "deep")], "page_id long, url string, html string")
    rows = {(r.page_id, r.record_type): r for r in warc.derivative_records(pages).collect()}
    assert rows[1, "conversion"].content_length == 5 * 400_000 - 1 and rows[2, "conversion"].block == "deep"


def test_warc_derivatives(spark):
    record = warc.response_record(7, "http://a.b/c", PAGE)
    source, block = warc.decode_record(record)
    assert warc.digest(block) == source["WARC-Block-Digest"]
    out = {kind: (h, b) for kind, h, b in warc.derive(record)}
    for kind, (headers, body) in out.items():
        again, same = warc.decode_record(warc.encode_record(headers, body))
        assert same == body and again["WARC-Refers-To"] == source["WARC-Record-ID"] and warc.digest(body) == again["WARC-Block-Digest"]
        assert again["WARC-Source-Payload-Digest"] == source["WARC-Payload-Digest"] == warc.digest(PAGE.encode())
    page = json.loads(out["metadata"][1])["Envelope"]
    assert page["WARC-Header-Metadata"] == source and page["Payload-Metadata"]["HTML-Metadata"] == {"Title": "T", "Links": ["/a", "/x"]}
    assert page["Payload-Metadata"]["Headers"]["Content-Type"] == "text/html; charset=utf-8"
    assert "Menu, item" in out["conversion"][1].decode() and "var x" not in out["conversion"][1].decode()
    pages = spark.createDataFrame([(1, "u\r\nX: y", PAGE, 1), (None, None, None, 2), (1, "u\r\nX: y", PAGE, 1)], "page_id long, url string, html string, block int")
    assert warc.derivative_records(pages).count() == 6 and warc.derivative_files(pages).count() == 6
