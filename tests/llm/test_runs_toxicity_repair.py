"""Periodic runs, toxicity and conversation repair: against plain versions, on held-out rows, and
on the rows that trip them."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

from annolytics.llm import periodic_runs as P
from annolytics.llm.conversations import damage, repair_conversations
from annolytics.llm.queries import op11_periodic_runs, op13_conversation_repair
from annolytics.llm.toxicity import classify_toxicity, fit_texts, score_toxicity

SPACE = "[\\x20\\x09-\\x0D]"
DOCS = "doc_id long, text string, words string, runs int, n long, score double, known int"


def plain_runs(words: list) -> list[tuple]:
    out, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            part = words[i : i + length]
            if length >= max(6, 4 * q) and not any(part[d:] == part[:-d] for d in range(1, q)):
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def plain_row(doc_id, text) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = None if doc_id is None else zlib.crc32(str(doc_id).encode()), len(words)
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    told = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return doc_id, len(runs), *told, sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_random_words(seed):
    rnd = random.Random(seed)
    for _ in range(150):
        lists = []
        for _ in range(rnd.randrange(1, 4)):
            letters, words = rnd.choice([1, 2, 3, 30]), []
            for _ in range(rnd.randrange(5)):
                unit = [b"w%d" % rnd.randrange(letters) for _ in range(rnd.choice([1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 33]))]
                words += (unit * 9)[: int(len(unit) * rnd.choice([2, 3.9, 4, 4.1, 7.3]))]
                words += [b"w%d" % rnd.randrange(letters) for _ in range(rnd.randrange(9))]
            lists.append(words)
        for words, (runs, _) in zip(lists, P._searched(lists, 6, 4), strict=True):
            assert [(r["start"], r["length"], r["period"]) for r in runs] == plain_runs(words)


def test_runs_of_awkward_rows(spark):
    base = " ".join(f"x{i}" for i in range(11))
    texts = [None, "", " \n\t ", "a a a a a", "a a a a a a", "A a A a A a A a", "é é " * 6, (base + " ") * 4, (base + "\n\n") * 5 + "tail", "word " * 30_000]
    rows = [(i, t, "w", 1, 2, 0.5, 3) for i, t in enumerate(texts)] + [(4, texts[4], "w", 1, 2, 0.5, 3), (None, texts[7], None, None, None, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    short = [r for r in rows if len(r[1] or "") < 5000]
    got = rows_of(P.run_digests(P.periodic_runs(P.repeat_tails(docs))))
    assert [r for r in got if r[0] != 9] == sorted((plain_row(r[0], r[1]) for r in short), key=str)
    assert [r[:5] for r in got if r[0] == 9] == [(9, 1, 0, 30_000, 1)]
    assert P.periodic_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        P.periodic_runs(docs, exponent=3)


def test_runs_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    short = {r.doc_id for r in docs if len(r.text or "") < 9000}  # the plain version is quadratic
    got = rows_of(op11_periodic_runs(spark, sf_dir))
    assert len(got) == len(docs) and sum(r[1] > 0 for r in got) > 5
    assert [r for r in got if r[0] in short] == sorted((plain_row(*r) for r in docs if r.doc_id in short), key=str)


def labelled(n: int) -> list[tuple[str, int]]:
    """Texts of invented words; each toxic one has some of a few words that no other has."""
    rnd = random.Random(1)
    parts, rude = ["an", "ther", "ou", "in", "esh", "ti", "on", "ble", "wh", "ed"], ["stupid", "worthless", "idiot", "disgusting"]
    out = []
    for i in range(n):
        words = ["".join(rnd.choices(parts, k=rnd.randrange(1, 4))) for _ in range(150)]
        for _ in range(6 * (i % 3 == 0)):
            words[rnd.randrange(150)] = rnd.choice(rude)
        out.append((" ".join(words), int(i % 3 == 0)))
    return out


def test_toxicity_of_held_out_rows(spark):
    rows = labelled(450)
    docs = spark.createDataFrame([(i, t, "w", 1, 2, 0.5, 3) for i, (t, _) in enumerate(rows)] + [(9000, None, *[None] * 5), (9001, "", *[None] * 5), (9002, "an", *[None] * 5), (9002, "an", *[None] * 5), (None, "stupid", *[None] * 5)], DOCS)
    held = {i for i in range(450) if zlib.crc32(str(i).encode()) % 3 == 1}
    # labels of held-out rows are wrong, and must not be learnt from
    labels = spark.createDataFrame([(i, 1 - y if i in held else y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    got = classify_toxicity(docs, labels).collect()
    assert len(got) == 455 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert {r.doc_id for r in got if r.held_out and r.doc_id and r.doc_id < 450} == held
    right = [r.predicted == rows[r.doc_id][1] for r in got if r.doc_id in held]
    assert sum(right) / len(right) > 0.9
    empty = {r.doc_id: r.score for r in got if (r.doc_id or 0) >= 9000}
    assert empty[9000] == empty[9001] < 0.5 and sum(r.doc_id == 9002 for r in got) == 2


def test_toxicity_without_classes(spark):
    docs = spark.createDataFrame([(0, "a b", *[None] * 5), (1, None, *[None] * 5)], DOCS)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in classify_toxicity(docs, none).collect()} == {0.0}
    one = spark.createDataFrame([(0, 1), (1, 1)], "doc_id long, toxic int")
    assert {r.score for r in classify_toxicity(docs, one).collect()} == {1.0}
    assert classify_toxicity(docs.limit(0), one).count() == 0
    assert fit_texts(["a"], [0]) is None and score_toxicity(docs, 0.5).columns == ["doc_id", "n_windows", "evidence", "score"]


def plain_repair(rows: list[tuple[str, str]]) -> tuple:
    """By trying all edits of all rows (inserted rows are never in a cheapest repair)."""
    seen, faults, options = set(), [], []
    for role, text in rows:
        end = re.sub(f"{SPACE}+$", "", text)
        fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
        more = 5 * (fault == "truncated")
        options.append([("D", "", 2)] + ([] if fault in ("blank", "duplicate") else [("K", role, more), ("R", "user", 1 + more), ("R", "assistant", 1 + more)]))
    best = None
    for choice in itertools.product(*options):
        if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "?" for a, r, _ in choice if a != "D")):
            key = sum(c for *_, c in choice), "".join(a for a, *_ in choice)
            if best is None or key < best[0]:
                best = key, "\n".join(f"{r}:{t}" for (a, r, _), (_, t) in zip(choice, rows, strict=True) if a != "D")
    illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in itertools.pairwise(rows))
    return *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, *best[0], sha(best[1])


def plain_conversations(rows: list[tuple]) -> list[tuple]:
    out = []
    for conv in {r[0] for r in rows}:
        after = []
        for _, turn, role, text in sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or " ", r[3] or " ")):
            kind = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
            role, text = (" " if x is None else x for x in (role, text))
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            after += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        turns = [t for t, *_ in after if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((conv, gaps, *plain_repair([r[1:] for r in after])))
    return sorted(out, key=str)


def test_repair_of_random_conversations(spark):
    rnd = random.Random(7)
    rows = []
    for conv in [None, *range(120)]:
        for turn in [None, *range(6)]:
            if rnd.random() < 0.7:
                rows.append((conv, turn, rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), rnd.choice(["a.", "b! ", "c", "", " \n", None, "d?"])))
    rows += [rows[0], rows[0], (500, None, None, None), (501, 3, "user", "one."), (501, 3, "assistant", "two.")]
    table = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "conv_id long, turn long, role string, text string, n int, seen string, blank int")
    assert rows_of(repair_conversations(damage(table))) == plain_conversations(rows)
    assert repair_conversations(damage(table.limit(0))).count() == 0
    assert repair_conversations(table).filter("conv_id = 501").first().audit == "RR"  # of one turn, by role


def test_repair_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(op13_conversation_repair(spark, sf_dir)) == plain_conversations(rows)


def test_repair_of_a_long_conversation(spark):
    rows = spark.range(20_000).selectExpr("7L as conv_id", "id as turn", "'user' as role", "concat('t', id, '.') as text").unionByName(spark.range(5000).selectExpr("7L as conv_id", "99999L as turn", "'user' as role", "'same.' as text"))
    row = repair_conversations(rows).first()
    assert (row.gaps, row.duplicate, row.illegal, row.cost) == (79_999, 4999, 24_999, 10_000 + 2 + 2 * 4999) and len(row.audit) == 25_000
