import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import winnow as op
from tidemark.llm.queries import op2_winnow

MASK = (1 << 32) - 1


def turned(x, n):
    return ((x << n) | (x >> (32 - n))) & MASK


def tokens(text):
    """Words; of a run of over 32 code points without white space, its code points."""
    runs = re.findall(r"[^\x20\x09-\x0D]+", text)
    return [t for run in runs for t in ([run] if len(run) <= 32 else run)]


def kept(text, known):
    words = [known[w] for w in tokens(text)]
    if len(words) < 4:
        return [(words[0], 0)] if len(words) == 1 else [(tuple(words), 0)] if words else []
    return brute(words)


def brute(values):
    """Kept (hash, position) pairs of a text's word hashes, by the definition."""
    grams = []
    for i in range(len(values) - 3):
        a, b, c, d = values[i : i + 4]
        grams.append(turned(a, 3) ^ turned(b, 2) ^ turned(c, 1) ^ d)
    width = min(4, len(grams))
    out = []
    for s in range(len(grams) - width + 1):
        window = grams[s : s + width]
        at = s + max(i for i, g in enumerate(window) if g == min(window))
        if (grams[at], at) not in out:
            out.append((grams[at], at))
    return out


def word_hashes(spark, words):
    rows = spark.createDataFrame([(w,) for w in sorted(set(words))], "w string")
    return {r[0]: r[1] for r in rows.select("w", F.shiftrightunsigned(F.xxhash64("w"), 32)).collect()}


def test_kept_pairs(spark):
    texts = ["", "a", "a b c", "a b c d", " ".join("abcdefghij"), " ".join(["x"] * 50),
             " ".join(str(i * i % 37) for i in range(300)), "w" * 100 + " a b c d e f", "x" * 32 + " y " + "𝒳é" * 17]
    pieces = [tokens(t) for t in texts]
    known = word_hashes(spark, [w for p in pieces for w in p])
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: [tuple(p) for p in r.fingerprint] for r in op.fingerprints(df).collect()}
    for i, p in enumerate(pieces):
        if len(p) >= 4:
            assert got[i] == brute([known[w] for w in p])
        else:
            assert len(got[i]) == min(1, len(p))


def test_shared_passage_is_always_found(spark):
    shared = " ".join(f"s{i}" for i in range(7))
    rows = [(1, " ".join(f"a{i}" for i in range(40)) + " " + shared + " q"), (2, "z " + shared + " " + " ".join(f"b{i}" for i in range(33)))]
    a, b = (set(r[0]) for r in spark.createDataFrame(rows, "doc_id bigint, text string").select(op.hashes(op.selected(F.col("text")))).collect())
    assert a & b


def test_passage_in_a_run_without_blanks(spark):
    """Found whatever its offset: eleven code points are a run of at least seven."""
    shared = "年月日前後左右上下中外"
    rows = [(f"{'あ' * k}{shared}{'い' * 40}",) for k in range(30, 64)]
    sets = [set(r[0]) for r in spark.createDataFrame(rows, "text string").select(op.hashes(op.selected(F.col("text")))).collect()]
    end = set(spark.createDataFrame([("う" * 50 + shared,)], "text string").select(op.hashes(op.selected(F.col("text")))).first()[0])
    assert all(s & end for s in sets)


def test_likeness_equals_plain_sets(spark, tmp_path):
    """near_edited and near_next of every document against sets made word by word."""
    rnd = random.Random(5)
    texts = [" ".join(rnd.choice("abcdefgh") for _ in range(n)) for n in (0, 1, 3, 4, 7, 8, 14, 25, 60, 300)]
    texts += [None, "z" * 90, texts[-1][:400] + " tail", texts[-2] + "é" * 50, "q" * 31 + " " + "q" * 40]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    given = [t or "" for t in texts]
    edits = [t[: len(t) - len(t) // 3] + given[i - 1][: len(t) // 3] for i, t in enumerate(given)]
    known = word_hashes(spark, [w for t in given + edits for w in tokens(t)])
    sets = lambda t: {h for h, _ in kept(t, known)}
    like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    got = {r.doc_id: r for r in op2_winnow(spark, str(tmp_path)).collect()}
    for i, t in enumerate(given):
        assert got[i].edited_sha256 == hashlib.sha256(edits[i].encode()).hexdigest()
        assert got[i].near_edited == pytest.approx(like(sets(t), sets(edits[i]))), i
        assert got[i].near_next == pytest.approx(like(sets(t), sets(given[i - 1]))), i


def test_edited_texts(docs):
    rows = [tuple(r)[:2] for r in docs.collect()]
    greatest = {}
    for i, t in rows:
        i = -(1 << 63) if i is None else i
        greatest.setdefault(i, []).append(t or "")
    ids = sorted(greatest, reverse=True)
    follows = dict(zip(ids, ids[1:] + ids[:1]))
    got = op.edited(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        i = -(1 << 63) if r.doc_id is None else r.doc_id
        k = len(r.text) // 3
        ends = {r.text[: len(r.text) - k] + t[:k] for t in greatest[follows[i]]}
        assert r.edited in ends


def test_ring_over_many_ranges(spark):
    ids = spark.range(0, 5000, 7).withColumnRenamed("id", "id")
    got = {r["id"]: r["next"] for r in op.following(ids).collect()}
    order = sorted(got, reverse=True)
    assert [got[i] for i in order] == order[1:] + order[:1]


def test_query(spark, tmp_path):
    text = " ".join(f"w{i}" for i in range(200))
    rows = [(3, text), (2, text), (1, None), (0, "äöü ß")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in op2_winnow(spark, str(tmp_path)).collect()}
    assert got[3].fingerprint == got[2].fingerprint and got[3].near_next == 1.0
    assert 0.4 < got[2].near_edited < 1.0 and got[2].near_next == 0.0
    assert got[1].n_chars == 0 and got[1].near_edited == 1.0
    assert got[0].edited_sha256 == hashlib.sha256(("äöü ß"[:4] + text[:1]).encode()).hexdigest()


def test_empty_and_single(spark, none):
    assert op.edited(none).collect() == []
    (r,) = op.edited(spark.createDataFrame([(1, "abcdef")], "doc_id bigint, text string")).collect()
    assert r.edited == "abcdab"


def test_native(spark, docs):
    plan = op.edited(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
