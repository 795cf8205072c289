"""Phrases against plain Python counts."""

import re
import string
from collections import Counter, defaultdict

from tidemark.llm import collocations as C
from tidemark.llm.common import table

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(rows, least=10, share=50, limit=2000):
    counts = defaultdict(Counter)
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                counts[lang or "und" if lang is None else lang].update(
                    tuple(words[i : i + k]) for i in range(len(words) - k + 1)
                )
    out = set()
    for lang, f in counts.items():
        n = sum(c for g, c in f.items() if len(g) == 1)
        candidates = {g: c for g, c in f.items() if len(g) > 1 and c >= least}
        inside = defaultdict(int)
        for g, c in candidates.items():
            if len(g) == 3:
                for part in (g[:2], g[1:]):
                    inside[part] = max(inside[part], c)
        found = []
        for g, a in candidates.items():
            if g in inside and 100 * inside[g] >= share * a:
                continue
            cuts = [(1_000_000 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:limit], start=1):
            out.add((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return out


def same(spark, docs, **options):
    rows = [(r.text, r.lang) for r in docs.select("text", "lang").collect()]
    limit = options.pop("limit", 2000)
    got = C.best(C.phrases(docs, **options), limit, buckets=4).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows, limit=limit, **options)
    return got


def test_equals_brute_force(spark):
    assert len(same(spark, table(spark, SF, "documents"))) > 100
    same(spark, table(spark, SF, "documents"), least=2, limit=50)


def test_overlaps_marks_and_ties(spark):
    texts = [
        ("a a a a A a a", "x"), ("b c.b c,b\nc b\tc  b   c", "x"), ("new york city " * 12, "x"), ("New York! new york? york", "x"),
        ("é é É é", None), ("p q r s p q r s", "und"), ("..!?", "x"), ("\x0b\x0c\r", "x"), ("one", "x"), ("k\x01l m k\x01l m", "y"),
    ]
    for least in (1, 2, 5):
        same(spark, spark.createDataFrame(texts, "text string, lang string"), least=least)
        same(spark, spark.createDataFrame(texts, "text string, lang string"), least=least, share=100)


def test_odd_rows(spark, docs, none):
    assert same(spark, docs, least=2)
    assert same(spark, none) == []


def test_runs_and_buckets_do_not_show(spark, monkeypatch):
    docs = table(spark, SF, "documents").repartition(3)
    want = {tuple(r) for r in C.counted(docs, least=3).collect()}
    assert len(want) > 1000
    for name, size in (("RUN", 257), ("HELD", 4096), ("PER_BUCKET", 1000), ("ADDED", 300)):
        monkeypatch.setattr(C, name, size)
    assert {tuple(r) for r in C.counted(docs.repartition(7), least=3).collect()} == want


def test_scores_beyond_64_bits(spark):
    counts = [("x", "", 4 * 10**12 + 7), ("x", "a", 3 * 10**12), ("x", "b", 10**12 + 7), ("x", "a b", 10**12)]
    (r,) = C._scored(spark.createDataFrame(counts, "lang string, phrase string, f bigint"), 10, 50).collect()
    assert r.score == 1_000_000 * 10**24 // (3 * 10**12 * (10**12 + 7)) and r.n == 4 * 10**12 + 7


def test_joins_are_merges_without_broadcast(spark):
    plan = C.phrases(table(spark, SF, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") >= 2 and "ShuffledHashJoin" not in plan
