"""The pipeline, stage by stage, against plain Python on the same rows."""

import hashlib
import string
from collections import Counter, defaultdict

import pytest
import sentencepiece

import corpus_pipeline
from tidemark.llm import mixing, sentencepiece_fst, simhash_pivot, toxicity
from tidemark.llm.common import table

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        out.append(docs.collect())
    return out


def test_toxicity(spark, stages):
    docs = table(spark, SF, "documents")
    model = toxicity.train(docs, table(spark, SF, "labels"))
    scorer = toxicity.Scorer(model)
    want = [r.doc_id for r in docs.collect() if scorer.above([r.text])[0, 0] < 0.5]
    assert sorted(r.doc_id for r in stages[0]) == sorted(want)


def test_exact(stages):
    best = defaultdict(list)
    for r in stages[0]:
        best[(r.text or "").translate(LOWER)].append(r.doc_id)
    assert sorted(r.doc_id for r in stages[1]) == sorted(map(max, best.values()))


def test_near(stages):
    prints = [simhash_pivot.fingerprint(r.text) for r in stages[1]]
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, p in enumerate(prints):
        for j in range(i):
            if (p ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(stages[1]):
        k = find(i)
        least[k] = min(least.get(k, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in stages[2]) == sorted(least.values())


def test_mix(spark, stages):
    docs = spark.createDataFrame(stages[2], table(spark, SF, "documents").schema)
    want = {r.doc_id: r.times for r in mixing.plan(docs).collect() if r.times}
    assert Counter(r.doc_id for r in stages[3]) == want


def test_encoding(stages):
    theirs = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_fst.MODEL)
    assert Counter(r.doc_id for r in stages[4]) == Counter(r.doc_id for r in stages[3])
    for r in stages[4]:
        assert r.ids == theirs.encode(r.text or "") and r.n_tokens == len(r.ids)


def test_columns_and_run(spark, stages):
    fields = table(spark, SF, "documents").columns
    assert all(list(rows[0].asDict()) == fields for rows in stages[:-1])
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, tuple(r.ids)) for r in got) == sorted((r.doc_id, tuple(r.ids)) for r in stages[4])


def test_odd_rows(spark, docs, none, tmp_path):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for rows, least in ((docs.select(columns), 1), (none.select(columns), 0)):
        for _, stage in corpus_pipeline.STAGES:
            rows = stage(spark, rows, str(tmp_path))
        assert rows.count() >= least


def test_decoding(stages):
    theirs = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_fst.MODEL)
    for r in stages[4]:
        back = theirs.decode(list(r.ids))
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()
        assert r.round_trip == (back == (r.text or "").replace("\u2581", " "))
