import itertools
import zlib

import duckdb
import numpy as np

from tidemark.llm import quality_crf as op
from tidemark.llm.common import table

SF = "/root/testdata/sf0.01"


def test_marginals_equal_the_sums_over_labellings():
    rng = np.random.default_rng(2)
    rows = [np.arange(0, 4), np.arange(4, 5), np.arange(5, 11)]
    x = rng.normal(size=(11, 6)).astype(np.float32)
    model = op.Model(rng.normal(size=6), rng.normal(size=(2, 2)))
    good, went, total = op.marginals(model, x, op.Layout(rows))
    want, moves, logs = np.zeros(11), np.zeros((2, 2)), 0.0
    for r in rows:
        z, first = 0.0, np.zeros(len(r))
        steps = np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=len(r)):
            p = np.exp(sum(x[i] @ model.weights * v for i, v in zip(r, y)) + sum(model.moves[a, b] for a, b in zip(y, y[1:])))
            z += p
            first += p * np.array(y)
            for a, b in zip(y, y[1:]):
                steps[a, b] += p
        want[r], moves, logs = first / z, moves + steps / z, logs + np.log(z)
    assert np.allclose(good, want, atol=1e-5) and np.allclose(went, moves, atol=1e-5) and abs(total - logs) < 1e-4


def test_measures():
    x, lengths, rows = op.measure(["One line.\n\nLOUD!! LOUD!!", "", "a | b\na | b\na | b\na | b"])
    assert lengths.tolist() == [9, 0, 13, 0, 5, 5, 5, 5] and [len(r) for r in rows] == [3, 1, 4]
    assert x.shape == (8, 3 * op.WIDTH + 3)


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = op.train(docs, labels, where="crc32(cast(cast(id AS string) AS binary)) % 5 != 0")
    got = {r.doc_id: r for r in op.score(docs, model).collect()}
    assert len(got) == 1000
    truth = duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall()
    held = [(got[i].predicted, y) for i, y in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([p == y for p, y in held]) > 0.95
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)


def test_frames(docs, none, spark):
    labels = spark.createDataFrame([(4, 0), (9, 1), (9, 1), (None, 1), (5, None)], "doc_id bigint, quality int")
    model = op.train(docs, labels)
    got = op.score(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert op.score(none, op.train(none, labels.limit(0))).collect() == []
