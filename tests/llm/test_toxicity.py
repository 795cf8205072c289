import math

import duckdb
import numpy as np
import pytest

from tidemark.llm import toxicity as op
from tidemark.llm.common import table

SF = "/root/testdata/sf0.01"


def toy(rng, n):
    words = ["".join(rng.choice(list("bcdfgklm"), 7)) for _ in range(300)]
    texts, labels = [], []
    for i in range(n):
        t = list(rng.choice(words, 30))
        toxic = i % 3 == 0
        for w in rng.choice(["vile", "rotten", "nasty"], rng.integers(1, 7)) if toxic else ():
            t.insert(int(rng.integers(len(t))), str(w))
        texts.append(" ".join(t))
        labels.append(int(toxic))
    return texts, np.array(labels)


def test_grades_are_ordered_and_told_apart():
    texts, labels = toy(np.random.default_rng(0), 900)
    model = op.fit(texts[:600], labels[:600])
    assert (np.diff(model.theta) > 0).all()
    above = op.Scorer(model).above(texts[600:])
    assert (np.diff(above, axis=1) <= 0).all()
    assert ((above[:, 0] >= 0.5) == labels[600:]).mean() > 0.99
    # More and other marks mean a higher expected grade: one weight vector for all thresholds.
    few, many = op.Scorer(model).above(["vile bcd", "vile rotten nasty bcd"]).sum(axis=1)
    assert many > few


@pytest.mark.parametrize("labels, want", [([], 0), ([0, 0], 0), ([1, 1], 1)])
def test_labels_of_one_kind(labels, want):
    model = op.fit(["a b"] * len(labels), np.array(labels, int))
    assert (op.Scorer(model).above(["x"])[0, 0] >= 0.5) == bool(want)


def test_held_out_accuracy(spark):
    """Trained on four fifths of the labelled rows, measured on the rest."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = op.train(docs, labels, where="crc32(cast(cast(id AS string) AS binary)) % 5 != 0")
    got = {r.doc_id: r.toxic for r in op.score(docs, model).collect()}
    truth = duckdb.sql(f"SELECT doc_id, toxic FROM '{SF}/labels.parquet'").fetchall()
    import zlib

    held = [(got[i], y) for i, y in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([p == y for p, y in held]) > 0.9


def test_frames(docs, none, spark):
    labels = spark.createDataFrame([(4, 0), (9, 1), (9, 1), (None, 1), (5, None)], "doc_id bigint, toxic int")
    model = op.train(docs, labels)
    got = op.score(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r.severity <= 3 and r.toxic in (0, 1) for r in got)
    out = op.survivors(docs, model)
    assert out.dtypes == docs.dtypes
    assert out.count() == sum(1 - r.toxic for r in got)
    empty = op.train(none, labels.limit(0))
    assert op.score(none, empty).collect() == [] and op.survivors(none, empty).collect() == []
    assert op.survivors(docs, empty).count() == docs.count()


def test_objective_and_gradient_by_brute_force():
    """The likelihood text by text in plain Python, its slope by differences."""
    rng = np.random.default_rng(2)
    names, ridge = 5, 0.01
    held = [[0, 2], [], [1, 2, 4], [3], [0, 1, 2, 3, 4], [4], [2]]
    grade, weight = np.array([0, 1, 2, 3, 3, 0, 2]), rng.random(7)
    row = np.repeat(np.arange(7), [len(h) for h in held])
    at = np.array([f for h in held for f in h])

    def plain(state):
        theta = [state[names]]
        for x in state[names + 1 :]:
            theta.append(theta[-1] + math.exp(x))
        below = lambda k, z: 0.0 if k < 0 else 1.0 if k == len(theta) else 1 / (1 + math.exp(z - theta[k]))
        out = 0.5 * ridge * sum(x * x for x in state[:names])
        for h, g, c in zip(held, grade, weight):
            z = sum(state[f] for f in h)
            out -= c * math.log(below(g, z) - below(g - 1, z))
        return out

    assert op.GRADES == 4
    for _ in range(5):
        state = rng.normal(size=names + op.GRADES - 1)
        value, slope = op.objective(state, names, row, at, grade, weight, ridge)
        assert value == pytest.approx(plain(state))
        for i in range(len(state)):
            step = np.zeros(len(state))
            step[i] = 1e-5
            assert slope[i] == pytest.approx((plain(state + step) - plain(state - step)) / 2e-5, abs=1e-6)


def test_score_by_brute_force(spark):
    """Each text's severity and label from the model's weights, word by word."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = op.train(docs, labels)
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    for r in op.score(docs, model).collect():
        own = {f for w in set(op.WORDS.findall((texts[r.doc_id] or "").lower())) for f in op.parts(w)}
        z = sum(model.weights.get(f, 0.0) for f in own)
        above = [1 / (1 + math.exp(t - z)) for t in model.theta]
        assert r.severity == pytest.approx(sum(above))
        assert r.toxic == int(above[0] >= 0.5)
