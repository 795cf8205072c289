import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import hmm as op


def random_model(rng, states, classes):
    initial = rng.dirichlet(np.ones(states))
    moves = rng.dirichlet(np.ones(states), states)
    emits = rng.dirichlet(np.ones(classes), states).T
    return initial, moves, np.ascontiguousarray(emits)


def likelihood(model, sequence):
    """Sum over all state paths."""
    initial, moves, emits = model
    total = 0.0
    for path in itertools.product(range(len(initial)), repeat=len(sequence)):
        p = initial[path[0]] * emits[sequence[0], path[0]]
        for a, b, x in zip(path, path[1:], sequence[1:]):
            p *= moves[a, b] * emits[x, b]
        total += p
    return total


def posterior_counts(model, sequences):
    initial, moves, emits = model
    n = len(initial)
    first, went, sent = np.zeros(n), np.zeros((n, n)), np.zeros(emits.shape)
    for s in sequences:
        z = likelihood(model, s)
        for path in itertools.product(range(n), repeat=len(s)):
            p = initial[path[0]] * emits[s[0], path[0]]
            for a, b, x in zip(path, path[1:], s[1:]):
                p *= moves[a, b] * emits[x, b]
            p /= z
            first[path[0]] += p
            for a, b in zip(path, path[1:]):
                went[a, b] += p
            for a, x in zip(path, s):
                sent[x, a] += p
    return first, went, sent


def test_recursions_equal_the_sums_over_paths():
    rng = np.random.default_rng(0)
    model = random_model(rng, 3, 5)
    sequences = [rng.integers(0, 5, n) for n in (1, 4, 6, 2, 6, 1)]
    layout = op.Layout(sequences)
    logs, _ = op.forward(model, layout)
    for place, k in enumerate(layout.order):
        assert logs[place] == pytest.approx(math.log(likelihood(model, sequences[k])))
    for got, want in zip(op.expected(model, layout), posterior_counts(model, sequences)):
        assert np.allclose(got, want, atol=1e-5)


def test_each_pass_raises_the_likelihood():
    rng = np.random.default_rng(1)
    truth = random_model(rng, 3, 12)
    sequences = []
    for _ in range(200):
        z, s = rng.choice(3, p=truth[0]), []
        for _ in range(15):
            s.append(rng.choice(12, p=truth[2][:, z]))
            z = rng.choice(3, p=truth[1][z])
        sequences.append(np.array(s))
    layout, model = op.Layout(sequences), random_model(rng, 3, 12)
    before = -np.inf
    for _ in range(8):
        now = op.forward(model, layout)[0].sum()
        assert now >= before - 1e-6
        before = now
        first, went, sent = op.expected(model, layout)
        model = first / first.sum(), went / went.sum(axis=1, keepdims=True), sent / sent.sum(axis=0)


def test_packing():
    for codes in ([], [0], [1 << 31, 7, 255, 256]):
        assert op.unpack(op.pack(np.array(codes, np.int64))).tolist() == codes


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or "")) + [None]


def check_counts(rows, got, part, of):
    learn = [t for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % of != part]
    counts = Counter(w for t in learn for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for i, t in rows:
        words = tokens(t)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        held = zlib.crc32(("" if i is None else str(i)).encode()) % of == part
        want[i, held, len(words), sum(counts[w] > 0 for w in words), n, round(base, 6)] += 1
    assert want == Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_counts(docs):
    rows = [tuple(r)[:2] for r in docs.collect()]
    check_counts(rows, op.score(docs, passes=1).collect(), 2, 7)


def test_without_training_rows(spark, none):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    got = {r.doc_id: r for r in op.score(df, held_part=0, held_of=1, passes=1).collect()}
    assert got[1].held_out and got[1].n_known == 0 and got[1].train_tokens == 0 and got[1].base_score == 0.0
    assert op.score(none).collect() == []


def test_held_out_texts_gain(spark):
    """Two languages that never mix in a text: states tell them apart, unigrams cannot."""
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"{'ab'[i % 2]}{w}" for w in rng.integers(0, 60, 40))) for i in range(400)]
    got = op.score(spark.createDataFrame(rows, "doc_id bigint, text string"), states=2, passes=3).where("held_out").collect()
    gain = sum(r.score - r.base_score for r in got) / sum(r.n_tokens for r in got)
    assert gain > 0.25  # log10 2 = 0.30 at best
