import random
import re

import numpy as np
import xxhash

from tidemark.llm import simhash_pivot as op
from tidemark.llm.components import components


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, bits=3):
    n = len(prints)
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    p = np.array(prints, np.uint64)
    for i in range(n):
        for j in np.flatnonzero(np.bitwise_count(p[i + 1 :] ^ p[i]) <= bits) + i + 1:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_frames(docs, none):
    rows = [tuple(r)[:2] for r in docs.collect()]
    prints = [brute_print(t) for _, t in rows]
    root = brute_components(prints)
    least = {}
    for (i, _), r in zip(rows, root):
        least.setdefault(r, []).append(i)
    least = {r: min((i for i in ids if i is not None), default=None) for r, ids in least.items()}
    want = sorted((str(i), f"{p:016x}", str(least[r])) for (i, _), p, r in zip(rows, prints, root))
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in op.near(docs).collect())
    assert got == want

    out = op.survivors(docs)
    assert out.dtypes == docs.dtypes
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(str(i) for i in least.values())
    assert op.near(none).collect() == [] and op.survivors(none).collect() == []


def flips(rnd, value, n):
    for b in rnd.sample(range(64), n):
        value ^= 1 << b
    return value


def planted(rnd, n):
    """Fingerprints with chains, dense balls and lone ones."""
    out = {0}
    while len(out) < n:
        centre = rnd.getrandbits(64)
        out.add(centre)
        for _ in range(rnd.choice([0, 0, 1, 3, 30])):
            out.add(flips(rnd, centre, rnd.choice([1, 2, 3, 4, 5])))
        step = centre
        for _ in range(rnd.choice([0, 0, 5])):
            step = flips(rnd, step, 3)
            out.add(step)
    return sorted(out)[:n]


def test_all_links_are_found(spark):
    rnd = random.Random(1)
    prints = planted(rnd, 3000)
    root = brute_components(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    for groups in (4, 6, 8):
        df = spark.createDataFrame([(s,) for s in signed], "print bigint")
        labels = {r.node: r.label for r in components(op.links(df, 3, groups)).collect()}
        got = [labels.get(s, s) for s in signed]
        pairs = {}
        for r, g in zip(root, got):
            assert pairs.setdefault(r, g) == g
        assert len(set(pairs.values())) == len(pairs)


def test_forest_of_a_large_key_equals_brute_force(monkeypatch):
    rnd = random.Random(3)
    centre = rnd.getrandbits(64)
    prints = sorted({flips(rnd, centre, rnd.choice([0, 1, 2, 3, 4, 6, 8])) for _ in range(1500)})
    root = brute_components(prints)
    whole = op.forest(np.array(prints, np.uint64), 3)
    monkeypatch.setattr(op, "LARGE", 40)
    cut = op.forest(np.array(prints, np.uint64), 3)
    assert whole.tolist() == root and cut.tolist() == root


def test_table_bounds_the_distance():
    rnd = np.random.default_rng(0)
    a = rnd.integers(0, 1 << 63, 500).astype(np.uint64)
    b = a ^ (np.uint64(1) << rnd.integers(0, 64, 500).astype(np.uint64))
    refs = np.concatenate([op.STRUCTURED, op.SCATTERED])
    assert np.abs(op.distances(a, refs).astype(int) - op.distances(b, refs)).max() <= 1
    assert (np.abs(op.coordinates(a) - op.coordinates(b)).sum(axis=1) == 1).all()


def test_components(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, j) for j in range(1001, 1400)] + [(7, 7), (5000, 4999), (None, 3)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert {got[i] for i in range(301)} == {0}
    assert {got[i] for i in range(1000, 1400)} == {1000}
    assert got[5000] == got[4999] == 4999
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
