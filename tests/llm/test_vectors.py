"""Vector codes: the curve, the boxes and the codebooks against plain Python."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import vector_codes as V
from tidemark.llm.common import table

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<float>, label int, row int, code string, n int, `a.b` string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, x, 1, "c", 2, "dot") for i, v, x in rows], SCHEMA)


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    """(vec_id, label, code, error) and the codebooks, point by point with Python's integers."""
    good = [(i, [math.floor(scale * float(np.float32(x))) for x in v], lab) for i, v, lab in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(good[0][1]) // parts if good else 0
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in good[:entries]] for p in range(parts)]

    def near(piece, book):
        far = [sum((x - y) ** 2 for x, y in zip(piece, e)) for e in book]
        best = min(far)
        return far.index(best), best

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for _, v, _ in good:
                groups.setdefault(near(cut(v, p), books[p])[0], []).append(cut(v, p))
            books[p] = [
                [sum(c) // len(groups[e]) for c in zip(*groups[e])] if e in groups else entry
                for e, entry in enumerate(books[p])
            ]
    out = []
    for i, v, lab in good:
        found = [near(cut(v, p), books[p]) for p in range(parts)]
        out.append((i, lab, "".join(f"{e:02x}" for e, _ in found), sum(d for _, d in found)))
    return out, books


def same(spark, rows, **options):
    coded, books = V.compress(frame(spark, rows), **options)
    got = [(r.vec_id, r.label, r.code, r.error) for r in coded.collect()]
    want, theirs = brute(rows, **options)
    key = lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert [[list(e) for e in p] for p in books.entries] == theirs
    return coded, books


def test_curve_visits_neighbours():
    for n, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=n)))
        place = V.hilbert(cells, bits)
        assert sorted(place) == list(range(len(cells)))
        walk = cells[np.argsort(place)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_shortlist_holds_every_nearest_entry():
    rng = np.random.default_rng(5)
    for _ in range(300):
        points = rng.integers(-20, 20, (rng.integers(1, 30), 3)) + rng.integers(-40, 40, 3)
        book = rng.integers(-40, 40, (8, 3))
        book[5] = book[2]  # ties
        among = V.shortlist(points.min(axis=0), points.max(axis=0), book)
        entry, far = V.nearest(points, book, among)
        every = ((points[:, None] - book[None]) ** 2).sum(axis=2)
        assert (entry == every.argmin(axis=1)).all() and (far == every.min(axis=1)).all()


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(V.blocks, "__defaults__", (16,))
    rng = random.Random(3)
    centres = [[rng.uniform(-1, 1) for _ in range(24)] for _ in range(9)]
    rows = [(i, [c + rng.gauss(0, 0.1) for c in centres[i % 9]], i % 4 or None) for i in range(400)]
    rows += [(1000 + i, [0.25] * 24, 1) for i in range(150)]  # copies of one vector
    coded, books = same(spark, rows)
    back = V.decode(coded, books).join(
        frame(spark, rows).select(F.col("vec_id").alias("of"), "embedding"), F.col("vec_id") == F.col("of")
    )
    for r in back.collect():
        gap = sum((math.floor(4096 * x) - 4096 * y) ** 2 for x, y in zip(r.embedding, r.vector))
        assert round(gap) == r.error


def test_odd_rows(spark):
    v = [0.5, -0.25, 0.125, 1.0] * 2
    rows = [
        (1, v, 1), (2, None, 1), (3, [None, *v[1:]], 2), (4, [math.nan, *v[1:]], 2), (5, [math.inf, *v[1:]], None),
        (6, [], 3), (None, [-x for x in v], None), (None, [-x for x in v], None), (7, v, None), (7, v, None),
        (8, [-0.0001] * 8, 5), (9, [3e4, -3e4] * 4, 5), (10, [1e5, -1e5] * 4, 5),
    ]
    same(spark, rows)
    same(spark, rows, parts=4, entries=3, rounds=2)
    out = V.report(frame(spark, rows)).collect()
    sums = {}
    for _, lab, _, e in brute(rows)[0]:
        sums[lab] = sums.get(lab, 0) + e
    label = {r[0]: r[2] for r in rows}
    assert all(r.label_error == sums[label[r.vec_id]] for r in out) and len(out) == 8


def test_large_components_stay_exact(spark):
    rows = [(i, [(-1.0) ** i * 2e4 * (1 + i / 20) + j for j in range(8)], 0) for i in range(20)]
    same(spark, rows, entries=4)


def test_nothing_to_code(spark):
    for rows in ([], [(1, None, 1), (2, [], 2)]):
        assert V.report(frame(spark, rows)).collect() == []


def test_query_on_any_partitioning(spark):
    vectors = table(spark, SF, "embeddings")
    one = {tuple(r) for r in V.report(vectors).collect()}
    other = {tuple(r) for r in V.report(vectors.repartition(13)).collect()}
    assert one == other and len(one) == vectors.count()


def test_parts_must_fit(spark):
    with pytest.raises(ValueError):
        V.compress(frame(spark, [(1, [1.0] * 9, 0)]))
