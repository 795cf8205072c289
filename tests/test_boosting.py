"""Boosted trees against a search over all cuts of all rows."""

import itertools
import random
import threading

import pytest
from conftest import day
from pyspark.sql import functions as F

from tidemark.operators import boosting, models
from tidemark.sources.layers import LayerStore

PENALTY, RATE, UNIT = 10.0, 0.2, boosting.UNIT


def rows_of(n=300, seed=1):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        x, z, c = rng.uniform(0, 1), rng.randint(0, 4), 7.0
        out.append((x, float(z), c, (3.0 if x > 0.5 else 0.0) + (2.0 if z >= 3 and x <= 0.5 else 0.0) + rng.gauss(0, 0.1)))
    return out


def brute(rows, edges, depth, trees):
    """Trees grown by trying every cut of every input in every node."""
    bins = [[sum(r[i] > e for e in es) for i, es in enumerate(edges)] for r in rows]
    base = round(sum(r[-1] for r in rows) / len(rows), 6)
    half_up = lambda v: int(abs(v) + 0.5) * (1 if v >= 0 else -1)
    rest = [half_up((r[-1] - base) * UNIT) for r in rows]
    grown = []
    for _ in range(trees):
        at = [0] * len(rows)
        inputs, cuts = [], []
        for level in range(depth):
            for node in range(1 << level):
                mine = [k for k in range(len(rows)) if at[k] == node]
                best = (-1, 0, 0.0)
                score = lambda ks: sum(rest[k] for k in ks) ** 2 / (len(ks) + PENALTY)  # noqa: B023, E731
                for i, es in enumerate(edges):
                    for cut in range(len(es)):
                        left = [k for k in mine if bins[k][i] <= cut]
                        if not left or len(left) == len(mine):
                            continue
                        right = [k for k in mine if bins[k][i] > cut]
                        gain = (score(left) + score(right) - score(mine)) / UNIT / UNIT
                        if gain > best[2] + 1e-9:
                            best = (i, cut, gain)
                inputs.append(best[0])
                cuts.append(best[1])
            first = len(inputs) - (1 << level)
            at = [
                2 * a + (inputs[first + a] >= 0 and bins[k][inputs[first + a]] > cuts[first + a]) for k, a in enumerate(at)
            ]
        leaves = []
        for leaf in range(1 << depth):
            mine = [k for k in range(len(rows)) if at[k] == leaf]
            leaves.append(RATE * sum(rest[k] for k in mine) / UNIT / (len(mine) + PENALTY) if mine else 0.0)
        rest = [v - half_up(leaves[a] * UNIT) for v, a in zip(rest, at)]
        grown.append((inputs, cuts, leaves))
    return grown


@pytest.fixture(scope="module")
def keep(spark, tmp_path_factory):
    store = LayerStore(spark, str(tmp_path_factory.mktemp("boost")))
    return lambda df: store.write(df, "t", "x")


def test_every_cut_is_the_best(spark, keep):
    rows = rows_of()
    frame = spark.createDataFrame(rows, "x double, z double, c double, y double")
    forest = boosting.train(frame, ["x", "z", "c"], "y", keep, trees=3, depth=2, bins=8, settle=2)
    assert forest.edges[2] == () and len(forest.edges[0]) == 7
    for tree, (inputs, cuts, leaves) in zip(forest.trees, brute(rows, forest.edges, 2, 3)):
        assert list(tree.inputs) == inputs
        assert [c for c, i in zip(tree.cuts, inputs) if i >= 0] == [c for c, i in zip(cuts, inputs) if i >= 0]
        assert list(tree.leaves) == pytest.approx(leaves, abs=1e-9)
    other = boosting.train(frame.repartition(7), ["x", "z", "c"], "y", keep, trees=3, depth=2, bins=8, settle=2)
    assert other.trees == forest.trees and forest.gains["x"] > forest.gains["z"] > forest.gains["c"] == 0


def test_answers_come_close(spark, keep):
    frame = spark.createDataFrame(rows_of(600, 3), "x double, z double, c double, y double")
    forest = boosting.train(frame, ["x", "z", "c"], "y", keep, depth=2, bins=16, penalty=1.0)
    guess = boosting.value(forest, [F.col(c) for c in ("x", "z", "c")])
    got = frame.select(F.avg(F.abs(F.col("y") - guess)).alias("e"), F.avg(F.abs(F.col("y") - forest.base)).alias("b")).first()
    assert got.e < 0.25 * got.b


def test_empty_constant_and_null_inputs(spark, keep):
    schema = "x double, y double"
    assert boosting.train(spark.createDataFrame([], schema), ["x"], "y", keep, trees=1).base == 0
    flat = boosting.train(spark.createDataFrame([(None, 2.0)] * 30, schema), ["x"], "y", keep, trees=2, depth=2)
    assert all(set(t.inputs) == {-1} for t in flat.trees) and flat.base == 2.0
    assert spark.range(1).select(boosting.value(flat, [F.lit(None).cast("double")]).alias("v")).first().v == 2.0


def test_forecasts_use_known_days_only(spark):
    """A series that repeats every 30 days is forecast from its lags; another without data is all 0."""
    rng = random.Random(5)
    shape = [rng.uniform(50, 150) for _ in range(30)]
    rows = [("A", day(t + 1), shape[t % 30]) for t in range(240)] + [("Z", day(t + 1), 0.0) for t in range(240)]
    frame = spark.createDataFrame(rows, "country_region string, date date, target_cases double")
    model = models.fit(frame, "boosted")
    exog = frame.select("country_region").distinct().crossJoin(
        spark.createDataFrame([(day(240 + h),) for h in range(1, 31)], "date date")
    )
    got = {(r.series, (r.ts - day(240)).days): r for r in model.predict(exog).collect()}
    assert len(got) == 60
    misses = [abs(got["A", h].forecast - shape[(239 + h) % 30]) for h in range(1, 31)]
    mean = sum(shape) / 30
    assert sum(misses) < 0.25 * sum(abs(v - mean) for v in shape)
    assert all(abs(got["Z", h].forecast) < 0.2 for h in range(1, 31))
    widths = [got["A", h].upper_bound - got["A", h].lower_bound for h in range(1, 31)]
    assert all(a <= b + 1e-9 for a, b in itertools.pairwise(widths)) and widths[0] >= 0
    ranked = model.feature_importance().where("series = 'A'").orderBy("rank").collect()
    assert ranked[0].feature_name in ("lag_30", "lag_60") and sum(r.score for r in ranked) == pytest.approx(1)


def test_both_forests_of_a_fit_grow_at_the_same_time(spark, monkeypatch):
    both, train, got = threading.Barrier(2), boosting.train, []

    def met(*args, **how):
        both.wait(60)  # fails unless the other forest is begun too
        got.append(spark.sparkContext.getLocalProperty("of.the.caller"))
        return train(*args, **how, trees=1, depth=1)

    monkeypatch.setattr(boosting, "train", met)
    rows = [(s, day(t + 1), float(t % 7)) for s in "AB" for t in range(120)]
    spark.sparkContext.setLocalProperty("of.the.caller", "here")
    models.fit(spark.createDataFrame(rows, "country_region string, date date, target_cases double"), "boosted")
    spark.sparkContext.setLocalProperty("of.the.caller", None)
    assert got == ["here", "here"]


def test_forests_grown_together_are_those_grown_alone(spark, keep):
    frames = [spark.createDataFrame(rows_of(n, seed), "x double, z double, c double, y double") for n, seed in ((300, 1), (200, 2))]
    how = {"trees": 3, "depth": 2, "bins": 8, "settle": 2}
    together = boosting.train_together(frames, ["x", "z", "c"], "y", keep, **how)
    assert together == [boosting.train(f, ["x", "z", "c"], "y", keep, **how) for f in frames]
