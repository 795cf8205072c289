"""Rolling origins against one refit per origin, and permutation importance against plain Python."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from conftest import daily, day
from pyspark.sql import functions as F

from tidemark.operators import backtest, models


@pytest.fixture(scope="module")
def train(spark):
    rng = random.Random(2)
    values = {n: [50 + k * t + rng.gauss(0, 9) for t in range(40)] for n, k in (("A", 2), ("B", -1), ("C", 0))}
    rows = None
    for n, v in values.items():
        one = daily(spark, v, "target_cases", n, "double")
        rows = one if rows is None else rows.union(one)
    return values, rows


def test_each_origin_equals_a_refit(spark, train):
    values, rows = train
    got = backtest.origins(rows, window=15, horizon=4).collect()
    assert len(got) == 3 * (4 * (40 - 15 + 1) - 4 - 3 - 2 - 1)
    for r in got:
        end = (r.origin - day(1)).days
        y = values[r.series][end - 14 : end + 1]
        slope, cut = np.polyfit(range(15), y, 1)
        assert r.forecast == pytest.approx(cut + slope * (14 + r.step), rel=1e-9)
        assert r.actual == values[r.series][end + r.step] and (r.ts - r.origin).days == r.step
    early = models.fit(rows.where(F.col("date").between(str(day(6)), str(day(20)))), "linear_trend")
    exog = spark.createDataFrame([("A", day(23))], "country_region string, date date")
    mine = next(r.forecast for r in got if (r.series, r.origin, r.step) == ("A", day(20), 3))
    assert early.predict(exog).first().forecast == pytest.approx(mine)


def test_bands_are_quantiles_that_never_narrow(train):
    tested = backtest.origins(train[1], window=15, horizon=4)
    errors = defaultdict(list)
    for r in tested.collect():
        errors[r.series, r.step].append(r.actual - r.forecast)
    got = {(r.series, r.step): (r.under, r.over) for r in backtest.bands(tested, 0.8).collect()}
    for n in "ABC":
        under = over = 0.0
        for step in range(1, 5):
            low, high = np.quantile(errors[n, step], [0.1, 0.9])
            under, over = min(under, low), max(over, high)
            assert got[n, step] == pytest.approx((under, over))
    with pytest.raises(ValueError):
        backtest.bands(tested, 1.0)


def test_calibrated_keeps_what_it_has_no_band_for(spark, train):
    made = spark.createDataFrame(
        [("A", day(41), 5.0, 1.0, 9.0), ("Z", day(41), 5.0, 1.0, 9.0)],
        "series string, ts date, forecast double, lower_bound double, upper_bound double",
    )
    errors = spark.createDataFrame([("A", 1, -2.0, 3.0)], "series string, step int, under double, over double")
    got = {r.series: tuple(r)[2:] for r in backtest.calibrated(made, errors, F.lit(day(40))).collect()}
    assert got == {"A": (5.0, 3.0, 8.0), "Z": (5.0, 1.0, 9.0)}


def test_no_row_is_read_twice(train):
    plan = backtest.origins(train[1])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_coverage_lies_near_the_level(pipeline, spark):
    from conftest import SF

    from tidemark.plans import queries as Q

    got = {r.method: r for r in Q.queries()["interval_coverage"](spark, SF).collect()}
    assert set(got) == {"ets", "linear_trend", "linear_trend_calibrated"}
    for method in ("ets", "linear_trend_calibrated"):
        assert 88 <= got[method].coverage_pct <= 99
        assert got[method].width_later > got[method].width_first_week


def test_permutation_importance(spark):
    rng = random.Random(4)
    rows = []
    for n in "AB":
        for t in range(1, 41):
            x, z = rng.gauss(0, 1), rng.gauss(0, 1)
            rows.append((n, day(t), 10 * x + rng.gauss(0, 0.1), x, z, 1.0))
    frame = spark.createDataFrame(rows, "country_region string, date date, target_cases double, x double, z double, c double")
    model = models.fit(frame, "ridge")
    got = models.importance_permutation(model, frame, seed=7)
    base = {(r.series, r.ts): r.forecast for r in model.predict(frame.drop("target_cases")).collect()}
    params = {r.country_region: r for r in model.params.collect()}
    for n in "AB":
        mine = [r for r in rows if r[0] == n]
        for r in got.where(F.col("series") == n).collect():
            j = model.inputs.index(r.feature_name)
            own = {d: {"x": x, "z": z, "c": c, "trend": (d - dt0()).days}[r.feature_name] for _, d, _, x, z, c in mine}
            order = sorted(own, key=lambda d: hashlib.md5(f"{n}|{d}|{r.feature_name}|7".encode()).hexdigest())
            rise = []
            for k, d in enumerate(sorted(own)):
                p, sd = params[n], params[n].sd_x[j]
                f = base[n, d]
                moved = f + (p.beta[j] * (own[order[k]] - own[d]) / sd if sd > 0 else 0.0)
                y = next(m[2] for m in mine if m[1] == d)
                rise.append(abs(y - moved) - abs(y - f))
            assert r.score == pytest.approx(sum(rise) / len(rise), abs=2e-6)
        first = got.where((F.col("series") == n) & (F.col("rank") == 1)).first()
        assert first.feature_name == "x" and first.score > 5
    again = models.importance_permutation(model, frame.repartition(9), seed=7)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, again.collect()))
    assert models.importance_permutation(models.fit(frame, "ets"), frame).collect() == []


def dt0():
    import datetime as dt

    return dt.date(2020, 1, 1)
