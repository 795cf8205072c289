"""Exponential smoothing against the recursion written out, and intervals against all errors."""

import math
import random

import numpy as np
import pytest
from conftest import daily, day

from tidemark.operators import models, smoothing

D = smoothing.DAMPING


def recursion(y, a, b, g, period=7):
    """(level, trend, season of the next day on) after each day from the end of the first season."""
    level = sum(y[:period]) / period
    trend = (sum(y[period : 2 * period]) / period - level) / period
    season = [v - level for v in y[:period]]
    out = {period - 1: (level, trend, list(season))}
    for t in range(period, len(y)):
        new = a * (y[t] - season[0]) + (1 - a) * (level + D * trend)
        trend = b * (new - level) + (1 - b) * D * trend
        season = [*season[1:], g * (y[t] - new) + (1 - g) * season[0]]
        level = new
        out[t] = (level, trend, list(season))
    return out


def ahead(state, h):
    level, trend, season = state
    return level + sum(D**i for i in range(1, h + 1)) * trend + season[(h - 1) % 7]


def misses(y, weights, horizon):
    return {
        h: [y[t + h] - ahead(s, h) for t, s in recursion(y, *weights).items() if t >= 28 and t + h < len(y)]
        for h in range(1, horizon + 1)
    }


def series(n, seed):
    rng = random.Random(seed)
    return [100 + 3 * t * (seed % 2) + 20 * math.sin(t * 2 * math.pi / 7) + rng.gauss(0, 5) for t in range(n)]


@pytest.fixture(scope="module")
def fitted(spark):
    values = {"A": series(90, 1), "B": series(61, 2), "C": [0.0] * 70}
    train = None
    for name, v in values.items():
        rows = daily(spark, v, "target_cases", name, "double")
        train = rows if train is None else train.union(rows)
    model = models.fit(train, "ets", horizon=10)
    return values, model, {r.country_region: r for r in model.params.collect()}


def test_weights_have_the_least_error(fitted):
    values, _, params = fitted
    for name, y in values.items():
        def mse(w, y=y):
            every = [e for es in misses(y, w, 10).values() for e in es]
            return sum(e * e for e in every) / len(every)

        r = params[name]
        scores = [mse(w) for w in smoothing.GRID]
        assert r.mse == pytest.approx(min(scores), rel=1e-9)
        assert (r.alpha, r.beta, r.gamma) == smoothing.GRID[int(np.argmin(scores))]


def test_state_forecast_and_interval(spark, fitted):
    values, model, params = fitted
    days = {n: len(v) for n, v in values.items()}
    exog = spark.createDataFrame(
        [(n, day(k + h)) for n, k in days.items() for h in range(1, 13)], "country_region string, date date"
    )
    got = {(r.series, (r.ts - day(days[r.series])).days): r for r in model.predict(exog, 0.8).collect()}
    for name, y in values.items():
        r = params[name]
        weights = (r.alpha, r.beta, r.gamma)
        state = recursion(y, *weights)[len(y) - 1]
        assert r.level == pytest.approx(state[0]) and list(r.season) == pytest.approx(state[2])
        under = over = 0.0
        for h in range(1, 13):
            p = got[name, h]
            assert p.forecast == pytest.approx(ahead(state, h))
            if h <= 10:
                low, high = np.quantile(misses(y, weights, 10)[h], [0.1, 0.9])
                under, over = min(under, low), max(over, high)
            assert p.lower_bound == pytest.approx(p.forecast + under)
            assert p.upper_bound == pytest.approx(p.forecast + over)


def test_short_null_and_missing_series(spark):
    rows = daily(spark, [4.0, 6.0], "target_cases", "S", "double").union(daily(spark, [None] * 20, "target_cases", "N", "double"))
    model = models.fit(rows, "ets")
    exog = spark.createDataFrame([("S", day(3)), ("N", day(21)), ("X", day(3))], "country_region string, date date")
    got = {r.series: (r.forecast, r.lower_bound, r.upper_bound) for r in model.predict(exog).collect()}
    assert got == {"S": (5.0, 5.0, 5.0), "N": (0.0, 0.0, 0.0)}
    assert models.fit(rows.limit(0), "ets").predict(exog).collect() == []
    assert model.feature_importance().collect() == []


def test_beats_the_seasonal_naive_model(spark):
    from tidemark.operators import forecast as fc
    from tidemark.plans.queries import pipeline_for

    p = pipeline_for(spark, "/root/testdata/sf0.01")
    ours, naive = (fc.overall_metrics(p.with_method(m).evaluation).first() for m in ("ets", "seasonal_naive"))
    assert ours.overall_mae < naive.overall_mae and ours.overall_wmape < naive.overall_wmape
