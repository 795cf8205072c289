import datetime as dt
import itertools

import numpy as np
import pytest
from conftest import column, daily, day
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators import forecast as fc
from tidemark.operators import models


def scored(spark, pairs):
    """evaluate() on (actual, forecast) pairs, one per day."""
    days = [day(i) for i in range(1, len(pairs) + 1)]
    pred = spark.createDataFrame(
        [("A", d, float(f), 0.0, 0.0) for d, (_, f) in zip(days, pairs)], S.FORECAST_SCHEMA
    )
    actual = spark.createDataFrame(
        [("A", d, float(a)) for d, (a, _) in zip(days, pairs)],
        "country_region string, date date, actual_cases double",
    )
    return fc.evaluate(pred, actual).first()


def training(spark, values, exog=None, series="A"):
    rows = [
        (series, day(i), float(v), float(exog[i - 1]) if exog is not None else 0.0)
        for i, v in enumerate(values, start=1)
    ]
    return spark.createDataFrame(
        rows, "country_region string, date date, target_cases double, x double"
    )


def ahead(spark, start, n, x=0.0, series="A"):
    return spark.createDataFrame(
        [(series, day(start + i), float(x)) for i in range(n)],
        "country_region string, date date, x double",
    )


def test_scores(spark):
    r = scored(spark, [(100, 50), (0, 0)])
    assert (r.eval_days, r.mae, r.smape, r.mape_filtered, r.wmape) == (2, 25.0, 33.33, None, 50.0)
    assert (r.total_actual, r.total_forecast, r.low_count_days) == (100.0, 50.0, 2)


def test_errors_use_the_unclipped_forecast(spark):
    r = scored(spark, [(0, -3)])
    assert (r.mae, r.total_forecast, r.wmape, r.smape) == (3.0, 0.0, None, 200.0)


def test_filtered_mape_takes_days_above_100(spark):
    assert scored(spark, [(200, 150), (100, 1)]).mape_filtered == 25.0


def test_means_between_two_results_do_not_depend_on_the_order_of_addition(spark):
    # Mean 1.5 for the actuals and 0.005 for the errors, whose sums as doubles may lie below.
    for values in itertools.permutations((1.39, 2.26, 0.85)):
        r = scored(spark, [(v, v + e) for v, e in zip(values, (0.0, 0.005, 0.01))])
        assert (r.avg_daily_actual, r.mae) == (2.0, 0.01)


def test_split_is_disjoint_and_holds_out_30_days(spark):
    t = training(spark, range(40))
    train, test = fc.train_split(t), fc.test_actuals(t)
    assert train.agg(F.max("date")).first()[0] == day(10)
    assert column(test, "date") == [day(i) for i in range(11, 41)]
    assert "target_cases" not in fc.test_exogenous(t).columns


def test_training_window_is_inclusive_and_drops_excluded(pipeline):
    t = pipeline.training
    last = pipeline.features.agg(F.max("date")).first()[0]
    assert t.agg(F.min("date")).first()[0] == last.replace(year=last.year - 1)
    counts = {r["count"] for r in t.groupBy(S.SERIES).count().collect()}
    assert counts == {366}
    assert t.filter(F.col(S.SERIES).isin("NATION_24")).count() == 0
    assert t.filter(" OR ".join(f"{c} IS NULL" for c in t.columns)).count() == 0


def test_month_arithmetic_clips_at_the_month_end(spark):
    rows = [("A", dt.date(2023, 2, 27)), ("A", dt.date(2023, 2, 28)), ("A", dt.date(2024, 2, 29))]
    df = spark.createDataFrame(rows, "country_region string, date date")
    from tidemark.functions.filters import trailing

    assert trailing(df, 12, "month", inclusive=True).count() == 2
    with pytest.raises(ValueError):
        trailing(df, 1, "year")


def test_future_starts_after_the_global_last_day_with_own_values(spark):
    t = training(spark, [1, 2, 3], [0.1, 0.2, 0.3]).union(
        training(spark, [5], [0.9], series="B")
    )
    out = fc.future_exogenous(t, 2)
    rows = sorted((r.country_region, r.date, r.x) for r in out.collect())
    assert rows == [
        ("A", day(4), 0.3), ("A", day(5), 0.3), ("B", day(4), 0.9), ("B", day(5), 0.9),
    ]


def test_seasonal_naive_repeats_the_last_week(spark):
    values = [float(v) for v in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 15)]
    model = models.fit(training(spark, values), "seasonal_naive")
    out = model.predict(ahead(spark, 15, 9)).orderBy("ts").collect()
    assert [r.forecast for r in out] == [8, 9, 10, 11, 12, 13, 15, 8, 9]
    sd = np.std([7] * 6 + [8], ddof=1)
    assert out[0].upper_bound - out[0].forecast == pytest.approx(1.959964 * sd, rel=1e-5)
    assert out[8].upper_bound - out[8].forecast == pytest.approx(
        1.959964 * sd * np.sqrt(2), rel=1e-5
    )


def test_linear_trend_matches_least_squares(spark):
    rng = np.random.default_rng(5)
    y = 3.0 * np.arange(20) + rng.normal(size=20)
    out = models.fit(training(spark, y), "linear_trend").predict(ahead(spark, 25, 1)).first()
    x = np.arange(20)
    slope, intercept = np.polyfit(x, y, 1)
    sd = np.sqrt(((y - intercept - slope * x) ** 2).sum() / 18)
    half = 1.959964 * sd * np.sqrt(1 + 1 / 20 + (24 - x.mean()) ** 2 / ((x - x.mean()) ** 2).sum())
    assert out.forecast == pytest.approx(intercept + slope * 24)
    assert out.upper_bound - out.forecast == pytest.approx(half, rel=1e-5)


def test_ridge_matches_a_direct_solution(spark):
    rng = np.random.default_rng(6)
    n = 60
    x = rng.normal(size=n)
    y = 2.0 * np.arange(n) + 5.0 * x + rng.normal(size=n)
    t = training(spark, y, x)
    model = models.fit(t, "ridge", penalty=0.5, weekdays=True)
    out = model.predict(t.drop("target_cases")).orderBy("ts").collect()

    days = [day(i) for i in range(1, n + 1)]
    weekday = np.array([[d.isoweekday() % 7 + 1 == k for k in range(2, 8)] for d in days])
    a = np.column_stack([np.arange(n), weekday, x]).astype(float)
    z = (a - a.mean(0)) / a.std(0)
    beta = np.linalg.solve(z.T @ z + 0.5 * np.eye(8), z.T @ (y - y.mean()))
    fit = y.mean() + z @ beta
    sd = np.sqrt(((y - fit) ** 2).sum() / (n - 9))
    assert np.allclose([r.forecast for r in out], fit)
    assert out[0].upper_bound - out[0].forecast == pytest.approx(1.959964 * sd, rel=1e-5)

    ranks = models.feature_importance(model).orderBy("rank").collect()
    assert [r["rank"] for r in ranks] == list(range(1, 9))
    assert sum(r.score for r in ranks) == pytest.approx(1.0)
    assert ranks[0].feature_name == "trend"
    assert ranks[0].score == pytest.approx(abs(beta[0]) / np.abs(beta).sum())


@pytest.mark.parametrize("method", models.METHODS)
def test_constant_series_gets_a_zero_width_interval(spark, method):
    out = models.fit(training(spark, [0.0] * 30), method).predict(ahead(spark, 31, 3)).collect()
    assert [(r.forecast, r.lower_bound, r.upper_bound) for r in out] == [(0.0, 0.0, 0.0)] * 3


@pytest.mark.parametrize("method", models.METHODS)
def test_constant_level_is_forecast_to_continue(spark, method):
    # 0.1 has no exact binary form, so sums of it carry rounding
    train = training(spark, [0.1] * 366, [0.7] * 366)
    out = models.fit(train, method).predict(ahead(spark, 367, 1, 0.9)).first()
    assert out.forecast == pytest.approx(0.1) and out.upper_bound == pytest.approx(0.1)


def test_ridge_is_stable_for_large_levels_with_little_spread(spark):
    rng = np.random.default_rng(7)
    x = 1e5 + rng.normal(size=200)
    y = 5e5 + 3.0 * x + rng.normal(size=200) * 0.01
    t = training(spark, y, x)
    out = models.fit(t, "ridge", penalty=1e-3).predict(t.drop("target_cases")).orderBy("ts")
    got = np.array([r.forecast for r in out.collect()])
    assert np.abs(got - y).max() < 0.1  # spread of y is about 3


@pytest.mark.parametrize("method", models.METHODS)
def test_very_short_series_do_not_fail(spark, method):
    out = models.fit(training(spark, [4.0]), method).predict(ahead(spark, 2, 1)).first()
    assert out.forecast == 4.0 and out.lower_bound == 4.0


@pytest.mark.parametrize("method", models.METHODS)
def test_bounds_enclose_the_forecast(pipeline, method):
    model = models.fit(pipeline.training, method)
    out = model.predict(fc.future_exogenous(pipeline.training))
    S.assert_schema(out, S.FORECAST_SCHEMA)
    assert out.count() == 24 * 30
    assert out.filter("lower_bound > forecast OR forecast > upper_bound").count() == 0
    assert out.filter("forecast IS NULL OR isnan(forecast)").count() == 0


def test_wider_interval_for_higher_confidence(spark):
    model = models.fit(training(spark, [1.0, 5.0, 2.0, 8.0]), "linear_trend")
    narrow, wide = (model.predict(ahead(spark, 5, 1), i).first() for i in (0.5, 0.99))
    assert wide.upper_bound > narrow.upper_bound
    with pytest.raises(ValueError):
        model.predict(ahead(spark, 5, 1), 1.0)


def test_unknown_method(spark):
    with pytest.raises(ValueError):
        models.fit(training(spark, [1.0]), "oracle")


def test_importance_is_that_of_the_fitted_model(spark):
    """Models without inputs name none, so that explanations do not invent any."""
    data = training(spark, [1.0, 2.0, 4.0], [1, 2, 3])
    trend = models.fit(data, "linear_trend").feature_importance()
    assert [(r.rank, r.feature_name, r.score) for r in trend.collect()] == [(1, "trend", 1.0)]
    naive = models.fit(data, "seasonal_naive").feature_importance()
    assert naive.collect() == [] and naive.dtypes == trend.dtypes


def test_smape_stays_in_range(pipeline):
    for method in models.METHODS:
        bad = pipeline.with_method(method).evaluation.filter("smape < 0 OR smape > 200")
        assert bad.count() == 0


def test_output_has_91_days_of_history_and_30_of_forecast(pipeline):
    from tidemark.operators.profile import forecast_day_counts

    rows = forecast_day_counts(pipeline.output).collect()
    assert {(r.historical_days, r.forecast_days) for r in rows} == {(91, 30)}
    negative = "forecasted_cases < 0 OR forecast_lower < 0"
    assert pipeline.output.filter(negative).count() == 0


def test_synthetic_forecast_is_repeatable_and_within_its_noise(pipeline):
    make = lambda seed: fc.synthetic_forecast(
        pipeline.long.repartition(seed), pipeline.key_map, since="2001-01-01", seed=7
    )
    a, b = make(3), make(5)
    assert a.exceptAll(b).count() == 0
    S.assert_schema(a, S.OUTPUT_SCHEMA)
    off = "forecasted_cases < 0.9 * actual_cases - 1 OR forecasted_cases > 1.15 * actual_cases + 1"
    assert a.filter(off).count() == 0
    assert a.filter("mape < 0 OR mape > 12").count() == 0


def test_importance_of_a_constant_target_is_zero(spark):
    out = models.importance_corr(training(spark, [1.0] * 5, [1, 2, 3, 4, 5])).collect()
    assert [(r["rank"], r.feature_name, r.score) for r in out] == [(1, "x", 0.0)]


def test_latest_per_key(spark):
    from tidemark.functions.filters import latest_per_key

    df = daily(spark, [3, 1, 2]).union(daily(spark, [9], series="B"))
    out = latest_per_key(df, ["country_region"], "date")
    assert sorted((r.country_region, r.v) for r in out.collect()) == [("A", 2), ("B", 9)]
