import statistics

import pytest
from conftest import daily, day
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import filters
from tidemark.functions.aggregates import exact_median, rounded_mean, text_pages
from tidemark.functions.filters import latest_per_key
from tidemark.functions.scalars import floor_zero, key_noise, pct, ratio


def value(spark, expr):
    return spark.range(1).select(expr.alias("v")).first().v


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-5, 10**12), min_size=1, max_size=60))
def test_median_equals_the_textbook_one(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    assert exact_median(df, "v").first().median == statistics.median(values)


@pytest.mark.parametrize("accuracy", [10, 100])
def test_median_is_exact_with_a_coarse_bracket(spark, accuracy):
    # a third of the rows share one value; the bracket holds a part of the data only
    df = spark.range(30_001).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") * 37 % 30_011).alias("v")
    )
    want = df.agg(F.expr("median(v)")).first()[0]
    assert exact_median(df, "v", accuracy).first().median == want


def test_median_ignores_nulls_and_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,), (4,), (None,)], "v bigint")
    assert exact_median(df, "v").first().median == 4.0
    assert exact_median(df.filter("v = 0"), "v").first().median is None


def test_pages_hold_every_row_once(spark):
    df = spark.range(95).select(F.col("id").cast("string").alias("k"), "id")
    for size in (10, 95, 1000):
        pages = text_pages(df, "k", F.col("k"), F.col("id"), ",", size)
        pages = pages.orderBy("page").collect()
        # The pages joined are the listing in its global order, at any size.
        got = [k for p in pages for k in p.listing.split(",")]
        assert list(map(int, got)) == list(range(95)) and len(pages) == -(-95 // size)
        assert all(len(p.listing.split(",")) == size for p in pages[:-1])


def test_noise_is_decided_by_the_key(spark):
    df = spark.range(2000).select(
        "id", key_noise([F.col("id")], -1.0, 3.0, 1).alias("a"),
        key_noise([F.col("id")], -1.0, 3.0, 2).alias("b"),
    )
    low, high, mean, same = df.agg(
        F.min("a"), F.max("a"), F.avg("a"), F.sum((F.col("a") == F.col("b")).cast("int"))
    ).first()
    assert -1.0 <= low < -0.9 and 2.9 < high < 3.0 and abs(mean - 1.0) < 0.1 and same == 0


def test_ratios_do_not_divide_by_zero(spark):
    assert value(spark, ratio(F.lit(1), F.lit(0))) is None
    assert value(spark, pct(F.lit(1), F.lit(0))) is None
    assert value(spark, pct(F.lit(1), F.lit(8))) == 12.5


def test_clip_keeps_null(spark):
    assert value(spark, floor_zero(F.lit(-3).cast("bigint"))) == 0
    assert value(spark, floor_zero(F.lit(None).cast("bigint"))) is None


def test_date_filters(spark):
    df = daily(spark, range(1, 11))
    days = lambda d: sorted(r.v for r in d.collect())
    assert days(filters.trailing(df, 2)) == [9, 10]
    assert days(filters.trailing(df, 2, inclusive=True)) == [8, 9, 10]
    assert days(filters.leading(df, 8)) == [1, 2]
    assert days(filters.date_between(df, str(day(3)), day(4))) == [3, 4]
    assert days(filters.date_between(df, low=day(9))) == [9, 10]
    earlier = df.filter("v <= 5")
    assert days(filters.trailing(df, 1, anchor=earlier)) == [5, 6, 7, 8, 9, 10]


def test_optional_filters(spark):
    df = daily(spark, [1, 2])
    assert filters.only_values(df, "v", None).count() == 2
    assert filters.only_values(df, "v", [2]).count() == 1
    assert filters.without_series(df, []).count() == 2
    assert filters.without_series(df, ["A"]).count() == 0
    assert filters.select_available(df, ["v", "nope", "date"]).columns == ["v", "date"]


def test_latest_row_and_median_do_not_sort_everything(spark):
    df = spark.range(1000).selectExpr("id % 7 AS k", "id AS t", "double(id) AS v")
    latest = latest_per_key(df, ["k"], "t")
    assert sorted(tuple(r) for r in latest.collect()) == sorted((t % 7, t, float(t)) for t in range(993, 1000))
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Sort [" not in plan
    for n in (1, 2, 999, 1000):
        values = df.limit(n)
        want = values.agg(F.median("v")).first()[0]
        assert exact_median(values, "v", accuracy=20, buckets=5).first().median == want


@pytest.mark.parametrize(
    "values, digits, mean",
    [
        ([1.39, 2.26, 0.85], 0, 2.0),  # 1.5; as doubles 1.4999999999999998
        ([-1.39, -2.26, -0.85], 0, -2.0),
        ([1e300, 1e300, None], 0, 1e300),
        ([float("nan"), 1.0], 0, float("nan")),
        ([None], 0, None),
        ([], 0, None),
    ],
)
def test_a_mean_between_two_results_is_rounded_by_its_exact_value(spark, values, digits, mean):
    df = spark.createDataFrame([(v,) for v in values], "v double").coalesce(1)
    assert repr(df.agg(rounded_mean(F.col("v"), digits).alias("m")).first().m) == repr(mean)
