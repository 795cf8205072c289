import pytest
from conftest import column, day
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions.scalars import tier, tier_order
from tidemark.operators import risk

STATS = (
    "country_region string, pct_change_30d double, risk_tier string, "
    "cases_last_30d bigint, deaths_last_30d bigint"
)


def phrase(spark, v):
    return spark.range(1).select(risk.trend_phrase(F.lit(v)).alias("p")).first().p


@pytest.mark.parametrize(
    "change, name",
    [(20.0, "MODERATE"), (20.01, "HIGH"), (5.0, "LOW"), (5.01, "MODERATE"), (0.0, "LOW")],
)
def test_tier_bounds_are_strict(spark, change, name):
    assert spark.range(1).select(tier(F.lit(change)).alias("t")).first().t == name


@pytest.mark.parametrize(
    "change, words",
    [
        (20.01, "climbing fast, by 20.01%"), (20.0, "climbing, by 20.00%"),
        (5.0, "stable"), (-4.99, "stable"), (-5.0, "easing, by 5.00%"),
        (-20.0, "falling fast, by 20.00%"),
    ],
)
def test_trend_phrase(spark, change, words):
    assert phrase(spark, change).startswith(words)


def features(spark, values, series="A"):
    rows = [
        (series, day(i), v, 1, float(v), 40.0) for i, v in enumerate(values, start=1)
    ]
    return spark.createDataFrame(
        rows,
        "country_region string, date date, new_cases bigint, new_deaths bigint, "
        "cases_7d_avg double, people_fully_vaccinated_per_hundred double",
    )


def test_periods_are_thirty_days_each_without_overlap(spark):
    # days 1..70: the last 30 are 41..70, the 30 before 11..40
    f = features(spark, [1000] * 10 + [1] * 30 + [2] * 30)
    r = risk.period_stats(f).first()
    assert (r.cases_last_30d, r.cases_prev_30d, r.deaths_last_30d) == (60, 30, 30)
    assert (r.latest_7d_avg_cases, r.vacc_coverage_pct) == (2.0, 40.0)


def test_excluded_series_are_left_out(spark):
    f = features(spark, [1]).union(features(spark, [1], "Turkey"))
    assert column(risk.period_stats(f), S.SERIES, S.SERIES) == ["A"]
    assert risk.period_stats(f, exclude=()).count() == 2


def test_empty_previous_window_gives_change_0_and_low(spark):
    f = features(spark, [0] * 30 + [5] * 30)
    none = spark.createDataFrame([], S.OUTPUT_SCHEMA)
    scores = spark.createDataFrame([], "country_region string, smape double, wmape double")
    r = risk.country_stats(f, none, scores).first()
    assert (r.pct_change_30d, r.risk_tier, r.forecast_30d_cases, r.avg_mape) == (0.0, "LOW", 0, 0)


def stats(spark):
    return spark.createDataFrame(
        [("A", 12.3, "MODERATE", 12345678, 1), ("B", 30.0, "HIGH", 5, 2),
         ("C", -7.0, "LOW", 0, 0)],
        STATS,
    )


def test_rollup_lists_by_falling_trend(spark):
    r = risk.global_rollup(stats(spark), 100).collect()
    assert len(r) == 1
    assert r[0].all_countries_summary == (
        "B: HIGH, change 30.00%, cases 5; A: MODERATE, change 12.30%, cases 12345678; "
        "C: LOW, change -7.00%, cases 0"
    )
    assert (r[0].high_risk_count, r[0].moderate_risk_count, r[0].low_risk_count) == (1, 1, 1)
    assert (r[0].global_cases_30d, r[0].global_deaths_30d, r[0].series_count) == (12345683, 3, 3)


def test_large_rollups_are_paged_without_loss(spark):
    n = 500
    many = spark.range(n).select(
        F.concat(F.lit("S"), "id").alias("country_region"),
        (F.col("id") % 40 - 20).cast("double").alias("pct_change_30d"),
        F.lit("LOW").alias("risk_tier"),
        F.col("id").alias("cases_last_30d"),
        F.lit(1).cast("bigint").alias("deaths_last_30d"),
    )
    pages = risk.global_rollup(many, page_size=20).orderBy("page").collect()
    assert len(pages) == 25
    items = [i for p in pages for i in p.all_countries_summary.split("; ")]
    assert len(items) == len(set(items)) == n
    assert {p.low_risk_count for p in pages} == {n}
    trends = [float(i.split("change ")[1].split("%")[0]) for i in items]
    assert trends == sorted(trends, reverse=True)
    (none,) = risk.global_rollup(many.limit(0), page_size=20).collect()
    assert (none.page, none.all_countries_summary, none.series_count) == (0, None, 0)


def test_tier_order(spark):
    df = spark.createDataFrame([(t,) for t in ("LOW", "HIGH", "?", "MODERATE")], "t string")
    assert [r.t for r in df.orderBy(tier_order(F.col("t"))).collect()] == [
        "HIGH", "MODERATE", "LOW", "?",
    ]


def test_feature_text_keeps_five_ranks_and_strips_quotes(spark):
    rows = [('"A B"', i, f"f{i}", 1 / i) for i in range(7, 0, -1)]
    out = risk.top_feature_text(spark.createDataFrame(rows, S.IMPORTANCE_SCHEMA)).first()
    assert out.country_region == "A B"
    lines = out.feature_list.split("\n")
    assert len(lines) == 5 and lines[2] == "3. f3, weight 0.333"
