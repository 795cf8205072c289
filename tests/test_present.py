import datetime as dt

import pytest
from conftest import daily, day
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators import present

STATS = (
    "country_region string, cases_last_30d bigint, pct_change_30d double, risk_tier string"
)


def stats(spark):
    return spark.createDataFrame(
        [("A", 10, 12.0, "MODERATE"), ("B", 20, 3.0, "LOW"), ("C", 30, -2.0, "LOW"),
         ("D", 40, -30.0, "LOW")],
        STATS,
    )


def output(spark, series, start, values):
    rows = [
        (series, day(start + i), None, None, float(v), v - 1.0, v + 1.0, 5.0, True)
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, S.OUTPUT_SCHEMA)


def test_situation_classes_overlap(spark):
    rows = {r.country_region: r for r in present.situation_matrix(stats(spark)).collect()}
    pick = lambda flag: sorted(k for k, r in rows.items() if r[flag])
    assert pick("low_rising") == ["A"]
    assert pick("stable") == ["B", "C"]
    assert pick("high_declining") == ["C", "D"]


def test_leaderboards_break_ties_by_name(spark):
    tied = stats(spark).unionByName(
        spark.createDataFrame([("AA", 1, 12.0, "MODERATE")], STATS)
    )
    worst = [r.country_region for r in present.leaderboard(tied, 3).collect()]
    best = [r.country_region for r in present.leaderboard(tied, 2, worst=False).collect()]
    assert (worst, best) == (["A", "AA", "B"], ["D", "C"])


def test_chart_repeats_the_last_day_as_a_bridge(spark):
    f = daily(spark, [1.0, 2.0, 3.0], "cases_7d_avg", kind="double").union(
        daily(spark, [9.0], "cases_7d_avg", series="B", kind="double")
    )
    frame = present.chart_frame(f, output(spark, "A", 4, [5, 6]), days=1)
    rows = [tuple(r)[1:] for r in frame.filter("country_region = 'A'").orderBy(
        "date", F.col("forecast").isNotNull()).collect()]
    assert rows == [
        (day(2), 2.0, None, None, None),
        (day(3), 3.0, None, None, None),
        (day(3), 3.0, 3.0, 3.0, 3.0),
        (day(4), None, 5.0, 6.0, 4.0),
        (day(5), None, 6.0, 7.0, 5.0),
    ]
    # no forecast, no bridge
    assert frame.filter("country_region = 'B'").count() == 1


@pytest.mark.parametrize("days, rows", [(0, 1), (2, 3), (None, 5)])
def test_chart_period_counts_back_from_each_series_own_end(spark, days, rows):
    f = daily(spark, [1.0] * 5, "cases_7d_avg", kind="double")
    late = f.withColumns({S.SERIES: F.lit("B"), S.DATE: F.date_add(S.DATE, 100)})
    out = present.chart_period(f.union(late), days).groupBy(S.SERIES).count()
    assert {r["count"] for r in out.collect()} == {rows}


def test_kpis(spark):
    f = daily(spark, [1.0, 1234.5], "cases_7d_avg", kind="double")
    scores = spark.createDataFrame([("A", 3.14)], "country_region string, smape double")
    k = present.series_kpis(f, output(spark, "A", 3, [10, 20]), scores)
    r = k.first()
    assert (r.latest_7d_avg, r.forecast_avg, r.upper_avg, r.smape) == (1234.5, 15.0, 16.0, 3.14)
    assert (r.forecast_start, r.forecast_end) == ("2021-01-03", "2021-01-04")
    t = present.kpi_text(k).first()
    assert (t.latest_7d_avg, t.forecast_avg, t.smape) == ("1,234", "15", "3.1%")


def test_surge_looks_at_the_latest_day_only(spark):
    f = daily(spark, [1, 0], "surge_flag").union(daily(spark, [0, 1], "surge_flag", "B")).union(
        daily(spark, [0, 1], "surge_flag", "C")
    ).withColumn("wow_growth_pct", F.lit(60.0))
    assert [r.listing for r in present.surge_alert(f, 10).collect()] == ["B, C"]
    assert present.surge_alert(f.withColumn("surge_flag", F.lit(0)), 10).count() == 0


def test_compare_pivot_has_one_column_per_series(spark):
    f = daily(spark, [1.0, 2.0], "cases_7d_avg", kind="double").union(
        daily(spark, [3.0], "cases_7d_avg", "B", "double")
    )
    out = present.compare_pivot(f, ["A", "B"]).orderBy("date").collect()
    assert [tuple(r) for r in out] == [(day(1), 1.0, 3.0), (day(2), 2.0, None)]


def test_tier_filter_and_order(spark):
    names = lambda df: [r.country_region for r in df.collect()]
    assert names(present.tier_filtered(stats(spark))) == ["A", "B", "C", "D"]
    assert names(present.tier_filtered(stats(spark), ["LOW"])) == ["B", "C", "D"]
    assert names(present.stats_by_tier(stats(spark)))[0] == "A"


def test_profile_table_shows_the_columns_that_exist(spark):
    df = spark.createDataFrame([("A", 3, 1)], "country_region string, total_days bigint, x int")
    assert present.profile_table(df).columns == ["country_region", "total_days"]


def test_profile_headline(spark):
    d = dt.date
    df = spark.createDataFrame(
        [("A", 3, d(2020, 1, 2), d(2020, 3, 1)), ("B", 6, d(2020, 1, 1), d(2020, 2, 1))],
        "country_region string, total_days bigint, series_start date, series_end date",
    )
    assert tuple(present.profile_headline(df).first()) == (2, d(2020, 1, 1), d(2020, 3, 1), 4)


def test_series_detail_is_sorted(pipeline):
    days = [r.date for r in present.series_history(pipeline.features, "NATION_3").collect()]
    assert days == sorted(days) and len(days) > 2000
    ranks = present.series_importance(pipeline.correlations, "NATION_3").collect()
    assert [r["rank"] for r in ranks] == [1, 2, 3, 4, 5, 6]
    assert present.series_forecast(pipeline.output, "NATION_3").count() == 30
    assert present.series_explanation(pipeline.explanations, "NATION_3").count() == 1
