import pytest
from conftest import column, daily
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions.scalars import change_pct, doubling_days
from tidemark.operators import features as Fe


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first().v


def test_partial_frame_at_the_head(spark):
    df = daily(spark, [7, 14], "new_cases")
    out = Fe.rolling_means(df, {"m": ("new_cases", 7, 2)})
    assert column(out, "m") == [7.0, 10.5]


def test_rolling_window_is_seven_rows(spark):
    df = daily(spark, [70] + [0] * 7, "new_cases")
    assert column(Fe.rolling_means(df, {"m": ("new_cases", 7, 2)}), "m")[6:] == [10.0, 0.0]


@pytest.mark.parametrize(
    "level, earlier, days", [(200, 100, 7.0), (150, 100, 11.97), (100, 100, None), (5, 0, None)]
)
def test_doubling_days(spark, level, earlier, days):
    assert one(spark, doubling_days(F.lit(level), F.lit(earlier), 7)) == days


def test_doubling_time_of_a_series(spark):
    df = daily(spark, [100] * 7 + [200], "cumulative_cases")
    assert column(Fe.doubling_time(df), "doubling_time_days") == [None] * 7 + [7.0]


@pytest.mark.parametrize("now, growth, flag", [(15.0, 50.0, 0), (15.01, 50.1, 1), (9.0, -10.0, 0)])
def test_surge_is_strictly_above_the_threshold(spark, now, growth, flag):
    got = change_pct(F.lit(now), F.lit(10.0))
    assert one(spark, got) == growth
    assert one(spark, Fe.surge(got)) == flag


def test_unknown_growth_is_no_surge(spark):
    df = daily(spark, [1.0, 2.0], "cases_7d_avg", kind="double")
    out = Fe.surge_flag(Fe.wow_growth(df))
    assert column(out, "wow_growth_pct") == [None, None]
    assert column(out, "surge_flag") == [0, 0]


def test_growth_uses_the_rounded_means(spark):
    df = daily(spark, [1, 0, 0, 0, 0, 0, 0, 1, 1], "new_cases")
    means = Fe.rolling_means(df, {"cases_7d_avg": ("new_cases", 7, 2)})
    out = Fe.wow_growth(means)
    # day 9: mean 0.29 (2/7), a week before 0.5
    assert column(out, "wow_change_7d_avg")[-1] == pytest.approx(0.29 - 0.5)
    assert column(out, "wow_growth_pct")[-1] == -42.0


def test_recovery_modes(spark):
    df = (
        daily(spark, [7, 0], "new_recovered")
        .withColumn("cases_7d_avg", F.lit(10.0))
    )
    assert column(Fe.recovery_rate(df), "recovery_rate") == [70.0, 35.0]
    assert column(Fe.recovery_rate(df, "daily"), "recovery_rate") == [70.0, None]
    with pytest.raises(ValueError):
        Fe.recovery_rate(df, "weekly")


def test_impact_subtracts_the_gain_in_coverage(spark):
    v = Fe.impact(F.lit(12.0), F.lit(10.0), F.lit(30.0), F.lit(25.5))
    assert one(spark, v) == 15.5
    no_earlier = Fe.impact(F.lit(12.0), F.lit(10.0), F.lit(30.0), F.lit(None).cast("double"))
    assert one(spark, no_earlier) == -10.0
    assert one(spark, Fe.impact(F.lit(12.0), F.lit(10.0), F.lit(0.0), F.lit(0.0))) is None


def test_rate_lags(spark):
    df = daily(spark, [float(i) for i in range(30)], Fe.COVERAGE, kind="double")
    out = Fe.rate_lags(df)
    assert column(out, "vacc_rate_lag_14d")[13:15] == [None, 0.0]
    assert column(out, "vacc_rate_lag_28d")[-1] == 1.0


def test_feature_table_has_the_23_columns_in_order(pipeline):
    assert pipeline.features.columns == S.FEATURE_COLUMNS and len(S.FEATURE_COLUMNS) == 23


def test_single_operators_agree_with_the_full_table(pipeline):
    rolled = Fe.rolling_means(pipeline.filled)
    step = Fe.rate_lags(Fe.doubling_time(rolled))
    step = Fe.surge_flag(Fe.wow_growth(step))
    step = Fe.vacc_impact_proxy(Fe.case_death_ratio(Fe.recovery_rate(step)))
    got = step.select(S.FEATURE_COLUMNS)
    assert got.exceptAll(pipeline.features).count() == 0


def test_result_does_not_depend_on_partitioning(spark, pipeline):
    again = Fe.features(pipeline.filled.repartition(3, "date"))
    assert again.exceptAll(pipeline.features).count() == 0


def test_recovery_is_the_only_column_the_modes_change(pipeline):
    other = Fe.features(pipeline.filled, recovery_mode="daily").drop("recovery_rate")
    assert other.exceptAll(pipeline.features.drop("recovery_rate")).count() == 0


def test_keys_and_dates_may_have_other_names(spark):
    df = daily(spark, [1, 2, 3], "new_cases").toDF("city", "day", "new_cases")
    out = Fe.rolling_means(df, {"m": ("new_cases", 2, 2)}, series="city", date="day")
    assert [r.m for r in out.orderBy("day").collect()] == [1.0, 1.5, 2.5]
