"""Profiling and data-quality checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions.aggregates import count_where
from tidemark.functions.filters import as_date, date_between
from tidemark.functions.scalars import ratio


def at(long: DataFrame, day: str | Column, case_type: str) -> DataFrame:
    """Rows of one day and category."""
    return long.filter((F.col(S.DATE) == as_date(day)) & (F.col("case_type") == case_type))


def spot_check_series(
    long: DataFrame, name: str, low: str, high: str, sub_region: str | None = None
) -> DataFrame:
    """Cumulative next to daily values of one series and window.

    With no ``sub_region`` only rows that have none are shown.
    """
    rows = date_between(long.filter(F.col(S.SERIES) == name), low, high)
    region = F.col("province_state")
    rows = rows.filter(region.isNull() if sub_region is None else region == sub_region)
    return rows.select(S.DATE, "case_type", "cumulative_value", "daily_value")


def top_subregions(
    long: DataFrame, name: str, day: str | Column, case_type: str, n: int = 15
) -> DataFrame:
    """Largest sub-regions of a series on one day, by cumulative value."""
    return (
        at(long, day, case_type)
        .filter(F.col(S.SERIES) == name)
        .select(S.DATE, "case_type", "province_state", "cumulative_value", "daily_value")
        .orderBy(F.desc("cumulative_value"), "province_state")
        .limit(n)
    )


def granularity_audit(
    long: DataFrame, day: str | Column, case_type: str, names: Sequence[str] | None = None
) -> DataFrame:
    """Sub-regions per series on one day, and rows without one."""
    rows = at(long, day, case_type)
    if names is not None:
        rows = rows.filter(F.col(S.SERIES).isin(list(names)))
    return rows.groupBy(S.SERIES).agg(
        F.count_distinct("province_state").alias("num_provinces"),
        count_where(F.col("province_state").isNull()).alias("null_province_rows"),
        F.count("*").alias("total_rows"),
    )


def name_reconcile(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Which of the wanted names appear in a source."""
    return df.filter(F.col(S.SERIES).isin(list(names))).select(S.SERIES).distinct()


def coverage_audit(vacc: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Date range and non-NULL measures of the second source, per series."""
    rows = vacc if names is None else vacc.filter(F.col(S.SERIES).isin(list(names)))
    rate = "people_fully_vaccinated_per_hundred"
    return rows.groupBy(S.SERIES).agg(
        F.min(S.DATE).alias("first_vacc_date"),
        F.max(S.DATE).alias("last_vacc_date"),
        F.count("*").alias("total_rows"),
        F.count("daily_vaccinations").alias("has_daily_vacc"),
        F.count(rate).alias("has_fully_vaxxed_pct"),
        F.max(rate).alias("max_fully_vaxxed_pct"),
    )


def distinct_values(df: DataFrame, column: str = "case_type") -> DataFrame:
    return df.select(column).distinct()


def date_range(df: DataFrame, date: str = S.DATE) -> DataFrame:
    return df.agg(F.min(date).alias("earliest"), F.max(date).alias("latest"))


def row_leaderboard(df: DataFrame, n: int = 30, key: str = S.SERIES) -> DataFrame:
    """Keys with the most rows; ties in key order."""
    return (
        df.groupBy(key)
        .agg(F.count("*").alias("row_count"))
        .orderBy(F.desc("row_count"), key)
        .limit(n)
    )


def series_audit(df: DataFrame, key: str = S.SERIES, date: str = S.DATE) -> DataFrame:
    """Rows, span and distinct days per series.

    ``total_rows`` above ``unique_dates`` means duplicate days.
    """
    return df.groupBy(key).agg(
        F.count("*").alias("total_rows"),
        F.min(date).alias("start_date"),
        F.max(date).alias("end_date"),
    ).join(distinct_days(df, key, date), key)


def distinct_days(df: DataFrame, key: str = S.SERIES, date: str = S.DATE, name: str = "unique_dates") -> DataFrame:
    """(key, name): how many different days each key has; nulls are none.

    A day's number is a bit of a map, and maps are joined bit by bit before the
    shuffle as well as after it. So a task sends one map per key and some 90
    years, however many rows it has, where counting distinct pairs sends them all.
    """
    number = F.datediff(date, F.lit("0001-01-01").cast("date"))
    bits = df.select(key, F.bitmap_bucket_number(number).alias("_span"), F.bitmap_bit_position(number).alias("_bit"))
    maps = bits.where("_bit IS NOT NULL").groupBy(key, "_span").agg(F.bitmap_construct_agg("_bit").alias("_map"))
    # A key without any day still has its row.
    none = df.select(key).groupBy(key).agg(F.lit(0).cast("bigint").alias("_n"))
    counts = maps.select(key, F.bitmap_count("_map").alias("_n")).unionByName(none)
    return counts.groupBy(key).agg(F.sum("_n").alias(name))


def panel_summary(panel: DataFrame) -> DataFrame:
    """Days, span and totals of each series of the daily panel."""
    return panel.groupBy(S.SERIES).agg(
        F.count("*").alias("total_days"),
        F.min(S.DATE).alias("first_date"),
        F.max(S.DATE).alias("last_date"),
        F.sum("new_cases").alias("total_new_cases"),
        F.sum("new_deaths").alias("total_new_deaths"),
        F.count("daily_vaccinations").alias("vacc_data_days"),
    )


def null_audit(df: DataFrame, columns: Sequence[str], key: str = S.SERIES) -> DataFrame:
    """Rows, series and the NULL count of each column, in one pass."""
    return df.agg(
        F.count("*").alias("total_rows"),
        F.count_distinct(key).alias("series_count"),
        *[count_where(F.col(c).isNull()).alias(f"null_{c}") for c in columns],
    )


def key_map_coverage(
    long: DataFrame, key_map: DataFrame, day: str | Column, case_type: str
) -> DataFrame:
    """Staged rows of every mapped series on one day; 0 where there are none.

    Rows are counted before the join, so the join sees one row per series.
    """
    counts = at(long, day, case_type).groupBy(S.SERIES).agg(F.count("*").alias("n"))
    names = key_map.select("source_name")
    return names.join(counts, names["source_name"] == counts[S.SERIES], "left").select(
        "source_name", F.coalesce("n", F.lit(0)).alias("stg_rows")
    )


def data_profile(panel: DataFrame) -> DataFrame:
    """Per-series profile: span, totals, peaks, rates and zero-case days.

    All figures combine on the map side to one row per series, distinct days as
    bitmaps.
    """
    c = F.col
    days = distinct_days(panel, name="total_days")
    cases, deaths = F.max("cumulative_cases"), F.max("cumulative_deaths")
    recovered = F.max("cumulative_recovered")
    zero_days = count_where(c("new_cases") == 0)
    figures = panel.groupBy(S.SERIES).agg(
        F.min(S.DATE).alias("series_start"),
        F.max(S.DATE).alias("series_end"),
        cases.alias("total_confirmed_cases"),
        F.round(F.avg("new_cases"), 2).alias("avg_daily_cases"),
        F.max("new_cases").alias("peak_daily_cases"),
        deaths.alias("total_deaths"),
        F.round(F.avg("new_deaths"), 2).alias("avg_daily_deaths"),
        F.max("new_deaths").alias("peak_daily_deaths"),
        F.round(ratio(deaths, cases) * 100, 2).alias("case_fatality_rate_pct"),
        recovered.alias("total_recovered"),
        F.round(ratio(recovered, cases) * 100, 2).alias("recovery_rate_pct"),
        F.max(F.when(c("new_recovered") > 0, c(S.DATE))).alias("last_recovered_date"),
        F.max("total_vaccinations").alias("total_vaccinations"),
        F.max("people_fully_vaccinated_per_hundred").alias("max_fully_vaccinated_pct"),
        F.round(F.avg("daily_vaccinations"), 0).alias("avg_daily_vaccinations"),
        F.max("daily_vaccinations").alias("peak_daily_vaccinations"),
        F.min(F.when(c("total_vaccinations") > 0, c(S.DATE))).alias("vaccination_start_date"),
        F.count("daily_vaccinations").alias("vacc_data_days"),
        zero_days.alias("zero_case_days"),
        F.round(ratio(zero_days, F.count("*")) * 100, 2).alias("zero_case_pct"),
    )
    return days.join(figures, S.SERIES)


def feature_spot_check(
    features: DataFrame,
    name: str,
    low: str,
    high: str | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Chosen feature columns of one series and window."""
    rows = date_between(features.filter(F.col(S.SERIES) == name), low, high)
    return rows if columns is None else rows.select(*columns)


def forecast_day_counts(output: DataFrame) -> DataFrame:
    """History and forecast days of each series."""
    return output.groupBy(S.SERIES).agg(
        count_where(~F.col("is_forecast")).alias("historical_days"),
        count_where(F.col("is_forecast")).alias("forecast_days"),
        F.min("ds").alias("start_date"),
        F.max("ds").alias("end_date"),
    )


def forecast_error_summary(output: DataFrame) -> DataFrame:
    """Rows, mean error column and span of each series."""
    return output.groupBy(S.SERIES).agg(
        F.count("*").alias("row_count"),
        F.avg("mape").alias("avg_mape"),
        F.min("ds").alias("min_date"),
        F.max("ds").alias("max_date"),
    )
