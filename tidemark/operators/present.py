"""Report tables: what a dashboard over the marts computes, without its UI."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions.aggregates import exact_median, text_pages
from tidemark.functions.filters import (
    latest,
    only_values,
    select_available,
    since_first_end,
    trailing,
)
from tidemark.functions.scalars import thousands, tier_order

PERIODS = {"6 months": 180, "1 year": 365, "all": None}
CHART_COLUMNS = [S.SERIES, S.DATE, "actual", "forecast", "upper_bound", "lower_bound"]
LEADER_COLUMNS = [S.SERIES, "pct_change_30d", "cases_last_30d", "risk_tier"]
PROFILE_COLUMNS = [
    S.SERIES, "total_days", "total_confirmed_cases", "total_deaths",
    "case_fatality_rate_pct", "max_fully_vaccinated_pct",
    "vaccination_start_date", "zero_case_pct",
]


def series_list(df: DataFrame) -> DataFrame:
    """Sorted unique series names."""
    return df.select(S.SERIES).distinct().orderBy(S.SERIES)


def surging_series(features: DataFrame) -> DataFrame:
    """Series whose surge flag is set on the latest day."""
    return features.filter(
        (F.col(S.DATE) == latest(features)) & (F.col("surge_flag") == 1)
    ).select(S.SERIES, S.DATE, "wow_growth_pct")


def surge_alert(features: DataFrame, page_size: int) -> DataFrame:
    """The surging series in one text (in pages, should there be very many)."""
    name = F.col(S.SERIES)
    return text_pages(surging_series(features), S.SERIES, name, name, ", ", page_size)


def chart_period(features: DataFrame, days: int | None = 365) -> DataFrame:
    """History from ``days`` before each series' own last day on; None keeps all."""
    if days is None:
        return features
    ends = features.groupBy(S.SERIES).agg(F.max(S.DATE).alias("_end"))
    return (
        since_first_end(features, days)
        .join(ends, S.SERIES)
        .filter(F.col(S.DATE) >= F.date_sub("_end", days))
        .drop("_end")
    )


def chart_frame(features: DataFrame, output: DataFrame, days: int | None = 365) -> DataFrame:
    """History, one bridge row and the forecast with its bounds, per series.

    The bridge repeats the last actual value in every column, so that the lines
    meet; its day therefore appears twice. Series without a forecast have none.
    """
    empty = F.lit(None).cast("double")
    recent = chart_period(features, days)
    history = recent.select(
        S.SERIES,
        S.DATE,
        F.col("cases_7d_avg").alias("actual"),
        empty.alias("forecast"),
        empty.alias("upper_bound"),
        empty.alias("lower_bound"),
    )
    forecast = output.filter(F.col("is_forecast")).select(
        S.SERIES,
        F.col("ds").alias(S.DATE),
        empty.alias("actual"),
        F.col("forecasted_cases").alias("forecast"),
        F.col("forecast_upper").alias("upper_bound"),
        F.col("forecast_lower").alias("lower_bound"),
    )
    last = F.col("last")
    bridge = (
        recent.groupBy(S.SERIES)
        .agg(F.max(S.DATE).alias(S.DATE), F.max_by("cases_7d_avg", S.DATE).alias("last"))
        .join(forecast.select(S.SERIES), S.SERIES, "left_semi")
        .select(S.SERIES, S.DATE, *[last.alias(c) for c in CHART_COLUMNS[2:]])
    )
    return history.unionByName(bridge).unionByName(forecast)


def series_kpis(features: DataFrame, output: DataFrame, evaluation: DataFrame) -> DataFrame:
    """Headline figures of each series that has a forecast."""
    latest_mean = since_first_end(features).groupBy(S.SERIES).agg(
        F.max_by("cases_7d_avg", S.DATE).alias("latest_7d_avg")
    )
    ahead = output.filter(F.col("is_forecast")).groupBy(S.SERIES).agg(
        F.avg("forecasted_cases").alias("forecast_avg"),
        F.avg("forecast_upper").alias("upper_avg"),
        F.min("ds").alias("forecast_start"),
        F.max("ds").alias("forecast_end"),
    )
    return (
        ahead.join(latest_mean, S.SERIES, "left")
        .join(evaluation.select(S.SERIES, "smape"), S.SERIES, "left")
        .select(
            S.SERIES, "latest_7d_avg", "forecast_avg", "upper_avg", "smape",
            F.date_format("forecast_start", "yyyy-MM-dd").alias("forecast_start"),
            F.date_format("forecast_end", "yyyy-MM-dd").alias("forecast_end"),
        )
    )


def kpi_text(kpis: DataFrame) -> DataFrame:
    """The headline figures as display text."""
    return kpis.select(
        S.SERIES,
        thousands(F.col("latest_7d_avg")).alias("latest_7d_avg"),
        thousands(F.col("forecast_avg")).alias("forecast_avg"),
        thousands(F.col("upper_avg")).alias("upper_avg"),
        F.concat(thousands(F.col("smape"), 1), F.lit("%")).alias("smape"),
    )


def stats_by_tier(stats: DataFrame) -> DataFrame:
    """Most severe tier first, then by name."""
    return stats.withColumn("tier_order", tier_order(F.col("risk_tier"))).orderBy(
        "tier_order", S.SERIES
    )


def leaderboard(stats: DataFrame, n: int = 5, worst: bool = True) -> DataFrame:
    """The ``n`` series rising fastest, or falling fastest."""
    change = F.desc("pct_change_30d") if worst else F.asc("pct_change_30d")
    return stats.orderBy(change, S.SERIES).limit(n).select(*LEADER_COLUMNS)


def compare_pivot(features: DataFrame, names: Sequence[str], days: int = 180) -> DataFrame:
    """Smoothed cases of chosen series side by side, one row per day.

    The day range ends at the last day of the chosen series. Naming the series
    makes the pivot one aggregation without a pass to discover its columns.
    """
    chosen = only_values(features, S.SERIES, names)
    return (
        trailing(chosen, days, inclusive=True)
        .groupBy(S.DATE)
        .pivot(S.SERIES, list(names))
        .agg(F.avg("cases_7d_avg"))
    )


def situation_matrix(stats: DataFrame) -> DataFrame:
    """Three flags per series, which may overlap or all be false.

    Cases are split at their median over all series.
    """
    median = exact_median(stats, "cases_last_30d").scalar()
    cases, change = F.col("cases_last_30d"), F.col("pct_change_30d")
    return stats.select(
        S.SERIES,
        "cases_last_30d",
        "pct_change_30d",
        ((cases > median) & (change < 0)).alias("high_declining"),
        ((cases <= median) & (change > 10)).alias("low_rising"),
        (F.abs(change) <= 5).alias("stable"),
    )


def top_importance(importance: DataFrame, k: int = 7) -> DataFrame:
    return importance.filter(F.col("rank") <= k)


def profile_headline(profile: DataFrame) -> DataFrame:
    return profile.agg(
        F.count("*").alias("series_count"),
        F.min("series_start").alias("first_day"),
        F.max("series_end").alias("last_day"),
        F.floor(F.avg("total_days")).alias("mean_days"),
    )


def profile_table(profile: DataFrame) -> DataFrame:
    """The displayed profile columns, as far as they exist."""
    return select_available(profile, PROFILE_COLUMNS)


def tier_filtered(texts: DataFrame, tiers: Sequence[str] | None = None) -> DataFrame:
    """Texts of the chosen tiers, most severe first; None means all."""
    return only_values(texts, "risk_tier", tiers).orderBy(
        tier_order(F.col("risk_tier")), S.SERIES
    )


def series_history(features: DataFrame, name: str) -> DataFrame:
    return features.filter(F.col(S.SERIES) == name).orderBy(S.DATE)


def series_forecast(output: DataFrame, name: str) -> DataFrame:
    return output.filter((F.col(S.SERIES) == name) & F.col("is_forecast")).orderBy("ds")


def series_importance(importance: DataFrame, name: str) -> DataFrame:
    return importance.filter(F.col("series") == name).orderBy("rank")


def series_explanation(explanations: DataFrame, name: str) -> DataFrame:
    return explanations.filter(F.col(S.SERIES) == name)
