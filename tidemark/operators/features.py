"""Features of a gap-free daily panel.

All windows share one partitioning (the series) and one ordering (the day).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions.scalars import change_pct, doubling_days, pct
from tidemark.functions.windows import lagged, per_series, rolling_mean

# output column -> (input column, days, digits)
ROLLING = {
    "cases_7d_avg": ("new_cases", 7, 2),
    "cases_14d_avg": ("new_cases", 14, 2),
    "deaths_7d_avg": ("new_deaths", 7, 2),
    "vacc_7d_avg": ("daily_vaccinations", 7, 0),
}
COVERAGE = "people_fully_vaccinated_per_hundred"
SURGE_THRESHOLD = 50
#: Days before a row that its features depend on, carried values apart: coverage 28 days before, or 21 and then 7.
LOOK_BACK = 28


def surge(growth: Column, threshold: float = SURGE_THRESHOLD) -> Column:
    """1 where growth exceeds the threshold, else 0 (also where it is unknown)."""
    return F.when(growth > threshold, 1).otherwise(0)


def impact(mean: Column, mean_before: Column, rate: Column, rate_before: Column) -> Column:
    """Weekly growth in percent less the weekly gain in lagged coverage."""
    growth = (mean - mean_before) / mean_before * 100
    gain = rate - F.coalesce(rate_before, F.lit(0.0))
    return F.when((rate > 0) & (mean_before > 0), F.round(growth - gain, 2))


def rolling_means(
    df: DataFrame,
    spec: Mapping[str, tuple[str, int, int | None]] = ROLLING,
    *,
    series: str = S.SERIES,
    date: str = S.DATE,
) -> DataFrame:
    """Add rolling means: output name -> (column, days, digits or None)."""
    w = per_series(series, date)
    return df.withColumns({
        out: rolling_mean(w, column, days, digits) for out, (column, days, digits) in spec.items()
    })


def doubling_time(
    df: DataFrame,
    level: str = "cumulative_cases",
    days: int = 7,
    out: str = "doubling_time_days",
    *,
    series: str = S.SERIES,
    date: str = S.DATE,
) -> DataFrame:
    w = per_series(series, date)
    return (
        df.withColumn("_earlier", lagged(w, level, days))
        .withColumn(out, doubling_days(F.col(level), F.col("_earlier"), days))
        .drop("_earlier")
    )


def wow_growth(
    df: DataFrame,
    mean: str = "cases_7d_avg",
    days: int = 7,
    *,
    series: str = S.SERIES,
    date: str = S.DATE,
) -> DataFrame:
    """Change of a rolled mean against ``days`` earlier, absolute and in percent."""
    w = per_series(series, date)
    return (
        df.withColumn("_before", lagged(w, mean, days))
        .withColumns({
            "wow_change_7d_avg": F.col(mean) - F.col("_before"),
            "wow_growth_pct": change_pct(F.col(mean), F.col("_before")),
        })
        .drop("_before")
    )


def rate_lags(
    df: DataFrame,
    rate: str = COVERAGE,
    lags: Sequence[int] = (14, 21, 28),
    prefix: str = "vacc_rate_lag",
    *,
    series: str = S.SERIES,
    date: str = S.DATE,
) -> DataFrame:
    w = per_series(series, date)
    return df.withColumns({f"{prefix}_{k}d": lagged(w, rate, k) for k in lags})


def case_death_ratio(
    df: DataFrame,
    deaths: str = "deaths_7d_avg",
    cases: str = "cases_7d_avg",
    lag: int = 14,
    *,
    series: str = S.SERIES,
    date: str = S.DATE,
) -> DataFrame:
    """Rolled deaths in percent of rolled cases ``lag`` days earlier."""
    w = per_series(series, date)
    return (
        df.withColumn("_cases", lagged(w, cases, lag))
        .withColumn("case_death_ratio", pct(F.col(deaths), F.col("_cases")))
        .drop("_cases")
    )


def surge_flag(
    df: DataFrame, growth: str = "wow_growth_pct", threshold: float = SURGE_THRESHOLD
) -> DataFrame:
    return df.withColumn("surge_flag", surge(F.col(growth), threshold))


def vacc_impact_proxy(
    df: DataFrame,
    mean: str = "cases_7d_avg",
    rate: str = "vacc_rate_lag_21d",
    days: int = 7,
    *,
    series: str = S.SERIES,
    date: str = S.DATE,
) -> DataFrame:
    w = per_series(series, date)
    return (
        df.withColumns({"_mean": lagged(w, mean, days), "_rate": lagged(w, rate, days)})
        .withColumn(
            "vacc_impact_proxy",
            impact(F.col(mean), F.col("_mean"), F.col(rate), F.col("_rate")),
        )
        .drop("_mean", "_rate")
    )


def _recovery(mode: str, mean: Column, cases_mean: Column, today: Column) -> Column:
    guard = today if mode == "daily" else mean
    return F.when((cases_mean > 0) & (guard > 0), pct(mean, cases_mean))


def _recovered_digits(mode: str) -> int | None:
    if mode not in ("smoothed", "daily"):
        raise ValueError("recovery mode is 'smoothed' or 'daily'")
    return 2 if mode == "smoothed" else None


def recovery_rate(
    df: DataFrame,
    mode: str = "smoothed",
    recovered: str = "new_recovered",
    mean: str = "cases_7d_avg",
    *,
    series: str = S.SERIES,
    date: str = S.DATE,
) -> DataFrame:
    """Rolled recoveries in percent of rolled cases.

    ``smoothed`` uses the rounded weekly mean and needs it to be positive;
    ``daily`` uses the unrounded mean and needs a recovery on the day itself.
    """
    w = per_series(series, date)
    return (
        df.withColumn("_recovered", rolling_mean(w, recovered, 7, _recovered_digits(mode)))
        .withColumn(
            "recovery_rate",
            _recovery(mode, F.col("_recovered"), F.col(mean), F.col(recovered)),
        )
        .drop("_recovered")
    )


def features(
    df: DataFrame,
    *,
    recovery_mode: str = "smoothed",
    surge_threshold: float = SURGE_THRESHOLD,
    series: str = S.SERIES,
    date: str = S.DATE,
    within: Sequence[str] = (),
) -> DataFrame:
    """The full feature table, in two window stages.

    Rolled means and lags of raw columns come first, lags of those second.
    Every lag is computed once and used by name. ``within`` are columns that
    divide a series further; they come last in the result.
    """
    w = per_series(series, date, *within)
    first = df.withColumns({
        **{out: rolling_mean(w, c, days, digits) for out, (c, days, digits) in ROLLING.items()},
        "_level": lagged(w, "cumulative_cases", 7),
        **{f"vacc_rate_lag_{k}d": lagged(w, COVERAGE, k) for k in (14, 21, 28)},
        "_recovered": rolling_mean(w, "new_recovered", 7, _recovered_digits(recovery_mode)),
    })
    second = first.withColumns({
        "_mean_7": lagged(w, "cases_7d_avg", 7),
        "_mean_14": lagged(w, "cases_7d_avg", 14),
        "_rate": lagged(w, "vacc_rate_lag_21d", 7),
    })
    c = F.col
    growth = change_pct(c("cases_7d_avg"), c("_mean_7"))
    out = second.withColumns({
        "doubling_time_days": doubling_days(c("cumulative_cases"), c("_level"), 7),
        "wow_change_7d_avg": c("cases_7d_avg") - c("_mean_7"),
        "wow_growth_pct": growth,
        "case_death_ratio": pct(c("deaths_7d_avg"), c("_mean_14")),
        "surge_flag": surge(growth, surge_threshold),
        "vacc_impact_proxy": impact(
            c("cases_7d_avg"), c("_mean_7"), c("vacc_rate_lag_21d"), c("_rate")
        ),
        "recovery_rate": _recovery(
            recovery_mode, c("_recovered"), c("cases_7d_avg"), c("new_recovered")
        ),
    })
    names = {S.SERIES: series, S.DATE: date}
    return out.select(*[names.get(n, n) for n in S.FEATURE_COLUMNS], *within)
