"""From long event rows to a gap-free daily panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions.aggregates import conditional_sum
from tidemark.functions.scalars import floor_zero
from tidemark.functions.windows import last_known, per_series

MEASURES = {"cases": "Confirmed", "deaths": "Deaths", "recovered": "Recovered"}


def pivot_daily(long: DataFrame) -> DataFrame:
    """One row per (series, day): daily and cumulative sums of each category.

    A single pass with conditional sums. Partial aggregation runs before the
    shuffle, so a series holding a large share of all rows still sends at most
    one row per task and day.
    """
    is_type = {name: F.col("case_type") == value for name, value in MEASURES.items()}
    return long.groupBy(S.SERIES, S.DATE).agg(
        *[conditional_sum("daily_value", c).alias(f"new_{m}") for m, c in is_type.items()],
        *[conditional_sum("cumulative_value", c).alias(f"cumulative_{m}") for m, c in is_type.items()],
    )


def clip_corrections(daily: DataFrame) -> DataFrame:
    """Daily counts below 0 (retroactive corrections) become 0; levels stay."""
    return daily.withColumns({f"new_{m}": floor_zero(F.col(f"new_{m}")) for m in MEASURES})


def daily_panel(long: DataFrame, vacc: DataFrame, key_map: DataFrame) -> DataFrame:
    """Daily panel of the mapped series with the second table's measures.

    The semi join stands after the aggregation. Catalyst moves it below when
    the map is small enough to broadcast; with a large map it stays above, so
    raw rows are never shuffled on a hot series key. No join is hinted.

    The second table is joined as it is: a day that appears twice in it appears
    twice in the panel. ``profile.series_audit`` shows such series.
    """
    wanted = key_map.select(F.col("source_name").alias(S.SERIES))
    cleaned = clip_corrections(pivot_daily(long).join(wanted, S.SERIES, "left_semi"))
    renamed = cleaned.join(
        key_map, cleaned[S.SERIES] == key_map["source_name"]
    ).select(
        F.col("second_name").alias(S.SERIES),
        *[c for c in cleaned.columns if c != S.SERIES],
    )
    second = vacc.join(
        key_map.select(F.col("second_name").alias(S.SERIES)), S.SERIES, "left_semi"
    ).select(S.SERIES, S.DATE, *S.VACC_MEASURES)
    return renamed.join(second, [S.SERIES, S.DATE], "left").select(S.PANEL_SCHEMA.names)


def vacc_timeline(panel: DataFrame) -> DataFrame:
    """Coverage over time, from the first recorded vaccination on."""
    return panel.filter(F.col("total_vaccinations") > 0).select(
        S.SERIES,
        S.DATE,
        "people_vaccinated_per_hundred",
        "people_fully_vaccinated_per_hundred",
        "daily_vaccinations",
    )


def series_keys(key_map: DataFrame) -> DataFrame:
    return key_map.select(F.col("second_name").alias(S.SERIES)).distinct()


def bounds(panel: DataFrame, date: str = S.DATE) -> tuple[Column, Column]:
    """First and last day of the whole panel, as scalar subqueries."""
    return panel.agg(F.min(date)).scalar(), panel.agg(F.max(date)).scalar()


def date_spine(
    panel: DataFrame, keys: DataFrame, *, series: str = S.SERIES, date: str = S.DATE
) -> DataFrame:
    """Every day between the panel's first and last, for every key.

    Each key unfolds its own sequence of days, so there is no join.
    """
    low, high = bounds(panel, date)
    return keys.select(series, F.explode(F.sequence(low, high)).alias(date))


def gap_fill(
    panel: DataFrame,
    keys: DataFrame,
    *,
    zero: Sequence[str] = tuple(S.ZERO_FILLED),
    carry: Sequence[str] = tuple(S.FORWARD_FILLED),
    series: str = S.SERIES,
    date: str = S.DATE,
) -> DataFrame:
    """The panel on its full date spine without NULLs.

    ``zero`` columns are 0 on missing days; ``carry`` columns hold their last
    known value, and 0 before the first one. A key without data gets zeros
    throughout.

    Equals spine LEFT JOIN panel, but only the rows that exist are shuffled,
    once, by series: each row unfolds the days up to the next row of its
    series, and the first one also the days before it. The result stays
    partitioned by series for the windows that follow.
    """
    low, high = bounds(panel, date)
    w = per_series(series, date)
    rows = keys.select(series).join(panel.select(series, date, *zero, *carry), series, "left")
    known = rows.withColumns({
        **{c: last_known(w, c) for c in carry},
        "_prev": F.lag(date).over(w),
        "_next": F.lead(date).over(w),
    })
    day = F.col(date)
    start = F.when(F.col("_prev").isNull(), low).otherwise(day)
    stop = F.greatest(day, F.coalesce(F.date_sub("_next", 1), high))
    days = known.withColumn("_day", F.explode(F.sequence(start, stop)))
    own = F.col("_day") == day
    known_yet = F.col("_day") >= day
    return days.select(
        series,
        F.col("_day").alias(date),
        *[F.coalesce(F.when(own, F.col(c)), F.lit(0)).alias(c) for c in zero],
        *[F.coalesce(F.when(known_yet, F.col(c)), F.lit(0)).alias(c) for c in carry],
    )
