"""Rolling origins: what a model would have forecast from every day of the past.

Each origin fits on the days up to it. A fit of a line needs six sums over its
days, and a sum over a window of days is the difference of two running sums. So
one ordered pass over a series fits every origin: no training row is read
twice, whatever the number of origins. The days ahead of an origin come from
the same pass.

The errors by number of days ahead then give intervals that are as wide as the
errors were, instead of a normal quantile of one spread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions.aggregates import count_where
from tidemark.functions.windows import lagged, per_series, running_sum
from tidemark.operators.models import TREND_ORIGIN


def origin_fits(
    train: DataFrame,
    window: int = 180,
    horizon: int = 30,
    *,
    series: str = S.SERIES,
    timestamp: str = S.DATE,
    target: str = S.TARGET,
) -> DataFrame:
    """A line through the ``window`` rows up to each day that has as many, and the days ahead of it.

    series, origin, n, mean_x, mean_y, sxx, slope, residual_sd, and ``ahead``,
    the next ``horizon`` (day, actual) pairs. One row per series and day is
    expected; null targets count as 0.
    """
    y = F.coalesce(F.col(target).cast("double"), F.lit(0.0))
    rows = train.select(
        F.col(series).alias("series"),
        F.col(timestamp).alias("origin"),
        (F.unix_date(F.col(timestamp)) - TREND_ORIGIN).cast("double").alias("x"),
        y.alias("y"),
    )
    w = per_series("series", "origin")
    terms = {"n": F.lit(1.0), "x": F.col("x"), "y": F.col("y"), "xx": F.col("x") * F.col("x"),
             "xy": F.col("x") * F.col("y"), "yy": F.col("y") * F.col("y")}
    ahead = F.collect_list(F.struct("origin", "y")).over(w.rowsBetween(1, horizon))
    summed = rows.withColumn("ahead", ahead).withColumns({f"up_{k}": running_sum(w, v) for k, v in terms.items()})
    before = {f"s_{k}": F.col(f"up_{k}") - F.coalesce(lagged(w, f"up_{k}", window), F.lit(0.0)) for k in terms}
    fits = summed.withColumns(before).where((F.col("up_n") >= window) & (F.size("ahead") > 0))
    n = F.col("s_n")
    moments = fits.select(
        "series", "origin", "ahead", n.alias("n"),
        (F.col("s_x") / n).alias("mean_x"),
        (F.col("s_y") / n).alias("mean_y"),
        (F.col("s_xx") - F.col("s_x") * F.col("s_x") / n).alias("sxx"),
        (F.col("s_xy") - F.col("s_x") * F.col("s_y") / n).alias("sxy"),
        F.greatest(F.col("s_yy") - F.col("s_y") * F.col("s_y") / n, F.lit(0.0)).alias("syy"),
    )
    slope = F.when(F.col("sxx") > 0, F.col("sxy") / F.col("sxx")).otherwise(0.0)
    left = F.greatest(F.col("syy") - F.col("slope") * F.col("sxy"), F.lit(0.0))
    return moments.withColumn("slope", slope).select(
        "series", "origin", "n", "mean_x", "mean_y", "sxx", "slope",
        F.when(F.col("n") > 2, F.sqrt(left / (F.col("n") - 2))).otherwise(0.0).alias("residual_sd"),
        "ahead",
    )


def origins(train: DataFrame, window: int = 180, horizon: int = 30, **columns: str) -> DataFrame:
    """(series, origin, step, ts, actual, forecast) for every origin and each of the days ahead of it."""
    fits = origin_fits(train, window, horizon, **columns)
    steps = fits.select("series", "origin", "mean_x", "mean_y", "slope", F.explode("ahead").alias("to"))
    x = F.unix_date(F.col("to.origin")) - TREND_ORIGIN
    return steps.select(
        "series",
        "origin",
        F.datediff(F.col("to.origin"), F.col("origin")).alias("step"),
        F.col("to.origin").alias("ts"),
        F.col("to.y").alias("actual"),
        (F.col("mean_y") + F.col("slope") * (x - F.col("mean_x"))).alias("forecast"),
    )


def scores_by_step(tested: DataFrame) -> DataFrame:
    """Errors over all series and origins by number of days ahead."""
    gap = F.col("actual") - F.col("forecast")
    return tested.groupBy("step").agg(
        F.count("*").alias("forecasts"),
        F.avg(F.abs(gap)).alias("mae"),
        F.sqrt(F.avg(gap * gap)).alias("rmse"),
        F.avg(gap).alias("bias"),
    )


def bands(tested: DataFrame, interval: float = 0.95) -> DataFrame:
    """(series, step, under, over): what to add to a forecast that many days ahead.

    Quantiles of a series' own errors at that step, one per origin, so a group
    is as long as the calendar. They include 0, and a later step is never
    narrower than an earlier one.
    """
    if not 0 < interval < 1:
        raise ValueError("interval lies between 0 and 1")
    gap = F.col("actual") - F.col("forecast")
    ends = [F.lit((1 - interval) / 2), F.lit((1 + interval) / 2)]
    raw = tested.groupBy("series", "step").agg(F.percentile(gap, F.array(*ends)).alias("q"))
    upto = Window.partitionBy("series").orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return raw.select(
        "series",
        "step",
        F.min(F.least(F.col("q")[0], F.lit(0.0))).over(upto).alias("under"),
        F.max(F.greatest(F.col("q")[1], F.lit(0.0))).over(upto).alias("over"),
    )


def calibrated(predictions: DataFrame, errors: DataFrame, last_day: Column) -> DataFrame:
    """``predictions`` with the interval of ``bands`` in place of their own.

    ``last_day``: the day the forecasts start from. Rows without a band (an
    unknown series, or a step no origin reached) keep their interval.
    """
    rows = predictions.withColumn("step", F.datediff(F.col("ts"), last_day))
    return rows.join(errors, ["series", "step"], "left").select(
        "series",
        "ts",
        "forecast",
        F.coalesce(F.col("forecast") + F.col("under"), F.col("lower_bound")).alias("lower_bound"),
        F.coalesce(F.col("forecast") + F.col("over"), F.col("upper_bound")).alias("upper_bound"),
    )


def coverage(predictions: DataFrame, actuals: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """How often the actual lies in the interval, in per cent, and how wide it is: in all, and early and late."""
    pairs = predictions.join(
        actuals, (F.col("series") == F.col(S.SERIES)) & (F.col("ts") == F.col(S.DATE))
    ).withColumn("first_day", F.min("ts").over(Window.partitionBy("series")))
    inside = F.col("actual_cases").between(F.col("lower_bound"), F.col("upper_bound"))
    width = F.col("upper_bound") - F.col("lower_bound")
    early = F.datediff("ts", "first_day") < 7
    grouped = pairs.groupBy(*by) if by else pairs.groupBy()
    return grouped.agg(
        F.count("*").alias("days"),
        F.round(F.lit(100.0) * count_where(inside) / F.count("*"), 2).alias("coverage_pct"),
        F.round(F.avg(width), 2).alias("mean_width"),
        F.round(F.avg(F.when(early, width)), 2).alias("width_first_week"),
        F.round(F.avg(F.when(~early, width)), 2).alias("width_later"),
    )
