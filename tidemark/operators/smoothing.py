"""Exponential smoothing with a damped trend and a season, per series.

A series' days go through a recursion in order: level, trend and one value per
day of the season. Every state of it is also an origin from which the days
ahead can be forecast, so one ordered pass over a series scores a whole grid of
smoothing weights by their errors up to ``horizon`` days ahead, from every day
on. The weights with the least mean squared error are kept.

A series is one array of daily values (a few hundred numbers). Spark gathers and
deals out the series; a task runs the recursion for many series and all weights
at once, as arrays.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Weights of level, trend and season that are tried, in this order; the first of equals is kept.
GRID = [(a, b, g) for a in (0.05, 0.1, 0.2, 0.4, 0.8) for b in (0.0, 0.05, 0.2) for g in (0.0, 0.1, 0.3)]
DAMPING = 0.98
#: Seasons that pass before errors count.
BURN = 4
#: Series that are reckoned together.
TOGETHER = 64


def reach(step, damping: float = DAMPING):
    """What a trend of 1 adds in ``step`` days."""
    return damping * (1 - damping**step) / (1 - damping)


def padded(values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Series as rows of one array, NaN after their ends, and their lengths."""
    n = np.array([len(v) for v in values])
    out = np.full((len(values), max(n.max(initial=0), 1)), np.nan)
    for i, v in enumerate(values):
        out[i, : len(v)] = v
    return out, n


def states(y: np.ndarray, n: np.ndarray, weights: np.ndarray, period: int, damping: float) -> Iterator[tuple]:
    """(t, level, trend, season) after each day from the end of the first season on.

    ``weights``: (series or 1, choices, 3). States are (series, choices), the
    season (series, choices, period) by day number modulo ``period``. A series
    that has ended keeps its last state. One with less than two seasons has the
    mean of its values as level and nothing else.
    """
    a, b, g = weights[..., 0], weights[..., 1], weights[..., 2]
    shape = (len(y), weights.shape[1])
    short = n < 2 * period
    first, second = (np.zeros(len(y)) for _ in range(2))
    for i in range(period):
        first = first + np.where(short, 0.0, y[:, i] if i < y.shape[1] else 0.0)
        second = second + np.where(short, 0.0, y[:, period + i] if period + i < y.shape[1] else 0.0)
    first, second = first / period, second / period
    mean = np.where(n > 0, np.nansum(y, axis=1) / np.maximum(n, 1), 0.0)
    level = np.broadcast_to(np.where(short, mean, first)[:, None], shape).copy()
    trend = np.broadcast_to(((second - first) / period)[:, None], shape).copy()
    season = np.zeros((*shape, period))
    for i in range(min(period, y.shape[1])):
        season[..., i] = np.where(short, 0.0, y[:, i] - first)[:, None]
    yield period - 1, level, trend, season
    for t in range(period, y.shape[1]):
        on = ((t < n) & ~short)[:, None]
        value, at = y[:, t][:, None], t % period
        old = season[..., at]
        new = a * (value - old) + (1 - a) * (level + damping * trend)
        rise = b * (new - level) + (1 - b) * damping * trend
        season[..., at] = np.where(on, g * (value - new) + (1 - g) * old, old)
        level, trend = np.where(on, new, level), np.where(on, rise, trend)
        yield t, level, trend, season


def errors(t: int, y: np.ndarray, level, trend, season, horizon: int, damping: float) -> np.ndarray:
    """(series, choices, steps): errors of the days ahead of t; NaN beyond the end."""
    steps = np.arange(1, horizon + 1)
    out = np.full((*level.shape, horizon), np.nan)
    have = min(horizon, y.shape[1] - 1 - t)
    if have > 0:
        at = (t + steps[:have]) % season.shape[-1]
        ahead = level[..., None] + reach(steps[:have], damping) * trend[..., None] + season[..., at]
        out[..., :have] = y[:, None, t + 1 : t + 1 + have] - ahead
    return out


def chosen(y: np.ndarray, n: np.ndarray, period: int, horizon: int, damping: float) -> tuple[np.ndarray, np.ndarray]:
    """The weights with the least mean squared error of each series, and that error."""
    grid = np.array(GRID)[None]
    total, count = np.zeros((len(y), len(GRID))), np.zeros((len(y), 1))
    for t, level, trend, season in states(y, n, grid, period, damping):
        if t < BURN * period:
            continue
        gap = errors(t, y, level, trend, season, horizon, damping)
        total += np.nansum(gap * gap, axis=2)
        count += np.sum(~np.isnan(gap[:, :1, :]), axis=2)
    mean = total / np.maximum(count, 1)
    # Compared to nine digits: the order of addition decides nothing.
    least = mean.min(axis=1, keepdims=True)
    best = np.argmin(np.round(mean / np.where(least > 0, least, 1.0), 9), axis=1)
    return np.array(GRID)[best], mean[np.arange(len(y)), best]


def spreads(y: np.ndarray, n: np.ndarray, weights: np.ndarray, period: int, horizon: int, damping: float, ends):
    """(series, steps, ends): quantiles of the errors at each step over all origins, linearly interpolated."""
    gaps = []
    for t, level, trend, season in states(y, n, weights[:, None, :], period, damping):
        if t >= BURN * period:
            gaps.append(errors(t, y, level, trend, season, horizon, damping)[:, 0])
    out = np.zeros((len(y), horizon, len(ends)))
    if not gaps:
        return out
    gap = np.sort(np.stack(gaps), axis=0)  # NaN last
    have = np.sum(~np.isnan(gap), axis=0)
    for i, q in enumerate(ends):
        place = q * np.maximum(have - 1, 0)
        low = np.floor(place).astype(int)
        high = np.minimum(low + 1, np.maximum(have - 1, 0))
        x, z = (np.take_along_axis(gap, k[None], axis=0)[0] for k in (low, high))
        out[..., i] = np.where(have > 0, x + (place - low) * (z - x), 0.0)
    return out


def fit(train: DataFrame, series: str, day: str, target: str, period: int, horizon: int) -> DataFrame:
    """One row per series: weights, last state, last day, and the values the recursion went through.

    The values of a series are in order of days; nulls count as 0. ``season``
    begins with the day after the last one.
    """

    @F.pandas_udf("alpha double, beta double, gamma double, level double, trend double, season array<double>, mse double")
    def run(values: pd.Series) -> pd.DataFrame:
        parts = []
        for at in range(0, max(len(values), 1), TOGETHER):
            y, n = padded(list(values[at : at + TOGETHER]))
            weights, mse = chosen(y, n, period, horizon, DAMPING)
            for _, level, trend, season in states(y, n, weights[:, None, :], period, DAMPING):
                pass
            turned = [np.roll(s[0], -(k % period)) for s, k in zip(season, n)]
            parts.append(pd.DataFrame({
                "alpha": weights[:, 0], "beta": weights[:, 1], "gamma": weights[:, 2],
                "level": level[:, 0], "trend": trend[:, 0], "season": turned, "mse": mse,
            }))
        return pd.concat(parts, ignore_index=True)

    value = F.coalesce(F.col(target).cast("double"), F.lit(0.0))
    gathered = train.groupBy(series).agg(
        F.max(day).alias("last_day"),
        F.sort_array(F.collect_list(F.struct(F.col(day).alias("d"), value.alias("v")))).alias("days"),
    )
    gathered = gathered.select(series, "last_day", F.col("days.v").alias("history"))
    return gathered.withColumn("fitted", run("history")).select(series, "last_day", "history", "fitted.*")


def with_spreads(params: DataFrame, period: int, horizon: int, interval: float) -> DataFrame:
    """The fitted rows with what to add for the interval's ends at each step.

    They are quantiles of the errors that the same weights made at that step
    from every earlier origin; a later step is never narrower than one before it.
    """
    ends = ((1 - interval) / 2, (1 + interval) / 2)

    @F.pandas_udf("under array<double>, over array<double>")
    def run(values: pd.Series, alpha: pd.Series, beta: pd.Series, gamma: pd.Series) -> pd.DataFrame:
        under, over = [], []
        every = np.stack([alpha, beta, gamma], axis=1) if len(values) else np.zeros((0, 3))
        for at in range(0, max(len(values), 1), TOGETHER):
            y, n = padded(list(values[at : at + TOGETHER]))
            q = spreads(y, n, every[at : at + TOGETHER], period, horizon, DAMPING, ends)
            under += list(np.minimum.accumulate(np.minimum(q[..., 0], 0.0), axis=1))
            over += list(np.maximum.accumulate(np.maximum(q[..., 1], 0.0), axis=1))
        return pd.DataFrame({"under": under, "over": over})

    return params.withColumn("band", run("history", "alpha", "beta", "gamma")).select("*", "band.*")


def forecast(day: Column, period: int, horizon: int) -> tuple[Column, Column, Column]:
    """The forecast of ``day`` and what its interval's ends add; steps past ``horizon`` have the last step's."""
    step = F.datediff(day, F.col("last_day"))
    ahead = F.lit(DAMPING) * (F.lit(1.0) - F.pow(F.lit(DAMPING), step)) / F.lit(1 - DAMPING)
    place = (F.pmod(step - 1, F.lit(period)) + 1).cast("int")
    value = F.col("level") + ahead * F.col("trend") + F.element_at("season", place)
    at = F.greatest(F.least(step, F.lit(horizon)), F.lit(1)).cast("int")
    return value, F.element_at("under", at), F.element_at("over", at)


# Functions of this module go along with a task, for workers without the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
