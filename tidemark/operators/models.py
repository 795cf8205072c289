"""Per-series forecast models.

``fit`` reduces the training rows to one parameter row per series with
built-in aggregates, which combine on the map side (exponential smoothing,
which needs the days in order, with one array per series). ``predict`` joins the
parameters to the days asked for. One call handles all series; every column
besides series, time and target is an exogenous input.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions.filters import cutoff
from tidemark.functions.windows import lagged, per_series
from tidemark.operators import boosting, smoothing
from tidemark.sources.layers import LayerStore

METHODS = ("ridge", "linear_trend", "seasonal_naive", "ets", "boosted")
TREND = "trend"
LAGS = (0, 7, 14, 30)  # days beyond the horizon at which the boosted trees see the target
LEVEL_DAYS = 28  # and the mean of as many days up to the horizon
RECENT = 120  # values of a series that its boosted parameters hold
TREND_ORIGIN = 18_262  # 2020-01-01 as days since 1970; any nearby day serves
WEEKDAYS = [f"weekday_{d}" for d in range(2, 8)]  # day 1 is the base


@dataclass(frozen=True)
class ForecastModel:
    """Fitted parameters, one row per series."""

    method: str
    params: DataFrame
    series: str
    timestamp: str
    inputs: tuple[str, ...] = ()
    period: int = 7
    horizon: int = 30  # days ahead by which smoothing weights, lags and intervals are set
    forest: boosting.Forest | None = None
    residuals: DataFrame | None = None  # of the boosted trees: (step, size of the error by the series' level)

    def predict(self, exog: DataFrame, interval: float = 0.95) -> DataFrame:
        return predict(self, exog, interval)

    def feature_importance(self) -> DataFrame:
        return feature_importance(self)


def fit(
    train: DataFrame,
    method: str = "ridge",
    *,
    series: str = S.SERIES,
    timestamp: str = S.DATE,
    target: str = S.TARGET,
    period: int = 7,
    penalty: float = 1.0,
    weekdays: bool = False,
    horizon: int = 30,
) -> ForecastModel:
    """Fit one model per series in one pass over ``train``.

    ``weekdays`` adds weekday indicators to the ridge inputs. They are off by
    default because the usual target is a 7-day mean, in which every weekday
    counts the same; raw daily targets want them.
    """
    exogenous = [c for c in train.columns if c not in (series, timestamp, target)]
    if method == "seasonal_naive":
        params = _fit_seasonal(train, series, timestamp, target, period)
        return ForecastModel(method, params, series, timestamp, (), period)
    if method == "linear_trend":
        return ForecastModel(method, _fit_linear(train, series, timestamp, target), series, timestamp)
    if method == "ets":
        params = smoothing.fit(train, series, timestamp, target, period, horizon)
        return ForecastModel(method, params, series, timestamp, (), period, horizon)
    if method == "boosted":
        return _fit_boosted(train, series, timestamp, target, exogenous, horizon)
    if method == "ridge":
        inputs = (TREND, *(WEEKDAYS if weekdays else ()), *exogenous)
        params = _fit_ridge(train, series, timestamp, target, inputs, penalty)
        return ForecastModel(method, params, series, timestamp, inputs)
    raise ValueError(f"method is one of {METHODS}, not {method!r}")


def predict(model: ForecastModel, exog: DataFrame, interval: float = 0.95) -> DataFrame:
    """Point forecast and interval for every (series, day) of ``exog``.

    Series the model does not know are left out.
    """
    if not 0 < interval < 1:
        raise ValueError("interval lies between 0 and 1")
    params = model.params
    if model.method == "ets":
        params = smoothing.with_spreads(params, model.period, model.horizon, interval).drop("history")
    rows = exog.join(params, model.series)
    day = F.col(model.timestamp)
    if model.method == "ets":
        forecast, under, over = smoothing.forecast(day, model.period, model.horizon)
        return _predicted(rows, model, forecast, forecast + under, forecast + over)
    if model.method == "boosted":
        forecast, half = _boosted(model, interval)
        return _predicted(rows, model, forecast, forecast - half, forecast + half)
    if model.method == "seasonal_naive":
        forecast, spread = _seasonal(day, model.period)
    elif model.method == "linear_trend":
        forecast, spread = _linear(day)
    else:
        forecast, spread = _ridge(model)
    half = F.lit(NormalDist().inv_cdf(0.5 + interval / 2)) * spread
    return _predicted(rows, model, forecast, forecast - half, forecast + half)


def _predicted(rows: DataFrame, model: ForecastModel, forecast: Column, low: Column, high: Column) -> DataFrame:
    return rows.select(
        F.col(model.series).alias("series"),
        F.col(model.timestamp).alias("ts"),
        forecast.alias("forecast"),
        low.alias("lower_bound"),
        high.alias("upper_bound"),
    )


def feature_importance(model: ForecastModel) -> DataFrame:
    """What the fitted model rests on, ranked per series.

    Ridge: share of the absolute standardised coefficients. The linear trend
    rests on time alone, the seasonal naive model and exponential smoothing on
    no input: no rows. Boosted trees: each input's share of what the cuts
    explained, the same for every series.
    """
    if model.forest is not None:
        total = sum(model.forest.gains.values()) or 1.0
        shares = F.array(*(F.lit(model.forest.gains[n] / total) for n in model.inputs))
        return _ranked(model.params, model.series, F.array(*(F.lit(n) for n in model.inputs)), shares)
    if model.method != "ridge":
        trend = model.params.select(
            F.col(model.series).alias("series"),
            F.lit(1).alias("rank"),
            F.lit("trend").alias("feature_name"),
            F.lit(1.0).alias("score"),
        )
        return trend if model.method == "linear_trend" else trend.where(F.lit(False))
    size = F.transform("beta", F.abs)
    total = F.aggregate("size", F.lit(0.0), lambda sum_, x: sum_ + x)
    scores = F.transform(
        "size", lambda x: F.when(F.col("total") > 0, x / F.col("total")).otherwise(0.0)
    )
    scored = model.params.withColumn("size", size).withColumn("total", total)
    return _ranked(scored, model.series, F.array(*[F.lit(n) for n in model.inputs]), scores)


def importance_permutation(
    model: ForecastModel,
    holdout: DataFrame,
    *,
    target: str = S.TARGET,
    seed: int = 42,
    digits: int = 6,
) -> DataFrame:
    """How much worse the model forecasts ``holdout`` when an input is mixed up, ranked per series.

    Inside a series an input's values are dealt to other days: the day that is
    k-th by date gets the value of the day that is k-th by a hash of series,
    day, input and seed. ``score`` is the rise of the mean absolute error. The
    result depends on the rows and the seed alone, not on their partitioning.
    A series' holdout is a group; models without inputs give no rows.

    Each row is unfolded once per input beside its own forecast, and one shuffle
    by (series, input) brings a series' values together.
    """
    if model.method not in ("ridge", "linear_trend", "seasonal_naive", "ets"):
        raise ValueError(f"no permutation importance for {model.method!r}")
    if not model.inputs:
        return holdout.select(
            F.col(model.series).alias("series"), F.lit(0).alias("rank"),
            F.lit("").alias("feature_name"), F.lit(0.0).alias("score"),
        ).where(F.lit(False))
    day = F.col(model.timestamp)
    names = F.array(*(F.lit(n) for n in model.inputs))
    values = F.array(*(_input(n, model.timestamp) for n in model.inputs))
    base = holdout.join(model.params, model.series).select(
        F.col(model.series).alias("series"),
        day.alias("day"),
        F.col(target).cast("double").alias("actual"),
        _ridge(model)[0].alias("forecast"),
        "beta",
        "sd_x",
        F.posexplode(F.arrays_zip(names.alias("name"), values.alias("own"))).alias("at", "input"),
    )
    key = F.md5(F.concat_ws("|", "series", F.date_format("day", "yyyy-MM-dd"), "input.name", F.lit(str(seed))))
    base = base.select("*", F.col("input.name").alias("feature_name"), F.col("input.own").alias("own"), key.alias("mix"))
    group = Window.partitionBy("series", "feature_name")
    mixed = F.sort_array(F.collect_list(F.struct("mix", "day", "own")).over(group))
    moved = F.element_at(F.col("mixed.own"), F.row_number().over(group.orderBy("day")))
    rows = base.withColumn("mixed", mixed).withColumn("given", moved)
    scale = F.col("sd_x")[F.col("at")]
    shift = F.when(scale > 0, F.col("beta")[F.col("at")] * (F.col("given") - F.col("own")) / scale).otherwise(0.0)
    rise = F.abs(F.col("actual") - (F.col("forecast") + shift)) - F.abs(F.col("actual") - F.col("forecast"))
    scores = rows.groupBy("series", "feature_name").agg(F.round(F.avg(rise), digits).alias("score"))
    place = F.row_number().over(Window.partitionBy("series").orderBy(F.desc("score"), "feature_name"))
    return scores.select("series", place.alias("rank"), "feature_name", "score")


def importance_corr(
    train: DataFrame,
    *,
    series: str = S.SERIES,
    timestamp: str = S.DATE,
    target: str = S.TARGET,
    digits: int = 6,
) -> DataFrame:
    """Absolute correlation of each exogenous column with the target, ranked."""
    inputs = [c for c in train.columns if c not in (series, timestamp, target)]
    corr = train.groupBy(series).agg(
        *[
            _safe_corr(F.col(c), F.col(target)).alias(c)
            for c in inputs
        ]
    )
    names = F.array(*[F.lit(c) for c in inputs])
    return _ranked(
        corr, series, names, F.array(*[F.round(F.abs(F.col(c)), digits) for c in inputs])
    )


def _safe_corr(x: Column, y: Column) -> Column:
    spread = F.var_pop(x) * F.var_pop(y)
    return F.when(spread > 0, F.covar_pop(x, y) / F.sqrt(spread)).otherwise(0.0)


def _ranked(df: DataFrame, series: str, names: Column, scores: Column) -> DataFrame:
    """Unfold one row's scores into ranked rows; sorted inside the row, no shuffle.

    Ties go by name.
    """
    entries = F.sort_array(
        F.zip_with(
            scores, names, lambda score, name: F.struct((-score).alias("neg"), name.alias("name"))
        )
    )
    return df.select(
        F.col(series).alias("series"), F.posexplode(entries).alias("pos", "entry")
    ).select(
        "series",
        (F.col("pos") + 1).alias("rank"),
        F.col("entry.name").alias("feature_name"),
        (-F.col("entry.neg")).alias("score"),
    )


def _fit_seasonal(
    train: DataFrame, series: str, day: str, target: str, period: int
) -> DataFrame:
    """The last season's values and the spread of season-on-season changes."""
    w = per_series(series, day)
    rows = train.select(
        series,
        day,
        target,
        (F.col(target) - lagged(w, target, period)).alias("change"),
        F.lead(day, period).over(w).isNull().alias("in_last_season"),
    )
    season = F.collect_list(F.when(F.col("in_last_season"), F.struct(day, target)))
    return (
        rows.groupBy(series)
        .agg(
            F.max(day).alias("last_day"),
            F.coalesce(F.stddev_samp("change"), F.lit(0.0)).alias("change_sd"),
            F.sort_array(season).alias("season"),
        )
        .withColumn("season", F.col(f"season.{target}"))
    )


def _seasonal(day: Column, period: int) -> tuple[Column, Column]:
    step = F.datediff(day, F.col("last_day"))
    index = F.pmod(step - 1, F.size("season")) + 1
    return (
        F.element_at("season", index.cast("int")),
        F.col("change_sd") * F.sqrt(F.ceil(step / F.lit(period))),
    )


def _fit_linear(train: DataFrame, series: str, day: str, target: str) -> DataFrame:
    y = F.col(target).cast("double")
    x = F.unix_date(F.col(day)).cast("double")
    sums = train.groupBy(series).agg(
        F.regr_count(y, x).alias("n"),
        F.regr_avgx(y, x).alias("mean_x"),
        F.regr_avgy(y, x).alias("mean_y"),
        F.regr_sxx(y, x).alias("sxx"),
        F.regr_syy(y, x).alias("syy"),
        F.regr_sxy(y, x).alias("sxy"),
    )
    slope = F.coalesce(F.col("sxy") / F.nullif("sxx", F.lit(0.0)), F.lit(0.0))
    residual = F.greatest(F.col("syy") - F.col("slope") * F.col("sxy"), F.lit(0.0))
    return sums.withColumn("slope", slope).select(
        series,
        "n",
        "mean_x",
        "mean_y",
        "sxx",
        "slope",
        F.when(F.col("n") > 2, F.sqrt(residual / (F.col("n") - 2)))
        .otherwise(0.0)
        .alias("residual_sd"),
    )


def _linear(day: Column) -> tuple[Column, Column]:
    offset = F.unix_date(day) - F.col("mean_x")
    distance = F.coalesce(offset * offset / F.nullif("sxx", F.lit(0.0)), F.lit(0.0))
    return (
        F.col("mean_y") + F.col("slope") * offset,
        F.col("residual_sd") * F.sqrt(1 + 1 / F.col("n") + distance),
    )


def _fit_boosted(
    train: DataFrame, series: str, day: str, target: str, exogenous: Sequence[str], horizon: int
) -> ForecastModel:
    """Trees over all series: the target by its series' level, from lags no shorter than the horizon.

    Such lags are known for every day that is forecast, so forecasts do not
    feed on forecasts. Rows without the longest lag do not train. Interval
    widths come from a fit without the last ``horizon`` days, which it then
    forecasts.
    """
    w = per_series(series, day)
    y = F.coalesce(F.col(target).cast("double"), F.lit(0.0))
    level = F.avg(F.abs(F.col("y"))).over(Window.partitionBy(series))
    rows = train.select(series, day, y.alias("y"), *exogenous).withColumn("level", level)
    rows = rows.withColumn("level", F.when(F.col("level") > 0, F.col("level")).otherwise(1.0))
    far = horizon + max(*LAGS, LEVEL_DAYS - 1)
    lags = {f"lag_{horizon + k}": lagged(w, "y", horizon + k) / F.col("level") for k in LAGS}
    mean = F.avg("y").over(w.rowsBetween(1 - LEVEL_DAYS - horizon, -horizon)) / F.col("level")
    rows = rows.withColumns({
        **lags, f"mean_{horizon}": mean, "answer": F.col("y") / F.col("level"), "age": F.row_number().over(w),
    })
    names = (*exogenous, *lags, f"mean_{horizon}")
    spark = train.sparkSession
    kept, work = LayerStore(spark), LayerStore(spark)
    rows = work.write(rows.where(F.col("age") > far), "boosted", "rows")
    keep = lambda df: work.write(df, "boosted", "bins")
    cut = cutoff(rows, horizon, date=day)
    both = [rows, rows.where(F.col(day) <= cut)]
    forest, early = boosting.train_together(both, names, "answer", keep, otherwise=1.0)  # their level, if nothing is known
    inputs = [F.coalesce(F.col(n).cast("double"), F.lit(0.0)) for n in names]
    errors = rows.where(F.col(day) > cut).select(
        F.datediff(day, cut).alias("step"), F.abs(F.col("answer") - boosting.value(early, inputs)).alias("size")
    )
    errors = kept.write(errors, "boosted", "errors")
    work.close()
    params = train.groupBy(series).agg(
        F.max(day).alias("last_day"),
        F.avg(F.abs(y)).alias("level"),
        F.sort_array(F.collect_list(F.struct(F.col(day).alias("d"), y.alias("v"))), asc=False).alias("days"),
    )
    params = params.select(
        series, "last_day", F.col("level").alias("size"),
        F.when(F.col("level") > 0, F.col("level")).otherwise(1.0).alias("level"),
        F.reverse(F.slice("days.v", 1, RECENT)).alias("recent"),
    )
    return ForecastModel("boosted", params, series, day, names, horizon=horizon, forest=forest, residuals=errors)


def _boosted(model: ForecastModel, interval: float) -> tuple[Column, Column]:
    step = F.datediff(F.col(model.timestamp), F.col("last_day"))
    last = F.size("recent") - 1

    def known(lag: int) -> Column:
        return F.coalesce(F.get("recent", F.least(last, last + step - lag)), F.lit(0.0)) / F.col("level")

    at = F.greatest(F.least(last, last + step - model.horizon) - LEVEL_DAYS + 2, F.lit(1))
    days = F.slice("recent", at, LEVEL_DAYS)
    mean = F.aggregate(days, F.lit(0.0), lambda s, x: s + x) / F.greatest(F.size(days), F.lit(1)) / F.col("level")
    inputs = []
    for name in model.inputs:
        if name == f"mean_{model.horizon}":
            inputs.append(mean)
        elif name.startswith("lag_"):
            inputs.append(known(int(name[4:])))
        else:
            inputs.append(F.coalesce(F.col(name).cast("double"), F.lit(0.0)))
    forecast = boosting.value(model.forest, inputs) * F.col("size")
    # One number per step; a later step is never narrower than one before it.
    found = model.residuals.groupBy("step").agg(F.percentile_approx("size", interval, 10_000).alias("q")).collect()
    by_step = {r.step: r.q for r in found}
    widths, most = [], 0.0
    for s in range(1, model.horizon + 1):
        most = max(most, by_step.get(s, 0.0))
        widths.append(most)
    half = F.element_at(F.array(*(F.lit(x) for x in widths)), F.greatest(F.least(step, F.lit(model.horizon)), F.lit(1)))
    return forecast, half * F.col("size")


def _input(name: str, day: str) -> Column:
    """A model input as DOUBLE: trend, weekday indicator or exogenous column."""
    if name == TREND:
        return (F.unix_date(F.col(day)) - TREND_ORIGIN).cast("double")
    if name in WEEKDAYS:
        return (F.dayofweek(F.col(day)) == int(name[-1])).cast("double")
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0))


def _fit_ridge(
    train: DataFrame, series: str, day: str, target: str, inputs: Sequence[str], penalty: float
) -> DataFrame:
    """Ridge regression on standardised inputs from per-series moments.

    Sums and sums of products are ordinary aggregates, so a training row never
    leaves its task; only they, one row per series, go to numpy, many series at
    a time. Plain sums stay within whole-stage code generation, several times
    faster than as many covariance aggregates. What they lose to cancellation
    (about 1e-16 * mean^2 / variance) is far below the ridge penalty; a column
    whose spread is under a millionth of its level counts as constant.
    """
    p = len(inputs)
    rows = train.select(
        series,
        F.col(target).cast("double").alias("v0"),
        *[_input(name, day).alias(f"v{j}") for j, name in enumerate(inputs, start=1)],
    )
    pairs = [(i, j) for i in range(p + 1) for j in range(i, p + 1)]
    moments = rows.groupBy(series).agg(
        F.expr("count(v0) AS n"),
        *[F.expr(f"sum(v{j}) AS s{j}") for j in range(p + 1)],
        *[F.expr(f"sum(v{i} * v{j}) AS p{i}_{j}") for i, j in pairs],
    )
    solved = _ridge_solver(p, penalty)(
        "n",
        _array(f"s{j}" for j in range(p + 1)),
        _array(f"p{i}_{j}" for i, j in pairs),
    )
    return moments.select(series, solved.alias("solved")).select(series, "solved.*")


def _array(items) -> Column:
    return F.expr(f"array({', '.join(items)})")


def _ridge_solver(p: int, penalty: float):
    """Pandas UDF solving a batch of p x p systems."""
    upper = np.triu_indices(p + 1)

    @F.pandas_udf(
        "mean_y double, mean_x array<double>, sd_x array<double>, beta array<double>, "
        "residual_sd double"
    )
    def solve(n: pd.Series, sums: pd.Series, products: pd.Series) -> pd.DataFrame:
        k = len(n)
        rows = n.to_numpy(dtype=float)
        mean = np.array(sums.tolist(), dtype=float).reshape(k, p + 1) / rows[:, None]
        cov = np.zeros((k, p + 1, p + 1))
        cov[:, upper[0], upper[1]] = np.array(products.tolist(), dtype=float).reshape(k, -1)
        cov[:, upper[1], upper[0]] = cov[:, upper[0], upper[1]]
        cov = cov / rows[:, None, None] - mean[:, :, None] * mean[:, None, :]
        # A constant column has no spread but for rounding; its row becomes 0, so beta is 0.
        var = np.einsum("kii->ki", cov)
        spread = var > 1e-12 * mean**2
        cov = cov * (spread[:, :, None] & spread[:, None, :])
        sd = np.sqrt(np.where(spread, var, 0.0))
        scale = np.where(sd > 0, sd, 1.0)[:, 1:]
        r = cov[:, 1:, 1:] / (scale[:, :, None] * scale[:, None, :])
        ry = cov[:, 1:, 0] / scale
        ridge = (penalty / rows)[:, None, None] * np.eye(p)
        beta = np.linalg.solve(r + ridge, ry[:, :, None])[:, :, 0]
        fitted = 2 * (beta * ry).sum(axis=1) - np.einsum("ki,kij,kj->k", beta, r, beta)
        mse = np.maximum(sd[:, 0] ** 2 - fitted, 0.0)
        return pd.DataFrame({
            "mean_y": mean[:, 0],
            "mean_x": list(mean[:, 1:]),
            "sd_x": list(sd[:, 1:]),
            "beta": list(beta),
            "residual_sd": np.sqrt(mse * rows / np.maximum(rows - p - 1, 1.0)),
        })

    return solve


def _ridge(model: ForecastModel) -> tuple[Column, Column]:
    forecast = F.col("mean_y")
    for j, name in enumerate(model.inputs):
        offset = _input(name, model.timestamp) - F.col("mean_x")[j]
        scaled = F.when(F.col("sd_x")[j] > 0, offset / F.col("sd_x")[j]).otherwise(0.0)
        forecast = forecast + F.col("beta")[j] * scaled
    return forecast, F.col("residual_sd")
