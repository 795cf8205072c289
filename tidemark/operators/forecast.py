"""Training views, holdout, scoring and assembly of the forecast table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions.aggregates import conditional_sum, count_where, rounded_mean
from tidemark.functions.filters import (
    as_date,
    cutoff,
    latest,
    latest_per_key,
    leading,
    trailing,
    without_series,
)
from tidemark.functions.scalars import floor_zero_round, key_noise, ratio
from tidemark.sources.staging import horizon

ZEROED = ("vacc_7d_avg", "vacc_rate_lag_14d", "vacc_rate_lag_21d", "vacc_rate_lag_28d")
LOW_COUNT = 100


def training_view(
    features: DataFrame, *, exclude: Sequence[str] = S.DEFAULT_EXCLUDED, months: int = 12
) -> DataFrame:
    """Target and smoothed exogenous columns of the last ``months`` (inclusive)."""
    rows = trailing(
        features.filter(F.col("cases_7d_avg").isNotNull()),
        months,
        "month",
        inclusive=True,
        anchor=features,
    )
    return without_series(rows, exclude).select(
        S.SERIES,
        S.DATE,
        F.col("cases_7d_avg").alias(S.TARGET),
        *[
            F.coalesce(F.col(c), F.lit(0.0)).alias(c) if c in ZEROED else F.col(c)
            for c in S.EXOGENOUS
        ],
    )


def train_split(training: DataFrame, holdout: int = 30) -> DataFrame:
    return leading(training, holdout)


def test_actuals(training: DataFrame, holdout: int = 30) -> DataFrame:
    return trailing(training, holdout).select(
        S.SERIES, S.DATE, F.col(S.TARGET).alias("actual_cases")
    )


def test_exogenous(training: DataFrame, holdout: int = 30) -> DataFrame:
    return trailing(training, holdout).drop(S.TARGET)


def future_exogenous(training: DataFrame, days: int = 30) -> DataFrame:
    """Each series' own last values on the ``days`` after the global last day."""
    last = latest_per_key(training.drop(S.TARGET), [S.SERIES], S.DATE)
    values = [c for c in last.columns if c not in (S.SERIES, S.DATE)]
    return last.select(S.SERIES, horizon(days), *values).select(
        S.SERIES, F.date_add(latest(training), F.col("step")).alias(S.DATE), *values
    )


def evaluate(predictions: DataFrame, actuals: DataFrame) -> DataFrame:
    """Holdout errors of each series.

    Errors use the forecast as it is; only ``total_forecast`` clips at 0 and
    rounds. A day with nothing expected and nothing seen counts as sMAPE 0.
    ``mape_filtered`` looks at days above ``LOW_COUNT`` only.
    """
    a, f = F.col("actual_cases"), F.col("forecast")
    error, scale = F.abs(a - f), F.abs(a) + F.abs(f)
    pairs = predictions.join(
        actuals,
        (predictions["series"] == actuals[S.SERIES]) & (predictions["ts"] == actuals[S.DATE]),
    )
    return pairs.groupBy(F.col("series").alias(S.SERIES)).agg(
        F.count("*").alias("eval_days"),
        rounded_mean(error, 2).alias("mae"),
        F.round(F.avg(F.when(scale > 0, F.lit(200.0) * error / scale).otherwise(0.0)), 2).alias(
            "smape"
        ),
        F.round(F.avg(F.when(a > LOW_COUNT, error / a * 100)), 2).alias("mape_filtered"),
        F.round(ratio(F.sum(error), F.sum(a)) * 100, 2).alias("wmape"),
        F.sum(a).alias("total_actual"),
        F.sum(floor_zero_round(f)).alias("total_forecast"),
        rounded_mean(a, 0).alias("avg_daily_actual"),
        count_where(a <= LOW_COUNT).alias("low_count_days"),
    )


def eval_report(evaluation: DataFrame) -> DataFrame:
    """Per-series scores, best sMAPE first."""
    return evaluation.select(
        S.SERIES, "eval_days", "mae", "smape", "mape_filtered", "wmape",
        "avg_daily_actual", "low_count_days",
    ).orderBy("smape", S.SERIES)


def overall_metrics(evaluation: DataFrame) -> DataFrame:
    """Unweighted means over the series."""
    return evaluation.agg(*[
        rounded_mean(F.col(m), 2).alias(f"overall_{m}") for m in ("mae", "smape", "wmape")
    ])


def forecast_output(
    features: DataFrame,
    forecast: DataFrame,
    evaluation: DataFrame,
    *,
    exclude: Sequence[str] = S.DEFAULT_EXCLUDED,
    history_days: int = 90,
) -> DataFrame:
    """Recent actuals and the forward forecast in one table.

    Actual rows carry the smoothed cases in both case columns and an error of
    0; forecast rows are clipped at 0 and rounded, and ``mape`` holds the
    series' holdout WMAPE.
    """
    empty = F.lit(None)
    recent = without_series(trailing(features, history_days, inclusive=True), exclude)
    actuals = recent.select(
        S.SERIES,
        F.col(S.DATE).alias("ds"),
        F.col("cases_7d_avg").alias("actual_cases"),
        F.col("new_deaths").alias("actual_deaths"),
        F.col("cases_7d_avg").alias("forecasted_cases"),
        empty.cast("double").alias("forecast_lower"),
        empty.cast("double").alias("forecast_upper"),
        F.lit(0.0).alias("mape"),
        F.lit(False).alias("is_forecast"),
    )
    scores = evaluation.select(F.col(S.SERIES).alias("series"), F.col("wmape").alias("mape"))
    forward = forecast.join(scores, "series", "left").select(
        F.col("series").alias(S.SERIES),
        F.col("ts").alias("ds"),
        empty.cast("double").alias("actual_cases"),
        empty.cast("bigint").alias("actual_deaths"),
        floor_zero_round(F.col("forecast")).alias("forecasted_cases"),
        floor_zero_round(F.col("lower_bound")).alias("forecast_lower"),
        floor_zero_round(F.col("upper_bound")).alias("forecast_upper"),
        "mape",
        F.lit(True).alias("is_forecast"),
    )
    return actuals.unionByName(forward)


def synthetic_forecast(
    long: DataFrame,
    key_map: DataFrame,
    *,
    since: str | Column,
    recent_days: int = 30,
    seed: int = 42,
    noise: tuple[float, float] = (-0.10, 0.15),
    error: tuple[float, float] = (-0.05, 0.12),
) -> DataFrame:
    """Stand-in for the forecast table: noisy cumulative actuals.

    The noise depends on series, day and seed alone, so reruns and retried
    tasks agree.
    """
    keys = key_map.select(F.col("second_name").alias(S.SERIES))
    actual = (
        long.filter(F.col(S.DATE) >= as_date(since))
        .groupBy(S.SERIES, S.DATE)
        .agg(
            conditional_sum("cumulative_value", F.col("case_type") == "Confirmed").alias("cases"),
            conditional_sum("cumulative_value", F.col("case_type") == "Deaths").alias("deaths"),
        )
        .join(keys, S.SERIES, "left_semi")
    )
    key = [F.col(S.SERIES), F.col(S.DATE)]
    noisy = F.col("cases") * (1 + key_noise(key, *noise, seed))
    return actual.select(
        S.SERIES,
        F.col(S.DATE).alias("ds"),
        F.col("cases").cast("double").alias("actual_cases"),
        F.col("deaths").alias("actual_deaths"),
        F.round(noisy, 0).alias("forecasted_cases"),
        F.lit(None).cast("double").alias("forecast_lower"),
        F.lit(None).cast("double").alias("forecast_upper"),
        F.round(F.abs(key_noise(key, *error, seed + 1)) * 100, 2).alias("mape"),
        (F.col(S.DATE) >= cutoff(long, recent_days)).alias("is_forecast"),
    )
