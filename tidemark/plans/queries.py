"""Registered queries: every operator over the driver's tables.

The staged sources, panel, features and forecasts are written once per
application and data directory; each query then runs its operator on them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions.aggregates import exact_median
from tidemark.functions.filters import latest, latest_per_key, since_first_end
from tidemark.operators import features as feat
from tidemark.operators import forecast as fc
from tidemark.operators import backtest, models, panel, present, profile, risk, text
from tidemark.operators.blocks import features_blocked
from tidemark.operators.completions import complete_once
from tidemark.operators.names import name_suggest
from tidemark.operators.refresh import RefreshedFeatures
from tidemark.plans.pipeline import Pipeline, staged
from tidemark.sources import staging, tpch
from tidemark.sources.layers import LayerStore

# Parameters of the registered queries, shared with their SQL counterparts.
METHOD = "linear_trend"
SERIES = "NATION_3"
SUB_REGION = "BUILDING"
CHECK_DAY = "1998-06-02"
CHECK_TYPE = "Confirmed"
CHECK_FROM, CHECK_TO = "1998-03-01", "1998-03-31"
STUB_SINCE = "2001-01-01"
SEED = 42
PAGE = 10
REFRESH_DAYS = 40
WINDOW = 180  # days that a rolling origin fits on
NAMES = ["NATION_1", "NATION_2", "NATION_3", "NATION_7", "NATION_11", "NATION_24", "ATLANTIS"]
COMPARED = ["NATION_1", "NATION_2", "NATION_3", "NATION_7", "NATION_11"]

_pipelines: dict[tuple[str, str], Pipeline] = {}


def pipeline_for(spark: SparkSession, sf_dir: str) -> Pipeline:
    """The pipeline over one data directory, its layers kept for the application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _pipelines:
        store = LayerStore(spark)
        sources = staged(store, tpch.raw_long(spark, sf_dir), tpch.raw_vacc(spark, sf_dir))
        keep(spark, sf_dir, pipeline_over(spark, sf_dir, *sources, store))
    return _pipelines[key]


def pipeline_over(
    spark: SparkSession, sf_dir: str, long: DataFrame, vacc: DataFrame, store: LayerStore
) -> Pipeline:
    return Pipeline(
        long,
        vacc,
        tpch.nation_key_map(spark, sf_dir),
        exclude=tpch.EXCLUDED,
        method=METHOD,
        page_size=PAGE,
        store=store,
    )


def keep(spark: SparkSession, sf_dir: str, pipeline: Pipeline) -> None:
    """Let the queries of this application use ``pipeline`` for ``sf_dir``."""
    _pipelines[spark.sparkContext.applicationId, sf_dir] = pipeline


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round sums and fits whose last bits depend on the order of addition."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _rolled(p: Pipeline) -> DataFrame:
    return feat.rolling_means(p.filled)


def _forecast(p: Pipeline, method: str) -> DataFrame:
    model = models.fit(p.training, method)
    df = model.predict(fc.future_exogenous(p.training, p.horizon), p.interval)
    return _rounded(df, 2, "forecast", "lower_bound", "upper_bound")


def _origins(p: Pipeline) -> DataFrame:
    """Rolling origins before the holdout."""
    return backtest.origins(fc.train_split(p.training, p.holdout), WINDOW, p.horizon)


def _calibrated(p: Pipeline, predictions: DataFrame, train: DataFrame) -> DataFrame:
    """``predictions`` with intervals from the errors of the origins in ``train``."""
    errors = backtest.bands(backtest.origins(train, WINDOW, p.horizon), p.interval)
    return backtest.calibrated(predictions, errors, latest(train))


def _coverage(p: Pipeline) -> DataFrame:
    """The holdout inside the intervals of three ways to make them."""
    ways = {
        "ets": p.with_method("ets").eval_predictions,
        "linear_trend": p.eval_predictions,
        "linear_trend_calibrated": _calibrated(p, p.eval_predictions, fc.train_split(p.training, p.holdout)),
    }
    found = reduce(DataFrame.unionByName, (df.withColumn("method", F.lit(name)) for name, df in ways.items()))
    return backtest.coverage(found, fc.test_actuals(p.training, p.holdout), ["method"])


def _refreshed(p: Pipeline) -> DataFrame:
    """Features built from a delivery without the last days and with other counts in the weeks before, then refreshed."""
    table = RefreshedFeatures(p.spark, f"{p.store.root}/refreshed/{uuid.uuid4().hex}")
    last = p.long.agg(F.date_sub(F.max(S.DATE), REFRESH_DAYS)).scalar()
    other = (F.col(S.DATE) > F.date_sub(last, REFRESH_DAYS)) & (F.col(S.SERIES) == SERIES)
    earlier = p.long.where(F.col(S.DATE) <= last).withColumn(
        "daily_value", F.when(other, F.col("daily_value") + 1).otherwise(F.col("daily_value"))
    )
    table.refresh(earlier, p.vacc, p.key_map)
    table.refresh(p.long, p.vacc, p.key_map)
    return table.read()


def _tolerant(p: Pipeline) -> DataFrame:
    """Rows of a mart that is there, by its path, and of one that is not."""
    there = staging.load(p.spark, p.store.table("marts", f"country_stats_{p.method}").path) if p.stats else None
    gone = staging.load_or_empty(p.spark, f"{p.store.root}/marts/none", there.schema)
    count = lambda df, name: df.agg(F.lit(name).alias("mart"), F.count("*").alias("mart_rows"))
    return count(there, "there").unionByName(count(gone, "gone"))


def _characters(prompts: list[str]) -> list[str]:
    """Stands for a service that takes one prompt at a time."""
    if len(prompts) > 1:
        raise RuntimeError("one prompt at a time")
    return [f"{len(p)} characters" for p in prompts]


def _respelled(p: Pipeline) -> DataFrame:
    """The key map's names as another source might write them: ``NATION_12`` as ``12, Nation``, and one in three ``Nation12``."""
    number = F.split_part("source_name", F.lit("_"), F.lit(2))
    word = F.initcap(F.split_part("source_name", F.lit("_"), F.lit(1)))
    other = F.when(number.cast("int") % 3 == 0, F.concat(word, number)).otherwise(F.concat_ws(", ", number, word))
    return p.key_map.select(other.alias("other_name"))


def _key(*columns: str) -> list[str]:
    return [S.SERIES, S.DATE, *columns]


def _sql(p: Pipeline, statement: str, *views: str) -> DataFrame:
    """A SQL statement over the pipeline's views."""
    p.create_views(*views)
    return p.spark.sql(statement)


_ON_PIPELINE: dict[str, Callable[[Pipeline], DataFrame]] = {
    # staging and panel
    "key_map_coverage": lambda p: profile.key_map_coverage(
        p.long, p.key_map, CHECK_DAY, CHECK_TYPE
    ),
    "daily_panel": lambda p: panel.daily_panel(p.long, p.vacc, p.key_map),
    "vacc_timeline": lambda p: panel.vacc_timeline(p.panel),
    "date_spine": lambda p: panel.date_spine(p.panel, p.keys),
    "gap_fill": lambda p: p.filled,
    "sql_over_views": lambda p: _sql(
        p,
        """SELECT p.country_region, p.total_days, s.risk_tier, s.cases_last_30d
        FROM data_profile p LEFT JOIN country_stats s ON p.country_region = s.country_region""",
        "data_profile", "country_stats",
    ),
    # features
    "features_rolling_7d": lambda p: feat.rolling_means(
        p.filled, {"cases_7d_avg": ("new_cases", 7, 2)}
    ).select(_key("new_cases", "cases_7d_avg")),
    "features_rolling_all": lambda p: _rolled(p).select(_key(*feat.ROLLING)),
    "doubling_time": lambda p: feat.doubling_time(p.filled).select(
        _key("cumulative_cases", "doubling_time_days")
    ),
    "wow_growth": lambda p: _rounded(
        feat.wow_growth(_rolled(p)).select(_key("wow_change_7d_avg", "wow_growth_pct")),
        2, "wow_change_7d_avg",
    ),
    "rate_lags": lambda p: feat.rate_lags(p.filled).select(
        _key("vacc_rate_lag_14d", "vacc_rate_lag_21d", "vacc_rate_lag_28d")
    ),
    "case_death_ratio": lambda p: feat.case_death_ratio(_rolled(p)).select(
        _key("case_death_ratio")
    ),
    "surge_flag": lambda p: feat.surge_flag(feat.wow_growth(_rolled(p))).select(
        _key("wow_growth_pct", "surge_flag")
    ),
    "vacc_impact": lambda p: feat.vacc_impact_proxy(feat.rate_lags(_rolled(p))).select(
        _key("vacc_impact_proxy")
    ),
    "recovery_rate": lambda p: feat.recovery_rate(_rolled(p)).select(_key("recovery_rate")),
    "recovery_rate_sql_mode": lambda p: feat.recovery_rate(_rolled(p), "daily").select(
        _key("recovery_rate")
    ),
    "features_all": lambda p: _rounded(feat.features(p.filled), 2, "wow_change_7d_avg"),
    "features_blocked": lambda p: _rounded(features_blocked(p.panel, p.keys), 2, "wow_change_7d_avg"),
    "features_refreshed": lambda p: _rounded(_refreshed(p), 2, "wow_change_7d_avg"),
    # profiling and verification
    "data_profile": lambda p: profile.data_profile(p.panel),
    "panel_summary": lambda p: profile.panel_summary(p.panel),
    "spot_check_series": lambda p: profile.spot_check_series(
        p.long, SERIES, CHECK_FROM, CHECK_TO, SUB_REGION
    ),
    "feature_spot_check": lambda p: profile.feature_spot_check(
        p.features, SERIES, CHECK_FROM, CHECK_TO,
        _key("people_fully_vaccinated_per_hundred", "vacc_rate_lag_14d",
             "vacc_rate_lag_21d", "vacc_rate_lag_28d"),
    ),
    "granularity_audit": lambda p: profile.granularity_audit(
        p.long, CHECK_DAY, CHECK_TYPE, NAMES
    ),
    "top_subregions": lambda p: profile.top_subregions(
        p.long, SERIES, CHECK_DAY, CHECK_TYPE, 15
    ),
    "name_reconcile": lambda p: profile.name_reconcile(p.long, NAMES),
    "name_reconcile_second": lambda p: profile.name_reconcile(p.vacc, NAMES),
    "name_suggest": lambda p: name_suggest(p.key_map, _respelled(p), "source_name", "other_name"),
    "schema_listing": lambda p: staging.describe_schema(p.features),
    "mart_preview": lambda p: staging.preview(p.stats.select(S.SERIES, "risk_tier").orderBy(S.SERIES), 5),
    "tolerant_load": lambda p: _tolerant(p),
    "distinct_types": lambda p: profile.distinct_values(p.long),
    "date_range": lambda p: profile.date_range(p.long),
    "row_leaderboard": lambda p: profile.row_leaderboard(p.long, 10),
    "coverage_audit": lambda p: profile.coverage_audit(p.vacc, NAMES),
    "series_audit": lambda p: profile.series_audit(p.features),
    "null_audit": lambda p: profile.null_audit(
        p.features, ["cases_7d_avg", "doubling_time_days", "wow_growth_pct",
                     "vacc_rate_lag_28d", "case_death_ratio", "vacc_impact_proxy",
                     "recovery_rate"],
    ),
    "training_null_audit": lambda p: profile.null_audit(p.training, [S.TARGET, *S.EXOGENOUS]),
    "future_null_audit": lambda p: profile.null_audit(
        fc.future_exogenous(p.training), ["deaths_7d_avg"]
    ),
    # forecasting
    "training_view": lambda p: p.training,
    "train_split": lambda p: fc.train_split(p.training),
    "test_actuals": lambda p: fc.test_actuals(p.training),
    "test_exogenous": lambda p: fc.test_exogenous(p.training),
    "future_exogenous": lambda p: fc.future_exogenous(p.training),
    "latest_features": lambda p: _rounded(
        latest_per_key(since_first_end(p.features), [S.SERIES], S.DATE), 2, "wow_change_7d_avg"
    ),
    "forecast_seasonal_naive": lambda p: _forecast(p, "seasonal_naive"),
    "forecast_linear_trend": lambda p: _forecast(p, "linear_trend"),
    "forecast_ridge": lambda p: _forecast(p, "ridge"),
    "forecast_ets": lambda p: _forecast(p, "ets"),
    "forecast_boosted": lambda p: _rounded(
        p.with_method("boosted").forecast, 2, "forecast", "lower_bound", "upper_bound"
    ),
    "forecast_calibrated": lambda p: _rounded(
        _calibrated(p, p.forecast, p.training), 2, "forecast", "lower_bound", "upper_bound"
    ),
    "backtest_origins": lambda p: _rounded(_origins(p), 2, "forecast"),
    "backtest_scores": lambda p: _rounded(backtest.scores_by_step(_origins(p)), 2, "mae", "rmse", "bias"),
    "interval_coverage": _coverage,
    "forecast_eval": lambda p: _rounded(
        fc.evaluate(p.eval_predictions, fc.test_actuals(p.training)), 2, "total_actual"
    ),
    "forecast_eval_ridge": lambda p: _rounded(
        p.with_method("ridge").evaluation, 2, "total_actual"
    ),
    "forecast_eval_ets": lambda p: _rounded(p.with_method("ets").evaluation, 2, "total_actual"),
    "forecast_eval_boosted": lambda p: _rounded(p.with_method("boosted").evaluation, 2, "total_actual"),
    "importance_boosted": lambda p: _rounded(p.with_method("boosted").importance, 6, "score"),
    "eval_report": lambda p: fc.eval_report(p.evaluation),
    "overall_metrics": lambda p: fc.overall_metrics(p.evaluation),
    "forecast_output": lambda p: fc.forecast_output(
        p.features, p.forecast, p.evaluation, exclude=p.exclude
    ),
    "forecast_day_counts": lambda p: profile.forecast_day_counts(p.output),
    "importance_corr": lambda p: models.importance_corr(p.training),
    "importance_ridge": lambda p: _rounded(models.fit(p.training, "ridge").feature_importance(), 6, "score"),
    "importance_permutation": lambda p: models.importance_permutation(
        models.fit(fc.train_split(p.training, p.holdout), "ridge"),
        fc.trailing(p.training, p.holdout), seed=SEED, digits=2,
    ),
    "synthetic_forecast": lambda p: fc.synthetic_forecast(
        p.long, p.key_map, since=STUB_SINCE, seed=SEED
    ),
    "synthetic_error_summary": lambda p: _rounded(
        profile.forecast_error_summary(
            fc.synthetic_forecast(p.long, p.key_map, since=STUB_SINCE, seed=SEED)
        ),
        2, "avg_mape",
    ),
    # risk and text
    "period_stats": lambda p: risk.period_stats(p.features, exclude=p.exclude),
    "forecast_stats": lambda p: risk.forecast_stats(p.output),
    "country_stats": lambda p: risk.combine_stats(
        risk.period_stats(p.features, exclude=p.exclude),
        risk.forecast_stats(p.output),
        p.evaluation,
    ),
    "risk_tier": lambda p: p.stats.select(S.SERIES, "pct_change_30d", "risk_tier"),
    "trend_phrase": lambda p: p.stats.select(
        S.SERIES, risk.trend_phrase(F.col("pct_change_30d")).alias("phrase")
    ),
    "global_rollup": lambda p: p.rollup,
    "top_feature_text": lambda p: risk.top_feature_text(p.importance),
    "prompt_briefing": lambda p: text.prompt_briefing(p.stats),
    "prompt_global": lambda p: text.prompt_global(p.rollup),
    "prompt_policy": lambda p: text.prompt_policy(p.stats),
    "prompt_explain": lambda p: text.prompt_explain(
        p.stats, risk.top_feature_text(p.importance)
    ),
    "narratives": lambda p: text.complete(text.prompt_briefing(p.stats)).drop("generated_at"),
    "completion_hook": lambda p: text.complete(
        text.prompt_briefing(p.stats), lambda batch: [f"{len(t)} characters" for t in batch], "answer"
    ).drop("generated_at"),
    "completion_ledger": lambda p: complete_once(
        text.prompt_briefing(p.stats), _characters, f"{p.store.root}/ledger", "answer"
    ).drop("generated_at"),
    "narrative_stamps": lambda p: p.narratives.select(
        S.SERIES, F.col("generated_at").isNotNull().alias("stamped"),
        (F.col("generated_at") <= F.current_timestamp()).alias("not_later"),
    ),
    "global_narrative": lambda p: text.complete(
        text.prompt_global(p.rollup), out="global_narrative"
    ).drop("generated_at"),
    "policies": lambda p: p.policies.drop("generated_at"),
    "explanations": lambda p: p.explanations.drop("generated_at"),
    # report tables
    "series_list": lambda p: present.series_list(p.features),
    "tier_counters": lambda p: risk.tier_counters(p.stats),
    "surging_series": lambda p: present.surging_series(p.features),
    "surge_alert": lambda p: present.surge_alert(p.features, PAGE),
    "chart_period": lambda p: present.chart_period(p.features, 180).select(
        _key("cases_7d_avg", "deaths_7d_avg")
    ),
    "chart_frame": lambda p: present.chart_frame(p.features, p.output, 365),
    "series_kpis": lambda p: _rounded(
        present.series_kpis(p.features, p.output, p.evaluation), 2, "forecast_avg", "upper_avg"
    ),
    "kpi_text": lambda p: present.kpi_text(
        present.series_kpis(p.features, p.output, p.evaluation)
    ),
    "stats_by_tier": lambda p: present.stats_by_tier(p.stats),
    "leaderboard_worst": lambda p: present.leaderboard(p.stats, 5),
    "leaderboard_best": lambda p: present.leaderboard(p.stats, 5, worst=False),
    "compare_pivot": lambda p: present.compare_pivot(p.features, COMPARED),
    "situation_matrix": lambda p: present.situation_matrix(p.stats),
    "median_daily_cases": lambda p: exact_median(p.features, "new_cases"),
    "top7_importance": lambda p: present.top_importance(p.correlations, 7),
    "profile_headline": lambda p: present.profile_headline(p.profile),
    "profile_table": lambda p: present.profile_table(p.profile),
    "tier_filtered_text": lambda p: present.tier_filtered(
        p.narratives.drop("generated_at"), ["HIGH", "MODERATE"]
    ),
    "tier_filtered_policies": lambda p: present.tier_filtered(p.policies.drop("generated_at")),
    "series_detail": lambda p: _rounded(
        present.series_history(p.features, SERIES), 2, "wow_change_7d_avg"
    ),
    "series_forecast": lambda p: present.series_forecast(p.output, SERIES),
    "series_importance": lambda p: present.series_importance(p.correlations, SERIES),
    "series_explanation": lambda p: present.series_explanation(
        p.explanations.drop("generated_at"), SERIES
    ),
}


def _on_pipeline(run: Callable[[Pipeline], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: run(pipeline_for(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "stage_long": lambda spark, d: staging.stage_long(tpch.raw_long(spark, d)),
        "stage_vacc": lambda spark, d: staging.stage_vacc(tpch.raw_vacc(spark, d)),
        "stage_population": lambda spark, d: staging.stage_population(
            tpch.raw_population(spark, d)
        ),
        **{name: _on_pipeline(run) for name, run in _ON_PIPELINE.items()},
    }
