"""The whole job: staged tables to marts, each shared layer written once."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tidemark import schemas as S
from tidemark.operators import features as feat
from tidemark.operators import forecast as fc
from tidemark.operators import models, panel, profile, risk, text
from tidemark.operators.completions import complete_once
from tidemark.sources import staging
from tidemark.sources.layers import LayerStore

STG, INT, MARTS = "stg", "int", "marts"


class Pipeline:
    """Layers on first use.

    What several steps read is written to the store when first asked for: the
    daily panel, the features, the predictions and scores, the forecast table,
    the importance ranking, the statistics and the texts. The rest are plain
    lazy frames.
    """

    def __init__(
        self,
        long: DataFrame,
        vacc: DataFrame,
        key_map: DataFrame,
        *,
        exclude: Sequence[str] = S.DEFAULT_EXCLUDED,
        method: str = "ridge",
        horizon: int = 30,
        holdout: int = 30,
        interval: float = 0.95,
        complete: Callable[[list[str]], list[str]] | None = None,
        page_size: int = 1000,
        ledger: str | None = None,
        store: LayerStore | None = None,
    ):
        self.long, self.vacc, self.key_map = long, vacc, key_map
        self.exclude = tuple(exclude)
        self.method = method
        self.horizon, self.holdout, self.interval = horizon, holdout, interval
        self.complete = complete
        self.page_size = page_size
        self.ledger = ledger  # folder in which completions are kept, so that each is asked for once
        self._others: dict[str, Pipeline] = {method: self}
        self.spark: SparkSession = long.sparkSession
        self.store = store or LayerStore(self.spark)

    def with_method(self, method: str) -> Pipeline:
        """The same pipeline with another forecast method, one for each method.

        Panel and features are shared.
        """
        if method in self._others:
            return self._others[method]
        other = Pipeline(
            self.long, self.vacc, self.key_map, exclude=self.exclude, method=method,
            horizon=self.horizon, holdout=self.holdout, interval=self.interval,
            complete=self.complete, page_size=self.page_size, ledger=self.ledger, store=self.store,
        )
        other.__dict__.update(panel=self.panel, features=self.features)
        other._others = self._others
        self._others[method] = other
        return other

    # -- intermediate layer
    @cached_property
    def panel(self) -> DataFrame:
        df = panel.daily_panel(self.long, self.vacc, self.key_map)
        return self.store.write(
            S.assert_schema(df, S.PANEL_SCHEMA), INT, "daily_country_series"
        )

    @property
    def keys(self) -> DataFrame:
        return panel.series_keys(self.key_map)

    @property
    def filled(self) -> DataFrame:
        return panel.gap_fill(self.panel, self.keys)

    # -- marts
    @cached_property
    def profile(self) -> DataFrame:
        return self.store.write(profile.data_profile(self.panel), MARTS, "data_profile")

    @cached_property
    def features(self) -> DataFrame:
        # Ordered by day within each file: readers of the last weeks or months
        # skip most row groups.
        df = feat.features(self.filled)
        return self.store.write(df, MARTS, "features_engineered", (S.DATE, S.SERIES))

    @property
    def training(self) -> DataFrame:
        return fc.training_view(self.features, exclude=self.exclude)

    @cached_property
    def eval_predictions(self) -> DataFrame:
        model = models.fit(fc.train_split(self.training, self.holdout), self.method)
        df = model.predict(fc.test_exogenous(self.training, self.holdout), self.interval)
        return self._forecast_layer(df, "eval_predictions")

    @cached_property
    def evaluation(self) -> DataFrame:
        df = fc.evaluate(self.eval_predictions, fc.test_actuals(self.training, self.holdout))
        return self.store.write(df, MARTS, f"forecast_eval_{self.method}")

    @cached_property
    def final_model(self) -> models.ForecastModel:
        return models.fit(self.training, self.method)

    @cached_property
    def forecast(self) -> DataFrame:
        future = fc.future_exogenous(self.training, self.horizon)
        return self._forecast_layer(
            self.final_model.predict(future, self.interval), "forecast_raw"
        )

    @cached_property
    def output(self) -> DataFrame:
        df = fc.forecast_output(
            self.features, self.forecast, self.evaluation, exclude=self.exclude
        )
        return self.store.write(
            S.assert_schema(df, S.OUTPUT_SCHEMA), MARTS, f"forecast_output_{self.method}"
        )

    @cached_property
    def importance(self) -> DataFrame:
        """Of the fitted model; the explanations name these inputs."""
        df = self.final_model.feature_importance()
        return self.store.write(
            S.assert_schema(df, S.IMPORTANCE_SCHEMA), MARTS, f"feature_importance_{self.method}"
        )

    @cached_property
    def correlations(self) -> DataFrame:
        """Of the exogenous columns with the target, whatever the model."""
        df = models.importance_corr(self.training)
        return self.store.write(S.assert_schema(df, S.IMPORTANCE_SCHEMA), MARTS, "importance_corr")

    @cached_property
    def stats(self) -> DataFrame:
        # One row per series, read several times by the roll-up and the matrix.
        df = risk.country_stats(
            self.features, self.output, self.evaluation, exclude=self.exclude
        )
        return self.store.write(df, MARTS, f"country_stats_{self.method}")

    @property
    def rollup(self) -> DataFrame:
        return risk.global_rollup(self.stats, self.page_size)

    @cached_property
    def narratives(self) -> DataFrame:
        return self._text(text.prompt_briefing(self.stats), "narrative", "outbreak_narratives")

    @cached_property
    def global_summary(self) -> DataFrame:
        return self._text(text.prompt_global(self.rollup), "global_narrative", "global_summary")

    @cached_property
    def policies(self) -> DataFrame:
        return self._text(
            text.prompt_policy(self.stats), "policy_recommendations", "policy_recommendations"
        )

    @cached_property
    def explanations(self) -> DataFrame:
        prompts = text.prompt_explain(self.stats, risk.top_feature_text(self.importance))
        return self._text(prompts, "explanation", "explainability_narratives")

    def views(self) -> dict[str, Callable[[], DataFrame]]:
        """Every table and view of the pipeline by name, built when called."""
        return {
            "stg_long": lambda: self.long,
            "stg_vaccinations": lambda: self.vacc,
            "target_countries": lambda: self.key_map,
            "daily_country_series": lambda: self.panel,
            "data_profile": lambda: self.profile,
            "vaccination_timeline": lambda: panel.vacc_timeline(self.panel),
            "date_spine": lambda: panel.date_spine(self.panel, self.keys),
            "base_filled": lambda: self.filled,
            "features_engineered": lambda: self.features,
            "ml_training_data": lambda: self.training,
            "ml_train_split": lambda: fc.train_split(self.training, self.holdout),
            "ml_test_actuals": lambda: fc.test_actuals(self.training, self.holdout),
            "ml_test_exogenous": lambda: fc.test_exogenous(self.training, self.holdout),
            "eval_predictions": lambda: self.eval_predictions,
            "forecast_eval": lambda: self.evaluation,
            "future_exogenous": lambda: fc.future_exogenous(self.training, self.horizon),
            "forecast_raw": lambda: self.forecast,
            "forecast_output": lambda: self.output,
            "feature_importance": lambda: self.importance,
            "importance_corr": lambda: self.correlations,
            "country_stats": lambda: self.stats,
            "outbreak_narratives": lambda: self.narratives,
            "global_summary": lambda: self.global_summary,
            "policy_recommendations": lambda: self.policies,
            "explainability_narratives": lambda: self.explanations,
        }

    def build(self) -> None:
        """Write every materialised layer."""
        for view in self.views().values():
            view()

    def save_tables(self, database: str) -> None:
        """Replace one catalog table per view in ``database``."""
        for name, view in self.views().items():
            self.store.save_table(view(), f"{database}.{name}")

    def create_views(self, *names: str) -> None:
        """Register temporary views (by default all), so that SQL can read them."""
        views = self.views()
        for name in names or views:
            views[name]().createOrReplaceTempView(name)

    def _forecast_layer(self, df: DataFrame, name: str) -> DataFrame:
        S.assert_schema(df, S.FORECAST_SCHEMA)
        return self.store.write(df, MARTS, f"{name}_{self.method}")

    def _text(self, prompts: DataFrame, out: str, name: str) -> DataFrame:
        if self.complete and self.ledger:
            df = complete_once(prompts, self.complete, self.ledger, out)
        else:
            df = text.complete(prompts, self.complete, out)
        return self.store.write(df, MARTS, f"{name}_{self.method}")


def staged(
    store: LayerStore, raw_long: DataFrame, raw_vacc: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Stage both sources and write them, for sources that are costly to derive.

    Rows are ordered by day within each file, so audits of one day skip the rest.
    """
    long = store.write(staging.stage_long(raw_long), STG, "stg_long", (S.DATE, S.SERIES))
    vacc = store.write(staging.stage_vacc(raw_vacc), STG, "stg_vacc")
    return long, vacc
