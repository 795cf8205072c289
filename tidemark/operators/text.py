"""Prompts built from the statistics, and a hook that completes them.

Each prompt has three paragraphs divided by blank lines: the role, the facts
and the task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas as S
from tidemark.functions.scalars import decimal_text, whole_text
from tidemark.operators.risk import trend_phrase

NO_IMPORTANCE = "no ranking of the inputs is available"

BRIEFING_ROLE = "Your reader runs a public health service and wants to know what figures mean, not how they were made."
BRIEFING_TASK = (
    "In one short paragraph, say where things stand and where they are heading, who will feel it "
    "first, and the single measure you would start with. Keep to the figures given."
)
GLOBAL_ROLE = "You summarise the worldwide situation for senior health officials."
GLOBAL_TASK = (
    "Write four or five plain sentences: the overall direction, and by name the places that "
    "need attention. Use only the figures above."
)
POLICY_ROLE = "You advise a health ministry on policy."
POLICY_TASK = (
    "Propose measures for the coming week and for the coming month, and name the services to "
    "strengthen first. Match their force to the risk tier and the coverage: where the risk is "
    "low, watching is enough."
)
EXPLAIN_ROLE = "You explain the output of a forecast model to a health official."
EXPLAIN_TASK = (
    "Say in two or three plain sentences why the model expects this course, relating the "
    "leading inputs to what they mean in practice. Do not list them."
)


def _prompt(role: str, facts: list[Column], task: str) -> Column:
    return F.concat(F.lit(role + "\n\n"), *facts, F.lit("\n\n" + task))


def _fact(label: str, value: Column, suffix: str = "") -> list[Column]:
    return [F.lit(label), value, F.lit(suffix)]


def _facts(*facts: list[Column]) -> list[Column]:
    """Join facts with line breaks."""
    out = list(facts[0])
    for fact in facts[1:]:
        out += [F.lit("\n"), *fact]
    return out


def prompt_briefing(stats: DataFrame) -> DataFrame:
    """One situation-briefing prompt per series."""
    c = F.col
    facts = _facts(
        _fact("Place: ", c(S.SERIES)),
        _fact("New cases in 30 days: ", whole_text(c("cases_last_30d"))),
        _fact("Trend: ", trend_phrase(c("pct_change_30d"))),
        _fact("Deaths in 30 days: ", whole_text(c("deaths_last_30d"))),
        _fact("Cases per day at present: ", whole_text(c("latest_7d_avg_cases"))),
        _fact("Fully vaccinated: ", decimal_text(c("vacc_coverage_pct"), 1), "%"),
        _fact("Forecast cases for 30 days: ", whole_text(c("forecast_30d_cases"))),
        _fact("Risk tier: ", c("risk_tier")),
    )
    return stats.select(
        S.SERIES, "risk_tier", "cases_last_30d", "forecast_30d_cases", "pct_change_30d",
        "avg_mape", _prompt(BRIEFING_ROLE, facts, BRIEFING_TASK).alias("prompt"),
    )


def prompt_global(rollup: DataFrame) -> DataFrame:
    """One prompt over all series (one per page of the roll-up)."""
    c = F.col
    facts = _facts(
        _fact("Places watched: ", whole_text(c("series_count"))),
        _fact("By trend: ", c("all_countries_summary")),
        _fact("Cases in 30 days: ", whole_text(c("global_cases_30d"))),
        _fact("Deaths in 30 days: ", whole_text(c("global_deaths_30d"))),
        _fact("High risk: ", whole_text(c("high_risk_count"))),
        _fact("Moderate risk: ", whole_text(c("moderate_risk_count"))),
        _fact("Low risk: ", whole_text(c("low_risk_count"))),
    )
    return rollup.select(
        "page", "high_risk_count", "moderate_risk_count", "low_risk_count",
        _prompt(GLOBAL_ROLE, facts, GLOBAL_TASK).alias("prompt"),
    )


def prompt_policy(stats: DataFrame) -> DataFrame:
    """One policy prompt per series."""
    c = F.col
    facts = _facts(
        _fact("Place: ", c(S.SERIES)),
        _fact("Risk tier: ", c("risk_tier")),
        _fact("Cases in 30 days: ", whole_text(c("cases_last_30d"))),
        _fact("Change over 30 days: ", decimal_text(c("pct_change_30d"), 2), "%"),
        _fact("Fully vaccinated: ", decimal_text(c("vacc_coverage_pct"), 1), "%"),
        _fact("Forecast cases for 30 days: ", whole_text(c("forecast_30d_cases"))),
    )
    return stats.select(
        S.SERIES, "risk_tier", "cases_last_30d", "pct_change_30d", "vacc_coverage_pct",
        _prompt(POLICY_ROLE, facts, POLICY_TASK).alias("prompt"),
    )


def prompt_explain(stats: DataFrame, feature_text: DataFrame) -> DataFrame:
    """One explanation prompt per series, also where no ranking exists."""
    c = F.col
    facts = _facts(
        _fact("Place: ", c(S.SERIES)),
        _fact("Risk tier: ", c("risk_tier")),
        _fact("Change over 30 days: ", decimal_text(c("pct_change_30d"), 2), "%"),
        _fact("Cases per day at present: ", whole_text(c("latest_7d_avg_cases"))),
        _fact("Fully vaccinated: ", decimal_text(c("vacc_coverage_pct"), 1), "%"),
        _fact("Leading inputs:\n", F.coalesce(c("feature_list"), F.lit(NO_IMPORTANCE))),
    )
    return stats.join(feature_text, S.SERIES, "left").select(
        S.SERIES, "risk_tier", "feature_list",
        _prompt(EXPLAIN_ROLE, facts, EXPLAIN_TASK).alias("prompt"),
    )


def complete(
    prompts: DataFrame,
    fn: Callable[[list[str]], list[str]] | None = None,
    out: str = "narrative",
    prompt: str = "prompt",
) -> DataFrame:
    """Replace each prompt by its completion and stamp the time.

    ``fn`` takes a batch of prompts and returns as many texts. It runs in the
    executors, on Arrow batches, and never sees a null prompt: its text is null.
    Without one the facts paragraph of the prompt stands for the text.
    """
    if fn is None:
        facts = F.split_part(F.col(prompt), F.lit("\n\n"), F.lit(2)).alias(out)
        rest = [F.col(c) for c in prompts.columns if c != prompt]
        return prompts.select(*rest, facts).withColumn("generated_at", F.current_timestamp())
    rest = [f for f in prompts.schema if f.name != prompt]
    schema = T.StructType([*rest, T.StructField(out, T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            given = batch[prompt].notna()
            asked = batch.loc[given, prompt].tolist()
            texts = list(fn(asked)) if asked else []
            if len(texts) != len(asked):
                raise ValueError(f"{len(asked)} prompts gave {len(texts)} texts")
            done = batch.drop(columns=prompt)
            done[out] = None
            done.loc[given, out] = texts
            yield done

    return prompts.mapInPandas(run, schema).withColumn("generated_at", F.current_timestamp())
