import pytest
from pyspark.sql import functions as F

from tidemark.functions.scalars import decimal_text, strip_quotes, thousands, whole_text
from tidemark.operators import text


def stats(spark):
    return spark.createDataFrame(
        [("A B", "HIGH", 12345678, 1000.0, 25.5, 3.0, 7, 40.0, 61.24)],
        "country_region string, risk_tier string, cases_last_30d bigint, "
        "forecast_30d_cases double, pct_change_30d double, avg_mape double, "
        "deaths_last_30d bigint, latest_7d_avg_cases double, vacc_coverage_pct double",
    )


def value(spark, expr):
    return spark.range(1).select(expr.alias("v")).first().v


def test_numbers_as_text(spark):
    assert value(spark, whole_text(F.lit(12345678.0))) == "12345678"
    assert value(spark, decimal_text(F.lit(12.3), 2)) == "12.30"
    assert value(spark, thousands(F.lit(1234567.4))) == "1,234,567"
    assert value(spark, thousands(F.lit(3.25), 1)) == "3.2"
    assert value(spark, strip_quotes(F.lit('"A B" '))) == "A B"


def test_briefing_holds_all_fields(spark):
    p = text.prompt_briefing(stats(spark)).first().prompt
    role, facts, task = p.split("\n\n")
    assert facts.split("\n") == [
        "Place: A B",
        "New cases in 30 days: 12345678",
        "Trend: climbing fast, by 25.50% on the month before",
        "Deaths in 30 days: 7",
        "Cases per day at present: 40",
        "Fully vaccinated: 61.2%",
        "Forecast cases for 30 days: 1000",
        "Risk tier: HIGH",
    ]
    assert role and task


def test_policy_holds_its_six_fields(spark):
    facts = text.prompt_policy(stats(spark)).first().prompt.split("\n\n")[1]
    assert [f.split(": ")[0] for f in facts.split("\n")] == [
        "Place", "Risk tier", "Cases in 30 days", "Change over 30 days",
        "Fully vaccinated", "Forecast cases for 30 days",
    ]


def test_explanation_falls_back_without_importance(spark):
    none = spark.createDataFrame([], "country_region string, feature_list string")
    r = text.prompt_explain(stats(spark), none).first()
    assert r.feature_list is None and text.NO_IMPORTANCE in r.prompt
    some = spark.createDataFrame([("A B", "1. x")], "country_region string, feature_list string")
    assert "1. x" in text.prompt_explain(stats(spark), some).first().prompt


def test_completion_runs_once_per_row_and_stamps_the_time(spark):
    prompts = text.prompt_policy(stats(spark))
    out = text.complete(prompts, lambda ps: [p.upper() for p in ps], "reply")
    assert out.columns == [*[c for c in prompts.columns if c != "prompt"], "reply", "generated_at"]
    r = out.first()
    assert r.reply == prompts.first().prompt.upper() and r.generated_at is not None


def test_default_completion_returns_the_facts(spark):
    r = text.complete(text.prompt_briefing(stats(spark))).first()
    assert r.narrative.startswith("Place: A B\n") and "\n\n" not in r.narrative


def test_completion_must_answer_every_prompt(spark):
    with pytest.raises(Exception, match="1 prompts gave 0 texts"):
        text.complete(text.prompt_policy(stats(spark)), lambda ps: []).collect()
