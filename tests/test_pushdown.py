"""Readers of the last days or months must not scan the whole history."""

import pytest
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions.filters import latest_per_key, since_first_end
from tidemark.operators import forecast, present, risk
from tidemark.sources.layers import LayerStore

SERIES, DAYS = 200, 2000


@pytest.fixture(scope="module")
def features(spark, tmp_path_factory):
    i = F.col("id")
    day = F.date_add(F.lit("2020-01-01").cast("date"), (i / SERIES).cast("int"))
    kinds = {S.SERIES: "string", S.DATE: "date", "surge_flag": "int"}
    columns = [
        (i % 7).cast(kinds.get(c, "double")).alias(c)
        for c in S.FEATURE_COLUMNS
        if c not in (S.SERIES, S.DATE)
    ]
    df = spark.range(SERIES * DAYS).select(
        F.concat(F.lit("S"), (i % SERIES).cast("string")).alias(S.SERIES),
        day.alias(S.DATE),
        *columns,
    )
    store = LayerStore(spark, str(tmp_path_factory.mktemp("push")))
    return store.write(df.coalesce(1), "marts", "f", (S.DATE, S.SERIES))


def widest_scan(df) -> int:
    """Rows that the widest table scan of an executed plan produced."""
    df.collect()
    found = []

    def visit(node):
        if "Scan parquet" in node.nodeName():
            found.append((node.output().size(), node.metrics().apply("numOutputRows").value()))
        for group in (node.children(), node.subqueries()):
            for k in range(group.size()):
                visit(group.apply(k))

    visit(df._jdf.queryExecution().executedPlan())
    return max(found)[1]


READERS = {
    "period_stats": (lambda f: risk.period_stats(f), 60),
    "training_view": (lambda f: forecast.training_view(f), 366),
    # the split day is that of the training window, which is read for it
    "test_actuals": (lambda f: forecast.test_actuals(forecast.training_view(f)), 366),
    "surging_series": (lambda f: present.surging_series(f), 1),
    "chart_period": (lambda f: present.chart_period(f, 180), 181),
    "chart_frame": (
        lambda f: present.chart_frame(f, f.sparkSession.createDataFrame([], S.OUTPUT_SCHEMA), 30),
        31,
    ),
    "future_exogenous": (lambda f: forecast.future_exogenous(forecast.training_view(f)), 366),
    "latest_features": (
        lambda f: latest_per_key(since_first_end(f), [S.SERIES], S.DATE), 1
    ),
    "compare_pivot": (lambda f: present.compare_pivot(f, ["S1", "S2"], 180), 181),
}


@pytest.mark.parametrize("name", sorted(READERS))
def test_scan_is_limited_to_the_days_needed(spark, features, name):
    read, days = READERS[name]
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # metrics sit on the plain plan
    try:
        rows = widest_scan(read(features))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    page = 20_000  # rows of a Parquet page, the unit that is skipped
    assert 0 < rows <= SERIES * days + 2 * page
