"""One key holds a third of all rows; shuffles stay even and results whole."""

import pytest
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators.panel import pivot_daily
from tidemark.sources import tpch

ROWS = 300_000


@pytest.fixture(scope="module")
def skewed_dir(spark, tmp_path_factory):
    """Order tables in which customer 0 placed every third order."""
    root = tmp_path_factory.mktemp("skew")
    i = F.col("id")
    spark.range(25).select(
        i.cast("int").alias("n_nationkey"), F.concat(F.lit("NATION_"), i).alias("n_name")
    ).write.parquet(f"{root}/nation.parquet")
    spark.range(30_000).select(
        i.alias("c_custkey"),
        (i % 25).cast("int").alias("c_nationkey"),
        F.element_at(F.array(*map(F.lit, "ABCDE")), (i % 5 + 1).cast("int")).alias(
            "c_mktsegment"
        ),
    ).write.parquet(f"{root}/customer.parquet")
    spark.range(ROWS, numPartitions=8).select(
        F.when(i % 3 == 0, 0).otherwise(i % 30_000).alias("o_custkey"),
        F.element_at(F.array(*map(F.lit, "FOP")), (i % 3 + 1).cast("int")).alias("o_orderstatus"),
        (i % 1000).cast("double").alias("o_totalprice"),
        F.date_add(F.lit("1995-01-01").cast("date"), (i % 2000).cast("int"))
        .cast("timestamp_ntz")
        .alias("o_orderdate"),
    ).write.parquet(f"{root}/orders.parquet")
    return str(root)


@pytest.fixture
def small_partitions(spark):
    """Sizes scaled down so that the test data counts as large and skewed."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield
    for key in conf:
        spark.conf.unset(key)


def test_a_hot_customer_is_split_and_nothing_is_lost(spark, skewed_dir, small_partitions):
    long = tpch.raw_long(spark, skewed_dir)
    counted = long.filter("case_type <> 'Confirmed'").agg(F.sum("difference")).first()[0]
    assert counted == ROWS * 2 // 3  # statuses O and P count orders
    whole = long.agg(F.sum("cases").alias("s"))
    whole.collect()
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan


def test_a_hot_series_is_reduced_before_the_shuffle(spark, tmp_path):
    days, n = 50, 400_000
    i = F.col("id")
    spark.range(n, numPartitions=8).select(
        F.when(i % 3 == 0, "HOT").otherwise(F.concat(F.lit("S"), i % 200)).alias(S.SERIES),
        F.date_add(F.lit("2021-01-01").cast("date"), (i % days).cast("int")).alias(S.DATE),
        F.lit("Confirmed").alias("case_type"),
        F.lit(1).cast("bigint").alias("daily_value"),
        F.lit(1).cast("bigint").alias("cumulative_value"),
    ).write.parquet(f"{tmp_path}/long")
    daily = pivot_daily(spark.read.parquet(f"{tmp_path}/long"))
    assert daily.agg(F.sum("new_cases")).first()[0] == n
    per_series = daily.groupBy(S.SERIES).count().agg(F.max("count")).first()[0]
    assert per_series == days  # whatever the raw row count, a window sees the calendar only
