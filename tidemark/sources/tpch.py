"""Epidemiological inputs derived from order and shipment tables.

nation = series, market segment = sub-region, order status = category. Orders
give the long table, shipped lines the second one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions.windows import running_sum

# --- fixed values: the category each order status of the benchmark's specification stands for.
STATUS_TYPES = {"F": "Confirmed", "O": "Deaths", "P": "Recovered"}
EXCLUDED = ("NATION_24",)
# --- end of fixed values


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "nation").select(
        F.col("n_nationkey"), F.col("n_name").alias(S.SERIES)
    )


def case_type() -> Column:
    """The status' category; a status without one, null too, is its own category."""
    status = F.col("o_orderstatus")
    out = status
    for known, name in STATUS_TYPES.items():
        out = F.when(status == known, name).otherwise(out)
    return out


def raw_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (series, sub-region, category) on every day the series has orders.

    Sub-regions are the customers' segments and categories those of the orders'
    statuses, as the tables have them, null included. Every cell of a series' day
    comes once more with 0, and the two are summed, so no grid is joined; the lists
    of segments and categories are scalars. Sums and running sums share one shuffle
    by (series, sub-region, category). Join strategies are left to
    the optimizer: customers grow with orders, so their size decides at run
    time, and a hot customer is split by the adaptive skew join.
    """
    orders = _table(spark, sf_dir, "orders").select(
        "o_custkey",
        case_type().alias("case_type"),
        F.col("o_orderdate").cast("date").alias(S.DATE),
        F.round("o_totalprice").cast("bigint").alias("amount"),
    )
    customer = _table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", F.col("c_mktsegment").alias("province_state")
    )
    segments = customer.agg(F.collect_set(F.struct("province_state"))).scalar()
    seen = orders.agg(F.collect_set(F.struct("case_type"))).scalar()
    known = F.array(*(F.struct(F.lit(t).alias("case_type")) for t in STATUS_TYPES.values()))
    confirmed = F.col("case_type") == STATUS_TYPES["F"]
    present = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(_nations(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(S.SERIES, S.DATE, "province_state", "case_type")
        .agg(F.sum("amount").alias("amount"), F.count("*").alias("n"))
        .select(
            S.SERIES, S.DATE, "province_state", "case_type",
            F.when(confirmed, F.col("amount")).otherwise(F.col("n")).alias("v"),
        )
    )
    days = present.select(S.SERIES, S.DATE).distinct()
    empty = days.select(S.SERIES, S.DATE, F.explode(segments).alias("segment")).select(
        S.SERIES, S.DATE, "segment.province_state", F.explode(F.array_union(known, seen)).alias("kind")
    )
    empty = empty.select(
        S.SERIES, S.DATE, "province_state", "kind.case_type", F.lit(0).cast("bigint").alias("v")
    )
    cell = [S.SERIES, "province_state", "case_type"]
    daily = present.unionByName(empty).repartition(*cell).groupBy(*cell, S.DATE).agg(F.sum("v").alias("v"))
    w = Window.partitionBy(*cell).orderBy(S.DATE)
    return daily.select(
        S.SERIES,
        "province_state",
        S.DATE,
        "case_type",
        running_sum(w, "v").alias("cases"),
        F.col("v").alias("difference"),
    )


def raw_vacc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (series, day) with shipments."""
    lines = _table(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        F.col("l_shipdate").cast("date").alias(S.DATE),
        (F.col("l_linenumber") == 1).cast("bigint").alias("first_line"),
        (F.col("l_linenumber") == 2).cast("bigint").alias("second_line"),
    )
    supplier = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    daily = (
        lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(_nations(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy(S.SERIES, S.DATE)
        .agg(
            F.count("*").alias("n"),
            F.sum("first_line").alias("n_first"),
            F.sum("second_line").alias("n_second"),
        )
    )
    w = Window.partitionBy(S.SERIES).orderBy(S.DATE)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    daily = daily.withColumns({
        "run": running_sum(w, "n"),
        "run_first": running_sum(w, "n_first"),
        "run_second": running_sum(w, "n_second"),
        "total": F.sum("n").over(whole),
    })
    share = lambda c: F.round(F.lit(100.0) * F.col(c) / F.col("total"), 2)
    return daily.select(
        S.SERIES,
        S.DATE,
        F.col("run").alias("total_vaccinations"),
        F.col("run_first").alias("people_vaccinated"),
        F.col("run_second").alias("people_fully_vaccinated"),
        F.col("n").alias("daily_vaccinations"),
        share("run").alias("people_vaccinated_per_hundred"),
        share("run_first").alias("people_fully_vaccinated_per_hundred"),
        F.round(F.lit(1e6) * F.col("n") / F.col("total"), 2).alias("daily_vaccinations_per_million"),
    )


def raw_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population and continent of each series."""
    customers = _table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(
        F.count("*").alias("population")
    )
    nation = _table(spark, sf_dir, "nation").alias("n")
    region = _table(spark, sf_dir, "region").alias("r")
    return (
        customers.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("n_name").alias(S.SERIES),
            F.col("r_name").alias("continentexp"),
            "population",
        )
    )


def nation_key_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("source_name"), F.col("n_name").alias("second_name")
    )
