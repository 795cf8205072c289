"""Aggregates that stay distributed when a plain built-in would not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.layers import settled


def conditional_sum(value: str, condition: Column) -> Column:
    return F.sum(F.when(condition, F.col(value)).otherwise(F.lit(0)))


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def rounded_mean(x: Column, digits: int) -> Column:
    """The mean of ``x``, rounded half away from 0; the order of addition decides nothing.

    Values are added as decimals of nine digits. A mean that lies just between
    two results, as those of values of two digits often do, is found exactly; a
    sum of doubles falls on either side of it. Where such decimals do not hold a
    value or the sum, doubles are added.
    """
    part = x.try_cast("decimal(28,9)")
    total = F.when(F.count(part) == F.count(x), F.sum(part).try_cast("decimal(30,9)"))
    exact = total / F.nullif(F.count(x), F.lit(0)).try_cast("decimal(10,0)")
    return F.coalesce(F.round(exact, digits).cast("double"), F.round(F.avg(x), digits))


def text_pages(
    df: DataFrame,
    key: str,
    item: Column,
    order: Column,
    separator: str,
    page_size: int,
) -> DataFrame:
    """All ``item`` texts in ``order``, ``page_size`` on each page, pages numbered from 0.

    The pages joined in order are the whole listing at any size. Rows are cut
    into ranges of (order, key), and a position is the row's number inside its
    range plus the rows of all ranges before it; so neither equal orders nor
    names that begin alike gather in one task, and only the counts, a row per
    range, do. Ties are in order of ``key``, which must be unique. An empty
    ``df`` has no page.
    """
    rows = df.select(order.alias("_order"), F.col(key).alias("_key"), item.alias("_item"))
    # Written once: the ranges come from a sample, and both uses below must see the same.
    rows = settled(rows.repartitionByRange("_order", "_key").withColumn("_bucket", F.spark_partition_id()))
    before = Window.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(F.col("_bucket").alias("_of")).agg(F.count("*").alias("_n"))
    starts = counts.select("_of", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_bucket").orderBy("_order", "_key")
    placed = rows.join(starts, F.col("_bucket").eqNullSafe(F.col("_of"))).withColumn(
        "_place", F.col("_start") + F.row_number().over(inside) - 1
    )
    paged = placed.groupBy(F.floor(F.col("_place") / page_size).alias("page")).agg(
        F.sort_array(F.collect_list(F.struct("_place", "_item"))).alias("_list")
    )
    return paged.select("page", F.array_join(F.col("_list._item"), separator).alias("listing"))


def exact_median(
    df: DataFrame, column: str, accuracy: int = 10_000, buckets: int = 1024
) -> DataFrame:
    """One-row frame with the interpolated median of ``column`` as ``median``.

    Built-in ``median`` gathers every distinct value in one task. Here an
    approximate percentile brackets the middle first (its rank error is at most
    rows/accuracy, and the bracket is four times that wide on either side). The
    bracket is cut into equal buckets, whose counts alone, a row per bucket, meet
    in one task; the order is made inside each bucket. The answer is exact.
    """
    data = df.select(F.col(column).alias("v")).filter("v is not null")
    margin = 4.0 / accuracy
    bounds = data.agg(
        F.percentile_approx("v", [0.5 - margin, 0.5 + margin], accuracy).alias("b"),
    )
    low = bounds.select(F.col("b")[0]).scalar()
    high = bounds.select(F.col("b")[1]).scalar()
    outside = data.agg(
        F.count("*").alias("n"), count_where(F.col("v") < low).alias("below")
    )
    n = outside.select("n").scalar()
    below = outside.select("below").scalar()
    # Ranks inside the bracket: rows of all buckets before, and the order in a bucket.
    part = (F.col("v") - F.col("low")) / (F.col("high") - F.col("low")) * buckets
    inside = (
        data.filter((F.col("v") >= low) & (F.col("v") <= high))
        .groupBy("v")
        .agg(F.count("*").alias("c"))
        .withColumns({"low": low, "high": high})
        .withColumn("bucket", F.when(F.col("high") > F.col("low"), F.floor(part)).otherwise(0))
    )
    starts = inside.groupBy(F.col("bucket").alias("of")).agg(F.sum("c").alias("c_all"))
    earlier = Window.orderBy("of").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("of", F.coalesce(F.sum("c_all").over(earlier), F.lit(0)).alias("start"))
    upto = F.sum("c").over(
        Window.partitionBy("bucket").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    middle = (
        inside.join(starts, F.col("bucket") == F.col("of"))
        .withColumn("last", upto + F.col("start") + below)
        .withColumn("first", F.col("last") - F.col("c") + 1)
    )
    holds_lower = (F.col("first") <= F.floor((n + 1) / 2)) & (F.col("last") >= F.floor((n + 1) / 2))
    holds_upper = (F.col("first") <= F.floor((n + 2) / 2)) & (F.col("last") >= F.floor((n + 2) / 2))
    return middle.agg(
        (
            (F.max(F.when(holds_lower, F.col("v"))) + F.max(F.when(holds_upper, F.col("v")))) / 2
        ).cast("double").alias("median")
    )
