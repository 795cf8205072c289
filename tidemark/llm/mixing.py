"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A source's target in words is met by whole passes over the source, and the
fraction that is left by a weighted sample without replacement: each document
draws an exponential key scaled by its quality weight, and documents are taken
in the order of their keys until the budget is spent.

The prefix sum over a source is cut in two, so that no task holds a source: a
histogram of words per (source, key bucket), which finds the bucket where the
budget ends, and the exact order inside that bucket alone. Buckets are equal
parts of the key's distribution at weight 1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, col, own, settled, whole

#: Signs that are rare in prose.
SIGNS = "#$%&*+/<=>@^_`{|}~!"


def quality_weight(text: Column) -> Column:
    """Between 0 and 1: falls with the share of signs that prose seldom has."""
    n = F.length(whole(text))
    signs = n - F.length(F.translate(whole(text), SIGNS, ""))
    return F.lit(1.0) / (F.lit(1.0) + F.lit(20.0) * signs / F.greatest(n, F.lit(1)))


def exponential_key(doc_id: Column, weight: Column, seed: int) -> Column:
    """-ln(u) / weight, where u in (0, 1) hangs on the identifier and the seed only."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), doc_id.cast("string")))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(16**13))
    return -F.log(u) / weight


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """source, source_size -> target, a row per source.

    Sources in order of code points, null last, weigh ``weights`` in turn and
    share ``share`` of all words. No target is above ``most`` times its source:
    what is above goes to the others by weight. The sources that reach their
    bound are those with the least bound for their weight, so running sums in
    that order give what repeated resharing would end with.
    """
    everything = Window.partitionBy()
    named = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*(F.lit(float(w)) for w in weights))
    rows = sizes.withColumn("place", F.row_number().over(named) - 1)
    rows = rows.withColumn("weight", F.get(turn, F.col("place") % len(weights)))
    rows = rows.withColumn("bound", F.lit(float(most)) * F.col("source_size"))
    rows = rows.withColumn("budget", F.lit(float(share)) * F.sum("source_size").over(everything))
    by_bound = Window.orderBy(F.col("bound") / F.col("weight"), "place")
    before = F.coalesce(F.sum("bound").over(by_bound.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(by_bound.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rows = rows.withColumns({"before": before, "rest": rest})
    rows = rows.withColumn("full", F.col("bound") * F.col("rest") <= F.col("weight") * (F.col("budget") - F.col("before")))
    left = F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("bound"))).over(everything), F.lit(0.0))
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything)
    rows = rows.withColumns({"left": left, "open_weight": open_weight})
    target = F.when(F.col("full"), F.col("bound")).otherwise(F.col("weight") * F.col("left") / F.col("open_weight"))
    return rows.select("source", "source_size", target.alias("target"))


def plan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    *,
    weights: Sequence[float] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    most: int = 2,
    quality=quality_weight,
    seed: int = 42,
    buckets: int = 4096,
) -> DataFrame:
    """``docs`` with size, source_size, target and times (how often the mix takes the row).

    Size is the number of words, 0 for null. ``times`` is the number of whole
    passes, and one more for documents before the cut in the order of
    (key, identifier, size); rows alike in all three stand or fall together.
    The cut is where the words come nearest to the target. A null identifier
    has a key like any other value. Empty documents are in every whole pass and
    never move a cut. An empty table gives no rows. Columns of ``docs`` that
    clash with the four new ones are replaced.
    """
    size = F.regexp_count(whole(col(text_col)), F.lit(WORD)).cast("long")
    key = exponential_key(F.coalesce(col(id_col).cast("string"), F.lit("")), quality(col(text_col)), seed)
    facts = docs.select(
        col(source_col).alias("source"),
        F.coalesce(col(id_col).cast("string"), F.lit("")).alias("id"),
        size.alias("size"),
        key.alias("key"),
    )
    bucket = F.floor((F.lit(1.0) - F.exp(-F.col("key"))) * buckets).cast("int")
    facts = settled(facts.withColumn("bucket", F.least(bucket, F.lit(buckets - 1))))

    counted = settled(facts.groupBy("source", "bucket").agg(F.sum("size").alias("words")))
    sources = targets(
        counted.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most
    )
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    sources = sources.withColumn("passes", passes.cast("long"))
    sources = settled(sources.withColumn("part", F.col("target") - F.col("passes") * F.col("source_size")))

    # Distinct names on both sides: a null source has to find itself in every join.
    upto = Window.partitionBy("source").orderBy("bucket")
    budget = sources.select(F.col("source").alias("of"), "part")
    ends = (
        counted.withColumn("upto", F.sum("words").over(upto))
        .join(budget, F.col("source").eqNullSafe(F.col("of")))
        .where("upto > part")
        .groupBy(F.col("source").alias("end_of"))
        .agg(F.min(F.struct("bucket", (F.col("part") - F.col("upto") + F.col("words")).alias("room"))).alias("end"))
        .select("end_of", F.col("end.bucket").alias("end_bucket"), F.col("end.room").alias("room"))
    )
    inside = facts.join(
        ends, F.col("source").eqNullSafe(F.col("end_of")) & (F.col("bucket") == F.col("end_bucket"))
    )
    alike = inside.groupBy(F.col("source").alias("cut_of"), "room", "key", "id", "size").agg(
        F.sum("size").alias("words")
    )
    order = Window.partitionBy("cut_of").orderBy("key", "id", "size")
    cut = (
        alike.withColumn("upto", F.sum("words").over(order))
        .where("upto - words / 2.0 <= room")
        .groupBy("cut_of")
        .agg(F.max(F.struct("key", "id", "size")).alias("cut"))
    )
    cuts = sources.join(ends, F.col("source").eqNullSafe(F.col("end_of")), "left")
    cuts = cuts.join(cut, F.col("source").eqNullSafe(F.col("cut_of")), "left")
    cuts = settled(
        cuts.select("source", "source_size", "target", "passes", F.col("end_bucket").alias("bucket"), "cut")
    )

    names = ("source", "source_size", "target", "passes", "bucket", "cut", "size", "key", "id")
    new = dict(zip(names, own(docs, *(f"_{n}" for n in names)), strict=True))
    cuts = cuts.select(*(F.col(n).alias(new[n]) for n in names[:6]))
    rows = docs.withColumns({new["size"]: size, new["key"]: key, new["id"]: F.coalesce(col(id_col).cast("string"), F.lit(""))})
    rows = rows.join(cuts, col(source_col).eqNullSafe(F.col(new["source"])))
    at = F.least(F.floor((F.lit(1.0) - F.exp(-F.col(new["key"]))) * buckets).cast("int"), F.lit(buckets - 1))
    here = F.struct(F.col(new["key"]).alias("key"), F.col(new["id"]).alias("id"), F.col(new["size"]).alias("size"))
    more = F.when(at < F.col(new["bucket"]), 1).when(
        (at == F.col(new["bucket"])) & F.col(new["cut"]).isNotNull() & (here <= F.col(new["cut"])), 1
    ).otherwise(0)
    fresh = {
        "size": F.col(new["size"]),
        "source_size": F.col(new["source_size"]),
        "target": F.col(new["target"]),
        "times": F.col(new["passes"]) + more,
    }
    kept = [c for c in docs.columns if c.lower() not in fresh]
    return rows.select(*(col(c) for c in kept), *(v.alias(k) for k, v in fresh.items()))


def mix(docs: DataFrame, *args, **options) -> DataFrame:
    """The mix itself: each row as often as ``plan`` takes it, with the columns of ``docs``.

    Null and empty texts, of size 0, come once for every whole pass; a null source
    is one of the sources, the last. Repeated rows are taken each for itself. An empty table
    gives none. Columns of any name pass through.
    """
    (nth,) = own(docs, "nth")
    clash = [c for c in docs.columns if c.lower() in ("size", "source_size", "target", "times")]
    hidden = dict(zip(clash, own(docs, *(f"_{c}" for c in clash)), strict=True))
    planned = plan(docs.withColumnsRenamed(hidden), *args, **options)
    rows = planned.where("times > 0").withColumn(nth, F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    return rows.select(*(col(hidden.get(c, c)).alias(c) for c in docs.columns))
