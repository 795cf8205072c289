"""Names that differ in spelling between two sources, proposed as rows of the key map.

Names are made alike first: lower case, letters and digits only, words in order of
the alphabet, so that ``Korea, South`` and ``South Korea`` are one. Others are
compared by edit distance. Two names within the distance allowed have a known
number of pairs of neighbouring letters in common. So a name need only look under
its rarest pairs: with all but that many of its pairs left out, every partner still
shows up. No pair of names is compared that shares none of these, and frequent
letter pairs, which most names have, are hardly ever used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def plain(name: Column) -> Column:
    """The name in lower case, its words of letters and digits in order."""
    words = F.filter(F.split(F.lower(name), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.array_join(F.array_sort(words), " ")


def likeness(a: Column, b: Column) -> Column:
    """1 less the edit distance by the longer name's length."""
    longest = F.greatest(F.length(a), F.length(b), F.lit(1))
    return F.lit(1.0) - F.levenshtein(a, b) / longest


def _grams(names: DataFrame, least: float) -> DataFrame:
    """(plain, key): the rarest pairs of letters under which a partner must be found.

    A repeated pair is numbered, so that shared pairs are counted with their
    repeats. With the longer name's length L, at most k = (1 - least) * L edits
    each spoil two of its L + 1 pairs, so L + 1 - 2k are shared at least.
    """
    padded = F.concat(F.lit("\x02"), "plain", F.lit("\x03"))
    at = F.sequence(F.lit(1), F.length("plain") + 1)
    pairs = names.select("plain", F.explode(F.transform(at, lambda i: F.substring(padded, i, F.lit(2)))).alias("pair"))
    nth = F.row_number().over(Window.partitionBy("plain", "pair").orderBy("pair"))
    keyed = pairs.select("plain", F.concat_ws("#", "pair", nth).alias("key"))
    often = keyed.groupBy("key").agg(F.count("*").alias("names_with"))
    place = F.row_number().over(Window.partitionBy("plain").orderBy("names_with", "key"))
    length = F.length("plain")
    shared = F.greatest(F.ceil(length + 1 - F.lit(2 * (1 - least)) * length - F.lit(1e-9)), F.lit(1))
    return keyed.join(often, "key").withColumn("place", place).where(F.col("place") <= length + 2 - shared).select(
        "plain", "key"
    )


def name_suggest(
    left: DataFrame, right: DataFrame, left_col: str, right_col: str, least: float = 0.75
) -> DataFrame:
    """(source_name, second_name, likeness) of names that are not equal but alike by ``least`` or more.

    Names that occur in both sources as they are need no suggestion and are
    left out. Null names and names without letters or digits have no partner.
    ``least`` is 0.5 or more; nothing that is so alike is missed.
    """
    if not 0.5 <= least <= 1:
        raise ValueError("least lies between 0.5 and 1")
    one = left.select(F.col(left_col).cast("string").alias("name")).where("name IS NOT NULL").distinct()
    two = right.select(F.col(right_col).cast("string").alias("name")).where("name IS NOT NULL").distinct()
    alone = lambda a, b: a.join(b, "name", "left_anti").withColumn("plain", plain(F.col("name"))).where("plain != ''")
    ours, theirs = alone(one, two), alone(two, one)
    # Both sides' pairs are ordered by how frequent they are in the two together.
    every = ours.select("plain").union(theirs.select("plain")).distinct()
    keys = _grams(every, least)
    here = keys.join(ours.select("plain").distinct(), "plain", "left_semi")
    there = keys.join(theirs.select("plain").distinct(), "plain", "left_semi")
    pairs = here.join(there.select(F.col("plain").alias("other"), "key"), "key").select("plain", "other").distinct()
    alike = pairs.withColumn("likeness", F.round(likeness(F.col("plain"), F.col("other")), 6)).where(F.col("likeness") >= least)
    mine = ours.select(F.col("name").alias("source_name"), F.col("plain"))
    others = theirs.select(F.col("name").alias("second_name"), F.col("plain").alias("other"))
    return alike.join(mine, "plain").join(others, "other").select("source_name", "second_name", "likeness")
