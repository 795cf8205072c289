"""Document fingerprints by winnowing, in Spark's own functions.

A text's words are hashed, the hashes of ``2 ** gram`` following words are
rolled into one by a cyclic shift, and of each window of ``2 ** window`` grams
the least hash is kept with its position, the rightmost among equals. Any run
of ``2 ** gram + 2 ** window - 1`` words that two texts share therefore gives
them a common hash. A run of over ``PIECE`` code points without white space is no
word; in it every code point counts as one, so that a passage is found at any offset.

Rolling is done by doubling: the hashes of 2n words come from those of n words
and the same array n places on; window minima likewise. Each step is one
``zip_with`` over the array, so a text of any length costs a constant number of
passes. Hash and position share one long (hash above, position counted down
below), so that the least long is the least hash, and the rightmost if equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, col, own, settled, whole

#: Bits of a long that hold the position; the hash has the other 32, the sign none.
PLACE = 31
LAST = (1 << PLACE) - 1
#: Code points of the longest word.
PIECE = 32
#: A word, or a code point of a run that is longer than one.
TOKEN = f"(?<!{WORD[:-1]}){WORD[:-1]}{{1,{PIECE}}}(?!{WORD[:-1]})|{WORD[:-1]}"


def _let(value: Column, body) -> Column:
    """``body(value)``, with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _doubling(step: int, join):
    """For arrays longer than ``step``: ``join`` of each element and the one ``step`` places on."""

    def body(values: Column) -> Column:
        left = F.slice(values, 1, F.size(values) - step)
        return F.zip_with(left, F.slice(values, F.lit(step + 1), F.size(values) - step), join)

    return body


def _rolled(step: int):
    """32-bit cyclic shift of the left gram by its length, mixed with the right one."""
    mask = F.lit((1 << 32) - 1)

    def join(x: Column, y: Column) -> Column:
        turned = F.shiftleft(x, step).bitwiseOR(F.shiftright(x, 32 - step)).bitwiseAND(mask)
        return turned.bitwiseXOR(y)

    return join


def selected(text: Column, gram: int = 2, window: int = 2) -> Column:
    """The kept (hash, position) pairs as longs in order of position; empty for a text without words.

    A text with fewer words than a gram has one gram of all its words; one with
    no more grams than a window has a single window.
    """
    hashed = lambda x: F.shiftrightunsigned(F.xxhash64(x), 32)
    placed = lambda h, i: F.shiftleft(h, PLACE).bitwiseOR(F.lit(LAST) - i.cast("bigint"))

    def grams(words: Column) -> Column:
        values = F.transform(words, hashed)
        for k in range(gram):
            values = _let(values, _doubling(1 << k, _rolled(1 << k)))
        return F.transform(values, placed)

    def minima(values: Column) -> Column:
        for k in range(window):
            values = _let(values, _doubling(1 << k, lambda x, y: F.least(x, y)))
        return F.array_distinct(values)

    words = F.regexp_extract_all(whole(text), F.lit(TOKEN), 0)
    return _let(
        words,
        lambda w: F.when(F.size(w) == 0, F.array().cast("array<bigint>"))
        .when(F.size(w) < (1 << gram), F.array(placed(hashed(w), F.lit(0))))
        .otherwise(
            _let(
                grams(w),
                lambda g: F.when(F.size(g) <= (1 << window), F.array(F.array_min(g))).otherwise(minima(g)),
            )
        ),
    )


def hashes(picks: Column) -> Column:
    """The set of hashes among kept pairs, as integers: the hash less 2 ** 31."""
    return F.array_distinct(F.transform(picks, lambda p: (F.shiftright(p, PLACE) - F.lit(1 << 31)).cast("int")))


def pairs(picks: Column) -> Column:
    """Kept pairs as structs; the position counts words from 0."""
    return F.transform(
        picks,
        lambda p: F.struct(
            F.shiftright(p, PLACE).alias("hash"),
            (F.lit(LAST) - p.bitwiseAND(F.lit(LAST))).alias("position"),
        ),
    )


def fingerprints(docs: DataFrame, text_col: str = "text", name: str = "fingerprint", **sizes) -> DataFrame:
    """``docs`` with an array of (hash, position), replacing a column of that name.

    Null texts count as empty and have an empty array.
    """
    (picks,) = own(docs, "picks")
    rest = [c for c in docs.columns if c.lower() != name.lower()]
    out = docs.withColumn(picks, selected(col(text_col), **sizes))
    return out.select(*(col(c) for c in rest), pairs(F.col(picks)).alias(name))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two sets; 1 if both are empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(
        both / (F.size(a) + F.size(b) - both)
    )


def digest(picks: Column) -> Column:
    return F.md5(F.array_join(F.transform(picks, lambda p: F.hex(F.shiftright(p, PLACE))), " "))


def following(ids: DataFrame) -> DataFrame:
    """(id, ...) of distinct ids -> with ``next``: the id that follows in descending order, the first after the last.

    Ids are cut into ranges, each ordered by itself; the first id of the next
    range follows the last of a range.
    """
    parts = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = ids.repartitionByRange(parts, F.col("id").desc())
    ranged = settled(ranged.withColumn("part", F.spark_partition_id()))
    inside = Window.partitionBy("part").orderBy(F.col("id").desc())
    # A row per range: few, whatever the number of ids.
    order = Window.orderBy("from_part")
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = ranged.groupBy(F.col("part").alias("from_part")).agg(F.max("id").alias("head"))
    firsts = firsts.select(
        "from_part", F.coalesce(F.lead("head").over(order), F.first("head").over(every)).alias("then")
    )
    out = ranged.withColumn("inside", F.lead("id").over(inside))
    out = out.join(firsts, F.col("part") == F.col("from_part"))
    return out.withColumn("next", F.coalesce("inside", "then")).drop("part", "from_part", "inside", "then")


def edited(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, gram: int = 2, window: int = 2
) -> DataFrame:
    """Fingerprints of each text, of its edited text, and of the next document's, by row.

    The last third (floor) of a text's code points is replaced by as many first
    ones of the next document in descending order of the integer identifier.
    Gives doc_id, text, edited, picks, hashes, edited_picks, next_hashes. Null texts are
    empty; null identifiers (and the least long, which is given back as null) are the least. Rows that share an identifier follow
    the same document and count as one, with the greatest of their texts, for
    the one before. A single document follows itself. An empty table gives no
    rows; other columns are not read.
    """
    key = F.coalesce(col(id_col).cast("bigint"), F.lit(-(1 << 63)))
    need = F.floor(F.length(whole(col(text_col))) / 3).cast("int")
    ids = docs.select(key.alias("id"), need.alias("need")).groupBy("id").agg(F.max("need").alias("need"))
    before = following(ids).select(F.col("id").alias("before"), "need", F.col("next").alias("follows"))
    # Both joins below read all three columns and no other, and so share one shuffle of the texts. The set of
    # hashes moves along; a row's kept pairs, twice as large, are made again where they are used.
    texts = docs.select(
        key.alias("id"), whole(col(text_col)).alias("text"), hashes(selected(col(text_col), gram, window)).alias("hashes")
    )
    after = texts.join(before, F.col("id") == F.col("follows")).select(
        "id", "before", F.struct(F.expr("substring(text, 1, need)").alias("start"), "hashes").alias("next")
    )
    after = after.groupBy("id").agg(F.max("before").alias("before"), F.max("next").alias("next"))
    rows = texts.join(after.drop("id"), F.col("id") == F.col("before"))
    cut = F.expr("length(text) - cast(floor(length(text) / 3) as int)")
    rows = rows.withColumn("kept", cut)
    rows = rows.withColumn(
        "edited", F.expr("concat(substring(text, 1, kept), substring(next.start, 1, length(text) - kept))")
    )
    return rows.select(
        F.nullif("id", F.lit(-(1 << 63))).alias("doc_id"), "text", "edited",
        selected(F.col("text"), gram, window).alias("picks"), "hashes",
        selected(F.col("edited"), gram, window).alias("edited_picks"), F.col("next.hashes").alias("next_hashes"),
    )
