"""Exact duplicates by a tree merge of sorted digest runs.

Every row becomes a digest with its identifier. Rows are dealt over ``lanes``
by row number, whatever their digest, so that copies of one text are spread
evenly. A lane's rows form one sorted run with an entry per digest. In each
round ``fan_in`` neighbouring runs meet and are merged in digest order, and an
entry keeps the best identifier and the number of its copies; the runs of a
round are cut by (lane, digest), so no task holds a whole run. After
``log(lanes) / log(fan_in)`` rounds one run is left. The decision then goes
down the same tree: a join's key has the lane in it until the last step, so no
key ever has more than ``fan_in`` rows, or the rows of one text in one lane.

An entry is verified at every level: rows fall together only if SHA-256, length
and a second, independent 64-bit hash of the text all agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, col, own, settled

KEY = ["digest", "length", "check"]


def _keyed(df: DataFrame, text_col: str) -> DataFrame:
    text = ascii_lower(col(text_col))
    return df.select(
        "*",
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.octet_length(text).alias("length"),
        F.xxhash64(text, F.lit(1)).alias("check"),
    )


def decide(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    keep: str = "largest",
    lanes: int = 256,
    fan_in: int = 16,
) -> DataFrame:
    """For each row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as
    empty. ``keep`` is "largest" or "smallest" identifier. A null identifier
    stays only if all of its group are null. Of rows that repeat the kept
    identifier one is kept. An empty table gives an empty result; other columns
    are not read.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep: {keep!r}")
    rows = _keyed(docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text")), "text")
    rows = rows.drop("text").withColumn("row", F.monotonically_increasing_id())
    rows = settled(rows.withColumn("lane", F.pmod(F.xxhash64("row"), F.lit(lanes)).cast("int")))

    # Nulls are the least of a struct's values; for the smallest the id's rank is turned round.
    best = F.struct("doc_id", "row")
    if keep == "smallest":
        best = F.struct(F.isnull("doc_id").alias("none"), "doc_id", "row")
    pick = F.max if keep == "largest" else F.min

    run = rows.groupBy("lane", *KEY).agg(pick(best).alias("best"), F.count(F.lit(1)).alias("copies"))
    levels = []
    while lanes > 1:
        lanes = -(-lanes // fan_in)
        run = settled(run.withColumn("up", F.floor(F.col("lane") / fan_in).cast("int")))
        levels.append(run.select("lane", *KEY, "up"))
        run = run.groupBy(F.col("up").alias("lane"), *KEY).agg(
            pick("best").alias("best"), F.sum("copies").alias("copies")
        )

    decided = run
    for level in reversed(levels):
        above = decided.withColumnRenamed("lane", "up")
        decided = level.join(above, ["up", *KEY]).select("lane", *KEY, "best", "copies")

    return rows.join(decided, ["lane", *KEY]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        F.col("copies").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def survivors(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """The rows of ``docs`` that stay, one per text, with the columns of ``docs``.

    Null texts count as empty, so one of all null and empty texts stays. A null
    identifier stays only if its text has no other; of rows that repeat the kept
    identifier and text one stays. An empty table gives none. Columns of any name pass through.
    """
    kept = decide(docs, id_col, text_col, **options).where("kept")
    name, digest, length, check = own(docs, "name", *KEY)
    # Identifier and digest as one key, since a null identifier has to find itself as well.
    named = lambda c: F.xxhash64(c, F.isnull(c))
    kept = kept.select(
        named(F.col("doc_id")).alias(name),
        F.col("doc_id").alias(check),
        F.unhex("text_sha256").alias(digest),
    )
    text = ascii_lower(col(text_col))
    found = docs.withColumns({name: named(col(id_col)), digest: F.unhex(F.sha2(text, 256))})
    found = found.join(kept, [name, digest]).where(col(id_col).eqNullSafe(F.col(check)))
    # Rows that repeat both identifier and text are still together here.
    return found.dropDuplicates([name, digest]).select(*(col(c) for c in docs.columns))
