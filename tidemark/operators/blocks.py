"""Gap filling and features with a series cut into blocks of days.

``panel.gap_fill`` and ``features.features`` give a series to one task. That is
right for daily data; a series with many more rows needs several tasks. Here a
block of days is the unit: it holds its own rows, those of the look-back before
it, and one head row with the values carried in from everything earlier. Heads
come from one row per series and block, so only those are ever ordered along a
whole series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions.windows import last_known, per_series
from tidemark.operators import features as feat
from tidemark.operators.panel import bounds

BLOCK = "block"


def block_of(day: Column, size: int) -> Column:
    """Number of the block that a day is in; blocks have ``size`` days and start at 1970-01-01."""
    return F.floor(F.unix_date(day) / size).cast("int")


def block_start(block: Column, size: int) -> Column:
    return F.date_from_unix_date((block * size).cast("int"))


def block_end(block: Column, size: int) -> Column:
    """The last day of a block."""
    return F.date_from_unix_date(((block + 1) * size - 1).cast("int"))


def last_values(columns: Sequence[str], date: str = S.DATE) -> list[Column]:
    """Aggregates: the latest value of each column that is not NULL, combined before the shuffle."""
    return [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(date))).alias(c) for c in columns]


def with_look_back(rows: DataFrame, size: int, halo: int, *, date: str = S.DATE) -> DataFrame:
    """Each row in its own block and, within ``halo`` days of the next block's start, in that one too."""
    if not 0 < halo <= size:
        raise ValueError("a block is at least as long as the look-back")
    own = block_of(F.col(date), size)
    late = F.unix_date(F.col(date)) >= (own + 1) * size - halo
    return rows.withColumn(BLOCK, F.explode(F.when(late, F.array(own, own + 1)).otherwise(F.array(own))))


def fill_blocks(
    rows: DataFrame,
    heads: DataFrame,
    *,
    zero: Sequence[str] = tuple(S.ZERO_FILLED),
    carry: Sequence[str] = tuple(S.FORWARD_FILLED),
    series: str = S.SERIES,
    date: str = S.DATE,
) -> DataFrame:
    """Every day of every block that has a head, without NULLs.

    ``heads`` has a row per series and block: the first and last day to fill
    (``from_day``, ``to_day``) and the carried values before the first. ``rows``
    are panel rows with their block; those without a head are left out. One
    shuffle, by series and block.
    """
    types = {f.name: f.dataType for f in rows.schema}
    empty = lambda c, kind: F.lit(None).cast(kind).alias(c)
    head = heads.select(
        series, BLOCK, empty(date, "date"), *[empty(c, types[c]) for c in zero], *carry, "from_day", "to_day",
        F.lit(True).alias("_head"),
    )
    body = rows.select(
        series, BLOCK, date, *zero, *carry, empty("from_day", "date"), empty("to_day", "date"),
        F.lit(False).alias("_head"),
    )
    w = Window.partitionBy(series, BLOCK).orderBy(F.desc("_head"), date)
    known = head.unionByName(body).withColumns({
        **{c: last_known(w, c) for c in carry},
        "_from": last_known(w, "from_day"),
        "_to": last_known(w, "to_day"),
        "_next": F.lead(date).over(w),
    }).where("_from IS NOT NULL")
    start = F.coalesce(F.col(date), F.col("_from"))
    # A head's own date is NULL, which greatest leaves out; its days may be none.
    stop = F.greatest(F.col(date), F.coalesce(F.date_sub("_next", 1), F.col("_to")))
    days = known.withColumn("_day", F.explode(F.when(start <= stop, F.sequence(start, stop))))
    own = F.col("_day") == F.col(date)
    return days.select(
        series,
        F.col("_day").alias(date),
        *[F.coalesce(F.when(own, F.col(c)), F.lit(0)).alias(c) for c in zero],
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in carry],
        BLOCK,
    )


def block_features(filled: DataFrame, size: int, *, date: str = S.DATE, **options) -> DataFrame:
    """Features of filled blocks, the look-back's rows left out; the block stays as the last column."""
    out = feat.features(filled, date=date, within=(BLOCK,), **options)
    return out.where(F.col(date) >= block_start(F.col(BLOCK), size))


def features_blocked(
    panel: DataFrame,
    keys: DataFrame,
    *,
    size: int = 90,
    halo: int = feat.LOOK_BACK,
    series: str = S.SERIES,
    date: str = S.DATE,
    **options,
) -> DataFrame:
    """What ``features(gap_fill(panel, keys))`` gives, with blocks of ``size`` days as groups.

    ``halo`` is the longest look-back in days. A task's group has at most
    ``size + halo`` days; ``halo / size`` of the rows move twice. An empty panel
    gives no rows; a key without rows gets zeros; rows that share a series and
    day stay, as there. Rows without a day are left out.
    """
    carry = tuple(S.FORWARD_FILLED)
    low, high = bounds(panel, date)
    rows = panel.where(F.col(date).isNotNull()).select(series, date, *S.ZERO_FILLED, *carry)
    # The first block whose look-back starts after a row is the first that needs it in its head.
    needed = block_of(F.date_add(date, halo), size) + 1
    ends = rows.groupBy(series, needed.alias(BLOCK)).agg(*last_values(carry, date))
    spans = keys.select(series, F.explode(F.sequence(block_of(low, size), block_of(high, size))).alias(BLOCK))
    w = per_series(series, BLOCK)
    heads = spans.join(ends, [series, BLOCK], "left").select(
        series,
        BLOCK,
        *[last_known(w, c).alias(c) for c in carry],
        F.greatest(low, F.date_sub(block_start(F.col(BLOCK), size), halo)).alias("from_day"),
        F.least(high, block_end(F.col(BLOCK), size)).alias("to_day"),
    )
    filled = fill_blocks(with_look_back(rows, size, halo, date=date), heads, series=series, date=date)
    return block_features(filled, size, series=series, date=date, **options).drop(BLOCK)
