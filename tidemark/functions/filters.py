"""Row filters shared by several operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date as Date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import DATE, SERIES


def as_date(value: str | Date | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def latest(df: DataFrame, date: str = DATE) -> Column:
    """The greatest day of ``df`` as a scalar subquery (evaluated once per query)."""
    return df.agg(F.max(date)).scalar()


def before(day: Column, n: int, unit: str = "day") -> Column:
    """``n`` days or months before ``day``; months clip to the month's last day."""
    if unit == "day":
        return F.date_sub(day, n)
    if unit == "month":
        return F.add_months(day, -n)
    raise ValueError(f"unit must be 'day' or 'month', not {unit!r}")


def cutoff(df: DataFrame, n: int, unit: str = "day", date: str = DATE) -> Column:
    """``n`` days or months before the latest day of ``df``, as a scalar subquery.

    The subtraction happens inside the subquery: the filter then compares a
    column with a plain value, which the Parquet scan can use to skip data.
    Two different cut-offs over one table would be merged into one subquery of
    two values and lose that; derive the second from the first instead.
    """
    return df.agg(before(F.max(date), n, unit)).scalar()


def trailing(
    df: DataFrame,
    n: int,
    unit: str = "day",
    *,
    inclusive: bool = False,
    anchor: DataFrame | None = None,
    date: str = DATE,
) -> DataFrame:
    """Rows after the latest day less ``n`` (or from that day on, if ``inclusive``).

    The latest day is that of ``anchor``, by default of ``df`` itself.
    """
    cut = cutoff(df if anchor is None else anchor, n, unit, date)
    return df.filter(F.col(date) >= cut if inclusive else F.col(date) > cut)


def leading(
    df: DataFrame,
    n: int,
    unit: str = "day",
    *,
    anchor: DataFrame | None = None,
    date: str = DATE,
) -> DataFrame:
    """The complement of an exclusive ``trailing``: rows up to that day."""
    return df.filter(F.col(date) <= cutoff(df if anchor is None else anchor, n, unit, date))


def since_first_end(
    df: DataFrame, days: int = 0, *, series: str = SERIES, date: str = DATE
) -> DataFrame:
    """Rows from ``days`` before the earliest of the series' last days on.

    Nothing that counts back from a series' own last day lies before that. On a
    stored table finding it takes two columns, and the rest of the history is
    skipped by the scan.
    """
    ends = df.groupBy(series).agg(F.max(date).alias("_end"))
    return df.filter(F.col(date) >= ends.agg(F.date_sub(F.min("_end"), days)).scalar())


def date_between(
    df: DataFrame,
    low: str | Date | None = None,
    high: str | Date | None = None,
    date: str = DATE,
) -> DataFrame:
    """Rows with low <= date <= high; an open end is None."""
    if low is not None:
        df = df.filter(F.col(date) >= as_date(low))
    if high is not None:
        df = df.filter(F.col(date) <= as_date(high))
    return df


def without_series(df: DataFrame, names: Iterable[str], series: str = SERIES) -> DataFrame:
    names = list(names)
    return df.filter(~F.col(series).isin(names)) if names else df


def only_values(df: DataFrame, column: str, values: Sequence[str] | None) -> DataFrame:
    """Rows whose ``column`` is in ``values``; None keeps all."""
    return df if values is None else df.filter(F.col(column).isin(list(values)))


def select_available(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    have = set(df.columns)
    return df.select(*[c for c in columns if c in have])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The row with the greatest ``order`` of each key, by aggregation.

    One ``max_by`` per column, so buffers are of fixed width and both steps hash:
    nothing is sorted, and a key with very many rows sends one row per task
    through the shuffle. ``order`` is unique within a key.
    """
    rest = [c for c in df.columns if c not in keys and c != order]
    latest = [F.max_by(c, order).alias(c) for c in rest]
    return df.groupBy(*keys).agg(F.max(order).alias(order), *latest).select(*df.columns)
