"""Window expressions over one series ordered by day.

A series never has more rows than the calendar has days, because raw rows are
aggregated to (series, day) first. So the group a window task sees is bounded
by the date range, however many raw rows one series contributes.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.schemas import DATE, SERIES


def per_series(series: str = SERIES, date: str = DATE, *within: str) -> WindowSpec:
    return Window.partitionBy(series, *within).orderBy(date)


def rolling_mean(w: WindowSpec, column: str, days: int, digits: int | None = 2) -> Column:
    """Mean of the last ``days`` rows; shorter at the head of the series."""
    mean = F.avg(column).over(w.rowsBetween(1 - days, Window.currentRow))
    return mean if digits is None else F.round(mean, digits)


def lagged(w: WindowSpec, column: str, rows: int) -> Column:
    return F.lag(column, rows).over(w)


def last_known(w: WindowSpec, column: str) -> Column:
    """Own value, or the latest non-NULL one before it."""
    return F.last(column, ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def running_sum(w: WindowSpec, column: str | Column) -> Column:
    return F.sum(column).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
