"""Scalar column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schemas import TIERS


def floor_zero(x: Column) -> Column:
    """Clip negatives to 0; NULL stays NULL."""
    return F.when(x < 0, F.lit(0).cast("bigint")).otherwise(x)


def floor_zero_round(x: Column) -> Column:
    """Clip negatives to 0 and round to a whole number (as DOUBLE)."""
    return F.round(F.when(x < 0, F.lit(0.0)).otherwise(x), 0)


def ratio(num: Column, den: Column) -> Column:
    """DOUBLE quotient, NULL where the denominator is 0 or NULL."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def pct(num: Column, den: Column, digits: int = 2) -> Column:
    """``num / den`` in percent, rounded; NULL unless the denominator is positive."""
    return F.when(den > 0, F.round(num.cast("double") / den.cast("double") * 100, digits))


def change_pct(current: Column, previous: Column, digits: int = 2) -> Column:
    """Percent change against ``previous``; NULL unless ``previous`` is positive."""
    return pct(current - previous, previous, digits)


def doubling_days(level: Column, earlier: Column, days: int) -> Column:
    """Days to double at the pace of the last ``days``; NULL without growth."""
    growth = F.ln(level.cast("double") / earlier.cast("double"))
    return F.when(
        (earlier > 0) & (level > earlier),
        F.round(F.lit(float(days)) * F.ln(F.lit(2.0)) / growth, 2),
    )


def tier(change: Column, high: float = 20, moderate: float = 5) -> Column:
    """Risk tier of a percent change; both cut-offs are exclusive."""
    names = dict(zip(("high", "moderate", "low"), TIERS))
    return (
        F.when(change > high, names["high"])
        .when(change > moderate, names["moderate"])
        .otherwise(names["low"])
    )


def tier_order(risk_tier: Column) -> Column:
    """Sort position of a tier, most severe first."""
    expr = F.when(risk_tier == TIERS[0], 0)
    for position, name in enumerate(TIERS[1:], start=1):
        expr = expr.when(risk_tier == name, position)
    return expr.otherwise(len(TIERS))


def whole_text(x: Column) -> Column:
    """A number rounded to a whole and written without exponent or separators."""
    return F.round(x, 0).cast("bigint").cast("string")


def decimal_text(x: Column, digits: int) -> Column:
    """A number written with a fixed count of decimals."""
    return F.round(x, digits).cast(f"decimal(18,{digits})").cast("string")


def thousands(x: Column, digits: int = 0) -> Column:
    """A number with thousands separators and a fixed count of decimals."""
    return F.format_number(x, digits)


def strip_quotes(x: Column) -> Column:
    """Remove double quotes and outer blanks from a name."""
    return F.trim(F.replace(x, F.lit('"'), F.lit("")))


def key_noise(keys: Sequence[Column], low: float, high: float, seed: int) -> Column:
    """Repeatable noise in [low, high), decided by the row's key and a seed.

    Unlike ``rand`` it does not depend on how rows fall into partitions, so a
    retried task gives the same values.
    """
    text = F.concat_ws("|", *[k.cast("string") for k in keys], F.lit(str(seed)))
    unit = F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("double") / float(16**7)
    return F.lit(low) + F.lit(high - low) * unit
