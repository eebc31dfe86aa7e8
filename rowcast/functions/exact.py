"""Money and measures as scaled integers.

Values become ``bigint`` millionths (``SCALE`` decimals) row by row, and sums
add whole units and millionths apart, so they are exact in any order, cheap in
generated code and hold a trillion rows. Nothing is rounded to the cent before
a sum; reports round their results, if at all. Results go back to ``double``
by one correctly rounded conversion.

NaN and infinite values count as unknown: like NULL they are left out of sums
and counts. Values of 9.2e12 and more are refused by the cast, not cut.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 6
_ONE = 10**SCALE
_UNIT = Decimal(1).scaleb(-SCALE)


def units(value: Column | str) -> Column:
    """``12.34`` as ``12340000``; NULL for what is not a finite number."""
    value = F.col(value) if isinstance(value, str) else value
    finite = F.abs(value) < F.lit(float("inf"))
    return F.when(finite, F.rint(value * float(_ONE)).cast("bigint"))


def units_sql(value: str) -> str:
    """The same as SQL text."""
    return f"IF(ABS({value}) < DOUBLE('Infinity'), CAST(RINT({value} * {_ONE}D) AS BIGINT), NULL)"


def sum_units(value: Column | str) -> Column:
    """Exact sum of ``bigint`` units as a decimal without decimals."""
    value = F.col(value) if isinstance(value, str) else value
    whole = F.sum(F.call_function("div", value, F.lit(_ONE).cast("bigint"))).cast("decimal(20,0)")
    return whole * F.lit(Decimal(_ONE)) + F.sum(value % F.lit(_ONE).cast("bigint"))


def sum_units_sql(value: str) -> str:
    """The same as SQL text, for units."""
    return f"(CAST(SUM({value} DIV {_ONE}L) AS DECIMAL(20, 0)) * {_ONE} + SUM({value} % {_ONE}L))"


def amount(total: Column | str) -> Column:
    """Units as ``double``, rounded once."""
    total = F.col(total) if isinstance(total, str) else total
    return (total.cast("decimal(38,0)") * F.lit(_UNIT)).cast("double")


def amount_sql(total: str) -> str:
    """The same as SQL text."""
    return f"CAST(CAST({total} AS DECIMAL(38, 0)) * {_UNIT:f}BD AS DOUBLE)"


def mean(total: Column, count: Column) -> Column:
    """Unrounded mean of a sum of units; NULL for no rows."""
    return amount(total) / F.nullif(count, F.lit(0))


def half_up(value: Column) -> Column:
    """A ``double`` rounded to whole units, ties away from zero."""
    return (F.signum(value) * F.floor(F.abs(value) + 0.5)).cast("bigint")


def rounded_ratio(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """``numerator / denominator`` rounded half up to ``digits``.

    Both sides are integers and the denominator is positive, so the rounding
    is done in whole numbers. NULL for a zero denominator.
    """
    wide = F.abs(numerator).cast("decimal(28,0)")
    below = denominator.cast("decimal(28,0)")
    top = wide * F.lit(Decimal(2 * 10**digits)) + below
    bottom = F.nullif(below * F.lit(Decimal(2)), F.lit(Decimal(0)))
    whole = F.call_function("div", top, bottom)
    return F.signum(numerator.cast("double")) * whole / float(10**digits)


def rounded_mean(total: Column, count: Column, digits: int = 2) -> Column:
    """Mean of a sum of units, rounded half up to ``digits`` decimals."""
    return rounded_ratio(total, count * F.lit(_ONE).cast("bigint"), digits)
