"""Exact half-up rounding of ratios.

Spark's decimal division drops digits once the result would pass 38 digits,
and doubles miss decimal ties. Dividing integers keeps every digit: with an
integer numerator n and denominator d, (2n + d) div 2d is n/d rounded half up.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

WHOLE = "decimal(38,0)"


def half_up(numerator: Column, denominator: Column) -> Column:
    """Nearest integer of numerator/denominator, ties away from zero; NULL over zero."""
    n, d = numerator.cast(WHOLE), F.nullif(denominator.cast(WHOLE), F.lit(0).cast(WHOLE))
    quotient = F.call_function("div", F.abs(n) * 2 + F.abs(d), F.abs(d) * 2)
    return F.when((n < 0) != (d < 0), -quotient).otherwise(quotient)


def round_ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """numerator/denominator to ``digits`` places; both sides must be whole numbers."""
    scaled = half_up(numerator.cast(WHOLE) * F.lit(10**digits), denominator)
    return unscale(scaled, digits)


def unscale(column: Column, digits: int) -> Column:
    """Whole number of smallest units to a decimal with ``digits`` places."""
    unit = F.lit(Decimal(1).scaleb(-digits))
    return (column.cast("decimal(20,0)") * unit).cast(f"decimal(17,{digits})")


def cents(column: Column | str) -> Column:
    """Money with two places as a whole number of cents."""
    column = F.col(column) if isinstance(column, str) else column
    return (column * 100).cast(WHOLE)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Unrounded ratio as a double; NULL over zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))
