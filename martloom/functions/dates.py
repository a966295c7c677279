"""Date expressions and month arithmetic."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark patterns of the text forms dates arrive in.
YEAR_MONTH = "yyyyMM"
COMPACT_DAY = "yyyyMMdd"
DOTTED_DAY = "dd.MM.yyyy"

# Month directory of rows without a usable partition date.
DEFAULT_PARTITION = "def"


def as_date(value: dt.date | str) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def month_start(day: dt.date | str) -> dt.date:
    return as_date(day).replace(day=1)


def next_month(day: dt.date | str) -> dt.date:
    """First day of the month after the one that holds ``day``."""
    return (month_start(day) + dt.timedelta(days=32)).replace(day=1)


def month_bounds(yyyymm: str) -> tuple[dt.date, dt.date]:
    """First and last day of the month written as ``YYYYMM``."""
    first = dt.datetime.strptime(yyyymm, "%Y%m").date()
    return first, next_month(first) - dt.timedelta(days=1)


def month_window(start: dt.date | str, end: dt.date | str) -> tuple[dt.date, dt.date]:
    """Half-open window of whole months; the month of ``end`` is inside."""
    return month_start(start), next_month(end)


def months_between(lo: dt.date, hi: dt.date) -> list[dt.date]:
    """First days of the months in ``[lo, hi)``."""
    months = []
    while lo < hi:
        months.append(lo)
        lo = next_month(lo)
    return months


def period_range(column: Column | str, unit: str, start: dt.date | str) -> Column:
    """``date_trunc(unit, column) = start`` written so that it reaches the scan.

    A filter on a truncated column cannot be pushed to the files; the equal
    half-open range can. ``start`` must be the first day of its period.
    """
    column = F.col(column) if isinstance(column, str) else column
    first = as_date(start)
    if unit == "year" and first == first.replace(month=1, day=1):
        end = first.replace(year=first.year + 1)
    elif unit == "month" and first == month_start(first):
        end = next_month(first)
    else:
        raise ValueError(f"{first} does not start a period of unit {unit!r}")
    return (column >= F.lit(first)) & (column < F.lit(end))


def in_window(column: Column | str, lo: dt.date, hi: dt.date) -> Column:
    """``lo <= column < hi``; NULL dates are outside."""
    column = F.col(column) if isinstance(column, str) else column
    return (column >= F.lit(lo)) & (column < F.lit(hi))


def outside_window(column: Column | str, lo: dt.date, hi: dt.date) -> Column:
    """The rows ``in_window`` leaves, NULL dates among them; can be pushed to the scan."""
    column = F.col(column) if isinstance(column, str) else column
    return column.isNull() | (column < F.lit(lo)) | (column >= F.lit(hi))


def parse_day(column: Column | str, pattern: str) -> Column:
    """Text to date; text that is no such date gives NULL instead of failing the job."""
    return F.try_to_date(column, pattern)


def month_end(column: Column | str) -> Column:
    return F.last_day(column)


def day_text(column: Column | str) -> Column:
    return F.date_format(column, COMPACT_DAY)


def day_number(column: Column | str) -> Column:
    """Day as the integer YYYYMMDD, without a detour over text."""
    return F.year(column) * 10000 + F.month(column) * 100 + F.dayofmonth(column)


def month_key(column: Column | str) -> Column:
    """Partition directory of a date: ``YYYYMM``, or the default for NULL."""
    return F.coalesce(F.date_format(column, YEAR_MONTH), F.lit(DEFAULT_PARTITION))
