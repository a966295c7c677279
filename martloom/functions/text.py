"""Text expressions: key normalising, qualified names, mart names."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from martloom.functions.dates import as_date

# Fixed value: characters that a normalised key or name must not contain.
STRIPPED = ";/'"


def normalize_key(column: Column | str) -> Column:
    """Key without separators and quotes, trimmed, in lower case."""
    return F.lower(F.trim(F.translate(column, STRIPPED, "")))


def normalize_name(name: str) -> str:
    """The same rule for a name held in Python."""
    return name.translate({ord(c): None for c in STRIPPED}).strip(" ").lower()


def schema_part(column: Column | str) -> Column:
    """Text before the first dot of ``schema.table``; empty without a dot."""
    column = F.col(column) if isinstance(column, str) else column
    dot = F.instr(column, ".")
    return F.left(column, F.greatest(dot - 1, F.lit(0)))


def table_part(column: Column | str) -> Column:
    """Text after the first dot of ``schema.table``; the whole text without a dot."""
    column = F.col(column) if isinstance(column, str) else column
    return F.right(column, F.length(column) - F.instr(column, "."))


def plan_fact_name(yyyymm: str) -> str:
    return normalize_name(f"plan_fact_{yyyymm}")


def plan_fact_view_name(yyyymm: str) -> str:
    return normalize_name(f"v_{plan_fact_name(yyyymm)}")


def _period(start: dt.date | str, end: dt.date | str | None) -> str:
    days = [as_date(d).strftime("%Y%m%d") for d in (start, end) if d is not None]
    return "_".join(days)


def sales_mart_name(start: dt.date | str, end: dt.date | str | None = None) -> str:
    return normalize_name(f"sales_data_{_period(start, end)}")


def sales_view_name(start: dt.date | str, end: dt.date | str | None = None) -> str:
    return normalize_name(f"v_sales_mart{_period(start, end)}")
