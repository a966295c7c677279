"""Filter and join shapes: pushable ranges, and three ways to combine two predicates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.dates import as_date, period_range
from martloom.operators.joins import checked_join


def sum_of_truncated_period(
    df: DataFrame, date: str, unit: str, start: dt.date | str, value: str
) -> DataFrame:
    """Total over one period, by a filter on the truncated date.

    The filter is evaluated on every row: it does not reach the scan. Kept
    beside ``sum_of_period`` because it is the form people write first.
    """
    same = F.date_trunc(unit, date).cast("date") == F.lit(as_date(start))
    return df.filter(same).agg(F.sum(value).alias("total"))


def sum_of_period(
    df: DataFrame, date: str, unit: str, start: dt.date | str, value: str
) -> DataFrame:
    """The same total by a half-open range, which skips row groups in the scan."""
    return df.filter(period_range(date, unit, start)).agg(F.sum(value).alias("total"))


def whole_number_between(column: str, lo: int, hi: int) -> Column:
    """Range test on text as numbers; text that is no number does not match."""
    return F.col(column).try_cast("int").between(lo, hi)


def text_between(column: str, lo: str, hi: str) -> Column:
    """Range test on text in text order, where '9' comes after '10'."""
    return F.col(column).between(lo, hi)


def union_all_filters(
    facts: DataFrame, other: DataFrame, on: list[str], first: Column, second: Column
) -> DataFrame:
    """Rows that meet either predicate, joined; a row that meets both counts twice.

    One scan and one join serve both branches: each row is repeated once per
    predicate it meets, which is what the union of the two joins returns.
    """
    copies = F.when(first, 1).otherwise(0) + F.when(second, 1).otherwise(0)
    matched = facts.filter(first | second)
    repeated = matched.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
    return checked_join(repeated.drop("_copy"), other, on)


def or_filter_join(
    facts: DataFrame, other: DataFrame, on: list[str], first: Column, second: Column
) -> DataFrame:
    """Rows that meet either predicate, joined; each counts once."""
    return checked_join(facts.filter(first | second), other, on)


def distinct_then_join(
    facts: DataFrame,
    other: DataFrame,
    on: list[str],
    first: Column,
    second: Column,
    columns: list[str],
) -> DataFrame:
    """As ``or_filter_join`` over ``columns``, with equal rows merged before they are joined."""
    return checked_join(facts.filter(first | second).select(columns).distinct(), other, on)
