"""Monthly partitions: calendar, routing, and window replacement."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.dates import (
    DEFAULT_PARTITION,
    YEAR_MONTH,
    as_date,
    in_window,
    month_window,
    outside_window,
)


def month_partitions(bounds: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """One row per month from the month of ``lo`` through the month of ``hi``.

    ``bounds`` is a one-row frame, usually the smallest and largest date of a table.
    """
    months = F.sequence(F.trunc(lo, "month"), F.trunc(hi, "month"), F.expr("interval 1 month"))
    return bounds.select(F.explode(months).alias("partition_start")).select(
        "partition_start", F.add_months("partition_start", 1).alias("partition_end")
    )


def declared_months(
    bounds: DataFrame, first: str, last: str, needed: str
) -> DataFrame:
    """Months declared from ``first`` through ``last``, extended until one ends past ``needed``.

    As ``month_partitions`` followed by ``extend_partitions``, from one row with
    these dates, so the table they come from is read once.
    """
    # A month that ends on the needed date does not hold it yet.
    end = F.greatest(F.trunc(last, "month"), F.trunc(needed, "month"))
    return month_partitions(bounds.select(F.col(first).alias("lo"), end.alias("hi")))


def extend_partitions(partitions: DataFrame, needed: DataFrame, value: str) -> DataFrame:
    """Add months after the last partition until one ends past the needed date.

    ``partitions`` has partition_start and partition_end; ``needed`` is a
    one-row frame with the date in column ``value``. Nothing is added when the
    last partition already ends past it.
    """
    no_date = F.lit(None).cast("date")
    span = (
        partitions.select(F.col("partition_end").alias("last_end"), no_date.alias("value"))
        .unionByName(needed.select(no_date.alias("last_end"), F.col(value).alias("value")))
        .agg(F.max("last_end").alias("last_end"), F.max("value").alias("value"))
        .filter("last_end <= value")
    )
    added = span.select(
        F.explode(F.sequence("last_end", "value", F.expr("interval 1 month"))).alias(
            "partition_start"
        )
    ).select("partition_start", F.add_months("partition_start", 1).alias("partition_end"))
    return partitions.select("partition_start", "partition_end").unionByName(added)


def route_partitions(
    df: DataFrame, key: str, lo: dt.date | str, hi: dt.date | str, name: str = "month"
) -> DataFrame:
    """Name the partition of each row: its month inside ``[lo, hi)``, else the default one."""
    inside = in_window(key, as_date(lo), as_date(hi))
    return df.withColumn(
        name,
        F.when(inside, F.date_format(key, YEAR_MONTH)).otherwise(F.lit(DEFAULT_PARTITION)),
    )


def delta_partition_load(
    source: DataFrame,
    target: DataFrame,
    key: str,
    start: dt.date | str,
    end: dt.date | str,
) -> DataFrame:
    """The target with the months from ``start`` through ``end`` taken from the source.

    Whole months are replaced, also by nothing. Rows outside the window and
    rows without a date keep their place. An empty source changes nothing.
    """
    if source.isEmpty():
        return target
    window = month_window(start, end)
    kept = target.filter(outside_window(key, *window))
    return kept.unionByName(source.filter(in_window(key, *window)).select(target.columns))
