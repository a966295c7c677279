"""Database tables, read in date slices."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from martloom.operators.quality import conform


def date_slices(
    key: str, lo: dt.date, hi: dt.date, days: int = 1, complete: bool = True
) -> list[str]:
    """Predicates that cut ``[lo, hi)`` into slices, one read task each.

    ``complete`` adds a slice for all other rows, NULL dates included, so that
    the slices together are the whole table. Short slices keep a busy month
    from landing in one task.
    """
    slices = []
    first = lo
    while first < hi:
        last = min(first + dt.timedelta(days=days), hi)
        slices.append(f"{key} >= DATE '{first}' AND {key} < DATE '{last}'")
        first = last
    if complete:
        slices.append(f"{key} IS NULL OR {key} < DATE '{lo}' OR {key} >= DATE '{hi}'")
    return slices


def read_jdbc(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str,
    schema: StructType,
    slices: list[str] | None = None,
    key: str | None = None,
    bounds: tuple[int, int, int] | None = None,
) -> DataFrame:
    """A database table in its declared schema, read by several tasks.

    The table is cut by ``slices``, predicates that together cover it, or by a
    numeric ``key`` with ``bounds`` (lower, upper, parts); without either a
    whole table would be one task's work, so that is refused. ``options``
    carries url, user, password, driver and such; nothing is built in. Column
    selection and filters of the query are pushed to the database.
    """
    if not slices and not (key and bounds):
        raise ValueError(f"{table}: name slices, or a numeric key and its bounds")
    properties = {"fetchsize": "10000", **options}
    url = properties.pop("url")
    if slices:
        source = spark.read.jdbc(url, table, predicates=slices, properties=properties)
    else:
        lower, upper, parts = bounds
        source = spark.read.jdbc(
            url, table, column=key, lowerBound=lower, upperBound=upper, numPartitions=parts, properties=properties
        )
    return conform(source, schema)
