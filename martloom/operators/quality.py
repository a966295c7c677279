"""Row quality: type conformance, non-empty filter, required columns, partition checks."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from martloom.functions.dates import outside_window


class LoadError(ValueError):
    """A load found rows it must not publish."""


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types; blank padding is cut off."""
    columns = []
    for field in schema.fields:
        column = F.col(f"`{field.name}`")
        if df.schema[field.name].dataType != field.dataType:
            column = column.cast(field.dataType)
        if field.metadata.get("padded"):
            column = F.rtrim(column)
        columns.append(column.alias(field.name, metadata=field.metadata))
    return df.select(columns)


def text_columns(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, StringType)]


def not_empty_predicate(schema: StructType) -> Column:
    """Every text column of the target holds a value.

    NULL and all-blank values fail; a target without text columns keeps all rows.
    """
    tests = [F.rtrim(F.col(f"`{name}`")) != "" for name in text_columns(schema)]
    return F.coalesce(reduce(and_, tests), F.lit(False)) if tests else F.lit(True)


def not_empty(df: DataFrame, schema: StructType | None = None) -> DataFrame:
    return df.filter(not_empty_predicate(schema or df.schema))


def require(df: DataFrame, schema: StructType) -> DataFrame:
    """Fail the job on NULL in a required column, in the same pass that writes the rows."""
    columns = []
    for field in schema.fields:
        column = F.col(f"`{field.name}`")
        if not field.nullable:
            failure = F.raise_error(F.lit(f"NULL in required column {field.name}"))
            column = F.coalesce(column, failure.cast(field.dataType)).alias(field.name)
        columns.append(column)
    return df.select(columns)


def outside_partition(df: DataFrame, key: str, lo: dt.date, hi: dt.date) -> DataFrame:
    """Rows whose date is not in ``[lo, hi)``; a NULL date is not inside any range."""
    return df.filter(outside_window(key, lo, hi))


def inside_windows(df: DataFrame, key: str, windows: list[tuple[dt.date, dt.date]]) -> DataFrame:
    """Fail the job on a row outside all of the windows ``[lo, hi)``, in the same pass that writes the rows."""
    spans = ", ".join(f"[{lo}, {hi})" for lo, hi in windows)
    failure = F.raise_error(F.lit(f"row with {key} outside {spans}")).cast(df.schema[key].dataType)
    stray = reduce(and_, [outside_window(key, lo, hi) for lo, hi in windows])
    checked = F.when(stray, failure).otherwise(F.col(key))
    return df.withColumn(key, checked.alias(key, metadata=df.schema[key].metadata))


def assert_in_partition(df: DataFrame, key: str, lo: dt.date, hi: dt.date) -> DataFrame:
    """Check staged rows before they replace a partition."""
    if not outside_partition(df, key, lo, hi).isEmpty():
        raise LoadError(f"rows with {key} outside [{lo}, {hi})")
    return df
