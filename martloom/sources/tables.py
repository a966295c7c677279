"""Stored tables: Parquet folders, plain or with one folder per month."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from martloom.functions.dates import DEFAULT_PARTITION, in_window, month_window
from martloom.sources import storage

MONTH = "month"


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(0).select(columns)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A stored table; one that was never loaded reads as empty."""
    path = storage.current(spark, path)
    if storage.exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return empty_table(spark, schema)


def read_partitioned(
    spark: SparkSession, path: str, schema: StructType, keep_month: bool = False
) -> DataFrame:
    """All months of a partitioned table, as a rule without the folder column."""
    with_month = StructType([*schema.fields, StructField(MONTH, StringType())])
    table = read_table(spark, path, with_month)
    return table if keep_month else table.drop(MONTH)


def declared_folders(spark: SparkSession, path: str) -> list[str]:
    """Months a stored table has folders for, the default one left out."""
    found = storage.names(spark, path)
    months = [n.removeprefix(f"{MONTH}=") for n in found if n.startswith(f"{MONTH}=")]
    return sorted(m for m in months if m != DEFAULT_PARTITION)


def declare_folders(spark: SparkSession, path: str, months: list[str]) -> None:
    """Gives a stored table a folder, empty if need be, for each month."""
    for name in months:
        storage.make_folder(spark, f"{path}/{MONTH}={name}")


def remove_months(spark: SparkSession, path: str, months: list[str]) -> None:
    """Removes the rows of the given months; no job is run."""
    for name in months:
        storage.remove(spark, f"{path}/{MONTH}={name}")


def read_months(
    spark: SparkSession,
    path: str,
    schema: StructType,
    key: str,
    start: dt.date | str,
    end: dt.date | str,
) -> DataFrame:
    """The months from ``start`` through ``end``.

    A filter on the date does not prune folders named by its month, so the
    folder filter is stated as well.
    """
    lo, hi = month_window(start, end)
    with_month = StructType([*schema.fields, StructField(MONTH, StringType())])
    folders = (F.col(MONTH) >= f"{lo:%Y%m}") & (F.col(MONTH) < f"{hi:%Y%m}")
    table = read_table(spark, path, with_month)
    return table.filter(folders & in_window(key, lo, hi)).drop(MONTH)
