"""Month loads that follow files as they arrive, late and repeated ones included."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from martloom.functions.dates import month_key, next_month
from martloom.operators.loads import COMPRESSION, LoadResult, load_months
from martloom.operators.quality import conform, require
from martloom.sources.tables import MONTH, read_table

BATCH = "batch"


def _runs(months: list[str]) -> Iterator[tuple[dt.date, dt.date]]:
    """First and last month of each run of neighbouring months."""
    days = sorted(dt.datetime.strptime(name, "%Y%m").date() for name in months)
    while days:
        first = last = days.pop(0)
        while days and days[0] == next_month(last):
            last = days.pop(0)
        yield first, last


def _latest(arrived: DataFrame, schema: StructType, unique: Sequence[str]) -> DataFrame:
    """Of the rows with equal ``unique`` columns the one that arrived last."""
    rest = [name for name in schema.names if name not in unique]
    newest = F.max(F.struct(BATCH, *rest)).alias("row")
    rows = arrived.groupBy(*unique).agg(newest)
    return rows.select(*unique, *[F.col("row")[name].alias(name) for name in rest]).select(schema.names)


def load_arrivals(
    spark: SparkSession,
    landing: str,
    path: str,
    schema: StructType,
    key: str,
    unique: Sequence[str],
    arrived: str,
    checkpoint: str,
    files_at_once: int | None = None,
) -> list[LoadResult]:
    """Load what has arrived since the last call, then return the loads of its months.

    The rows of each batch are kept under ``arrived``, by batch and month. Then the
    months that occur in the batch, and no others, are loaded anew from all that
    has arrived for them, so rows may come late, in any order and more than once.
    Rows are the same if they agree in the ``unique`` columns; the last to arrive
    counts, and a row keeps its date. Rows without a date are kept under ``arrived``
    and not loaded.

    A batch that fails is taken again by the next call, under its number, and
    replaces what it had kept, so each row counts once.
    """
    layout = StructType([*schema.fields, StructField(BATCH, LongType()), StructField(MONTH, StringType())])
    results: list[LoadResult] = []

    def take(rows: DataFrame, number: int) -> None:
        session = rows.sparkSession
        kept = require(conform(rows, schema), schema).withColumn(MONTH, month_key(key))
        writer = kept.write.mode("overwrite").option("compression", COMPRESSION)
        writer.partitionBy(MONTH).parquet(f"{arrived}/{BATCH}={number}")
        batch = session.read.schema(StructType([*schema.fields, layout[MONTH]])).parquet(f"{arrived}/{BATCH}={number}")
        # As many values as months occur in one batch.
        found = batch.filter(F.col(key).isNotNull()).select(MONTH).distinct().toLocalIterator()
        everything = read_table(session, arrived, layout)
        for first, last in _runs([row[MONTH] for row in found]):
            window = F.col(MONTH).between(f"{first:%Y%m}", f"{last:%Y%m}")
            source = _latest(everything.filter(window), schema, unique)
            results.append(load_months(source, path, schema, key, first, last, only_changed=True))

    stream = spark.readStream.schema(schema)
    if files_at_once:
        stream = stream.option("maxFilesPerTrigger", files_at_once)
    query = (
        stream.parquet(landing)
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return results
