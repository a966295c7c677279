"""Hash shards: placement, distribution report, sorted sharded copies."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from martloom.sources import storage

_LAYOUT = "_layout.json"


def shard_of(columns: list[str | Column], shards: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(shards)).cast("int")


def shard(df: DataFrame, columns: list[str | Column], shards: int) -> DataFrame:
    """Number the shard of each row by a hash of ``columns``."""
    return df.withColumn("bucket", shard_of(columns, shards))


def shard_distribution(df: DataFrame, bucket: str = "bucket") -> DataFrame:
    """Rows per shard, fullest first; shows skewed placement."""
    return (
        df.groupBy(bucket)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.desc("row_count"), bucket)
    )


def task_distribution(df: DataFrame) -> DataFrame:
    """Rows per task as the frame is laid out now."""
    return shard_distribution(df.withColumn("bucket", F.spark_partition_id()))


def write_sharded(
    df: DataFrame,
    path: str,
    columns: list[str | Column],
    shards: int,
    order: list[str],
    looked_up: Sequence[str] = (),
) -> None:
    """Store a copy by shard, sorted inside each file so that readers can skip row groups.

    Rebalancing gives each shard its own files and splits a shard that got
    far more rows than the others over several tasks. Columns that are
    ``looked_up`` and not sorted by get Bloom filters, by which readers skip files
    and row groups without the value. The number of shards is stored with the copy,
    which takes the place of an earlier one when all of it is written.
    """
    spark = df.sparkSession
    rows = shard(df, columns, shards).hint("rebalance", "bucket").sortWithinPartitions("bucket", *order)
    with storage.replacing(spark, path) as fresh:
        writer = rows.write.mode("overwrite").partitionBy("bucket").option("compression", "zstd")
        for name in looked_up:
            writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
        writer.parquet(fresh)
        storage.write_text(spark, f"{fresh}/{_LAYOUT}", json.dumps({"shards": shards}))


def read_shard(spark: SparkSession, path: str, schema: StructType, place: list[Column], where: Column) -> DataFrame:
    """Rows that meet ``where`` of the one shard that holds rows with the values ``place``.

    ``place`` are the values, in the types, of what the copy was sharded by. The
    shard number is worked out from them while the plan is made, so that no other
    shard's folder is listed for reading.
    """
    path = storage.current(spark, path)
    shards = json.loads(storage.read_text(spark, f"{path}/{_LAYOUT}"))["shards"]
    layout = StructType([*schema.fields, StructField("bucket", IntegerType())])
    copy = spark.read.schema(layout).parquet(path)
    return copy.filter((F.col("bucket") == shard_of(place, shards)) & where).drop("bucket")
