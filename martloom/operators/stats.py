"""Statistics of a frame: its columns, and its hot keys."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table_stats(df: DataFrame, distinct: bool = True, exact: tuple[str, ...] = ()) -> DataFrame:
    """One row per column: row count, null count, smallest and largest value as text.

    ``distinct`` adds an approximate distinct count, which is exact for the columns
    named in ``exact``; those should have few values. One pass over the table;
    tasks combine into a single small row.
    """
    measures = []
    for name in df.columns:
        column = F.col(f"`{name}`")
        fields = [
            F.lit(name).alias("column_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(column.isNull()).alias("null_count"),
            F.min(column).cast("string").alias("min_value"),
            F.max(column).cast("string").alias("max_value"),
        ]
        if distinct:
            count = F.count_distinct(column) if name in exact else F.approx_count_distinct(column)
            fields.append(count.alias("distinct_count"))
        measures.append(F.struct(*fields))
    return df.agg(F.array(*measures).alias("measures")).select(F.inline("measures"))


def hot_keys(df: DataFrame, on: Sequence[str], share: float = 0.005) -> DataFrame:
    """Keys that hold at least ``share`` of all rows, with their exact number of rows.

    One pass keeps a sketch of frequent items, whose size depends on ``share``
    alone: it cannot miss a key that is frequent enough, but may name others. A
    second pass counts the named ones. Both read only the key columns, and nothing
    but the candidates, at most ``2 / share``, reaches the driver. Null is a key too.
    """
    if not 0.0001 <= share <= 1:
        raise ValueError(f"a share of {share} is not between 0.0001 and 1")
    # A hash passes over nulls, so where they are is hashed too.
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in on])
    keys = df.select(*on, F.xxhash64(*on, nulls).alias("_key"))
    # The sketch errs by less than a fourth of the share, so every key asked for is among its best.
    best = F.expr(f"approx_top_k(_key, {math.ceil(2 / share)}, {math.ceil(16 / share)})")
    found = keys.agg(best.alias("best"), F.count(F.lit(1)).alias("total")).first()
    candidates = [row["item"] for row in found["best"] or []]
    counted = keys.filter(F.col("_key").isin(candidates)).groupBy(*on)
    return counted.agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") >= share * found["total"])


def analyze(spark: SparkSession, table: str) -> None:
    """Store optimizer statistics of a catalog table."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")
