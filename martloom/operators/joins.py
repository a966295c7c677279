"""Joins that hold at scale.

How a join runs is left to Spark: it broadcasts a side by its statistics and,
under the settings below, by the sizes it meets at run time, and it splits
partitions that turn out too large. Nothing here looks at data or file sizes
while a plan is built, so a join means the same for any input. What a caller
knows of a frame is stated: that it is a fact, that it has few rows by what it
is, or which of its keys are hot.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Skewed partitions are split at run time, also where that costs another shuffle later.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
KINDS = ("inner", "left")


def apply_runtime_settings(spark: SparkSession) -> SparkSession:
    """Turns on the run-time handling of skew that the joins rely on."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def _check(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> list[str]:
    if how not in KINDS:
        raise ValueError(f"a {how} join is not one of {KINDS}")
    kinds = [[df.schema[c].dataType for c in on] for df in (left, right)]
    if kinds[0] != kinds[1]:
        raise TypeError(f"join columns {list(on)} differ in type: {kinds[0]} and {kinds[1]}")
    return list(on)


def checked_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Inner or left join on columns of the same types; Spark chooses the way."""
    return left.join(right, _check(left, right, on, how), how)


def fact_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join of two facts: both are shuffled and sorted, neither is ever broadcast."""
    return left.join(right.hint("merge"), _check(left, right, on, how), how)


def few_rows(df: DataFrame) -> DataFrame:
    """Broadcast hint for a frame whose rows are bounded by what it is: one per region, channel or store."""
    return F.broadcast(df)


def _is_hot(on: list[str], hot: Sequence[Sequence[object]]) -> Column:
    keys = [reduce(and_, (F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(on, key, strict=True))) for key in hot]
    return reduce(or_, keys)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    hot: Sequence[Sequence[object]],
    slices: int,
    how: str = "inner",
) -> DataFrame:
    """Join in which rows of the named keys of the left side are spread over ``slices`` parts.

    A left row of a hot key takes one slice, fixed by its content and input
    partition, so that a rerun agrees; right rows of hot keys are copied to all.
    Each pair of rows meets in exactly one slice, so the result is the plain join.
    """
    keys = _check(left, right, on, how)
    if not hot or slices < 2:
        return left.join(right, keys, how)
    mixed = F.pmod(F.xxhash64(F.spark_partition_id(), *left.columns), F.lit(slices)).cast("int")
    every, one = F.sequence(F.lit(0), F.lit(slices - 1)), F.array(F.lit(0))
    is_hot = _is_hot(keys, hot)
    lhs = left.withColumn("_slice", F.when(is_hot, mixed).otherwise(F.lit(0)))
    rhs = right.withColumn("_slice", F.explode(F.when(is_hot, every).otherwise(one)))
    return lhs.join(rhs, [*keys, "_slice"], how).drop("_slice")
