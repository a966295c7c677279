"""Serving layer: narrow copies of the marts, and reports over dictionaries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType, IntegerType, StructType

from martloom.functions.dates import as_date, day_number
from martloom.functions.rounding import ratio
from martloom.operators.lookup import Dictionary, dict_lookup, dict_lookups
from martloom.operators.shards import read_shard, write_sharded
from martloom.plans.sales_mart import store_totals

# Fixed value: shard keys and sort order of the two serving tables.
PLAN_FACT_SHARD = ["region", "matdirec", "distr_chan"]
PLAN_FACT_ORDER = ["region"]
SALES_ORDER = ["plant", "calday"]


def export_types(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast to the serving types. Only a copy is narrowed: reports use the full values."""
    columns = []
    for field in schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, FloatType):
            column = column.cast("double").cast("float")
        elif isinstance(field.dataType, IntegerType):
            column = column.cast("int")
        columns.append(column.alias(field.name))
    return df.select(columns)


def publish_plan_fact(mart: DataFrame, path: str, shards: int) -> None:
    write_sharded(mart, path, PLAN_FACT_SHARD, shards, PLAN_FACT_ORDER, ["matdirec", "distr_chan"])


def publish_sales(mart: DataFrame, path: str, shards: int) -> None:
    write_sharded(mart, path, ["plant", day_number("calday")], shards, SALES_ORDER)


def plan_fact_lookup(
    spark: SparkSession, path: str, schema: StructType, region: str, matdirec: str, distr_chan: str
) -> DataFrame:
    """Rows of a published plan-and-fact mart for one region, direction and channel, from the one shard that has them."""
    keys = dict(zip(PLAN_FACT_SHARD, (region, matdirec, distr_chan)))
    met = [F.col(name) == F.lit(value) for name, value in keys.items()]
    return read_shard(spark, path, schema, [F.lit(v) for v in keys.values()], reduce(and_, met))


def sales_lookup(spark: SparkSession, path: str, schema: StructType, plant: str, day: dt.date | str) -> DataFrame:
    """The row of a published daily mart for one store and day, from the one shard that has it."""
    value = F.lit(as_date(day))
    met = (F.col("plant") == F.lit(plant)) & (F.col("calday") == value)
    return read_shard(spark, path, schema, [F.lit(plant), day_number(value)], met)


def point_lookup(mart: DataFrame, keys: Mapping[str, object]) -> DataFrame:
    """Rows with the given value in every key column."""
    for name, value in keys.items():
        mart = mart.filter(F.col(name) == F.lit(value))
    return mart


def sales_report(daily: DataFrame, stores: DataFrame) -> DataFrame:
    """Store report with plain fractions; a store without a name gets an empty one."""
    totals = store_totals(daily, ["plant"])
    named = dict_lookup(totals, stores, "plant", {"txt": "plant_name"})
    turnover, items, bills, visitors, discounted = (
        F.col(c)
        for c in (
            "turnover", "count_materials", "bills_count", "total_traffic",
            "discount_material_count",
        )
    )
    return named.select(
        "plant_name",
        "plant",
        "turnover",
        "sum_coupon_discount",
        (turnover - F.col("sum_coupon_discount"))
        .cast("decimal(27,2)")
        .alias("turnover_with_discount"),
        "count_materials",
        "bills_count",
        "total_traffic",
        "discount_material_count",
        ratio(discounted, items).alias("discount_materials_share"),
        ratio(items, bills).alias("avg_materials"),
        ratio(bills, visitors).alias("conversion"),
        ratio(turnover, bills).alias("avg_bill"),
        ratio(turnover, visitors).alias("avg_revenue_per_visitor"),
    )


def plan_fact_report(
    mart: DataFrame, region: DataFrame, channel: DataFrame, product: DataFrame, prices: DataFrame
) -> DataFrame:
    """Mart lines with dictionary texts; every line stays, unknown keys give defaults.

    Prices are looked up by material alone. Of its several prices the one last
    in order of region and channel is taken, so the answer is always the same.
    """
    named = dict_lookup(mart, region, "region", {"txt": "region_name"})
    named = dict_lookup(named, channel, "dist_chan", {"txtsh": "chan_name"}, on="distr_chan")
    by_material = [
        Dictionary(product, "material", {"brand": "brand", "txt": "product_name"}),
        Dictionary(prices, "material", {"price": "price"}, ("region", "dist_chan")),
    ]
    priced = dict_lookups(named, "material", by_material)
    return priced.select(
        "region", "region_name", "matdirec", "distr_chan", "chan_name", "sales_qt", "plan_qt",
        "plan_exec_perc", "material", "brand", "product_name", "price",
    )
