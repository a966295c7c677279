"""Monthly plan-and-fact mart with the best-selling material of each region."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.dates import month_bounds, period_range
from martloom.functions.rounding import ratio
from martloom.operators.joins import checked_join, fact_join, few_rows

LINE = ["region", "matdirec", "distr_chan"]


def _month(df: DataFrame, yyyymm: str) -> DataFrame:
    return df.filter(period_range("date", "month", month_bounds(yyyymm)[0]))


def sales_by_material(sales: DataFrame, product: DataFrame, yyyymm: str) -> DataFrame:
    """Month's quantity per region, material and channel, with the material's direction.

    Sales are totalled before the product join: a material that makes up much
    of the sales is one row per region and channel by then, and the product
    table meets totals instead of sales lines. Unknown materials drop out.
    The product table grows with the data, so it is never broadcast.
    """
    totals = (
        _month(sales, yyyymm)
        .groupBy("region", "material", "distr_chan")
        .agg(F.sum("quantity").alias("quantity"))
    )
    directions = product.select("material", "matdirec")
    return fact_join(totals, directions, ["material"])


def _by_direction(totals: DataFrame) -> DataFrame:
    return totals.groupBy(LINE).agg(F.sum("quantity").alias("sales_qt"))


def _best(totals: DataFrame) -> DataFrame:
    """Materials with the largest quantity of their region, all of them when tied.

    An unknown (NULL) total counts as largest. The largest total per region is
    an aggregate, and the join back is on region *and* total, so no task ever
    gets all materials of a region, as a window over the region would need.
    """
    materials = totals.groupBy("region", "material").agg(F.sum("quantity").alias("sales_qt"))
    largest = materials.groupBy("region").agg(
        F.when(F.bool_or(F.col("sales_qt").isNull()), F.lit(None))
        .otherwise(F.max("sales_qt"))
        .alias("largest")
    )
    top = few_rows(largest.withColumnRenamed("region", "top_region"))
    same = F.col("region").eqNullSafe(F.col("top_region")) & F.col("sales_qt").eqNullSafe(
        F.col("largest")
    )
    return materials.join(top, same, "left_semi")


def sales_by_direction(sales: DataFrame, product: DataFrame, yyyymm: str) -> DataFrame:
    """Sold quantity of the month per region, direction and channel."""
    return _by_direction(sales_by_material(sales, product, yyyymm))


def plan_by_direction(plan: DataFrame, yyyymm: str) -> DataFrame:
    """Planned quantity of the month per region, direction and channel."""
    return _month(plan, yyyymm).groupBy(LINE).agg(F.sum("quantity").alias("plan_qt"))


def top_material_by_region(sales: DataFrame, product: DataFrame, yyyymm: str) -> DataFrame:
    """Best-selling materials of the month per region, ties included."""
    return _best(sales_by_material(sales, product, yyyymm))


def plan_fact_mart(
    sales: DataFrame, plan: DataFrame, product: DataFrame, yyyymm: str
) -> DataFrame:
    """Plan lines of the month with sales, percentage done and the region's best seller.

    Sales without a plan line, and plan lines of regions without sales, do not
    appear; tied best sellers repeat the line. Nothing planned counts as 0 %.
    """
    totals = sales_by_material(sales, product, yyyymm)
    planned = plan_by_direction(plan, yyyymm).filter("region is not null")
    done = ratio(F.col("_sales_qt") * 100, F.col("plan_qt"))
    return (
        planned.join(_prefixed(_by_direction(totals)), _same(LINE), "left")
        .drop(*[f"_{c}" for c in LINE])
        .join(_prefixed(_best(totals).select("region", "material")), _same(["region"]))
        .select(
            *LINE,
            F.coalesce("_sales_qt", F.lit(0)).alias("sales_qt"),
            F.coalesce("plan_qt", F.lit(0)).alias("plan_qt"),
            F.coalesce(done, F.lit(0.0)).alias("plan_exec_perc"),
            F.col("_material").alias("material"),
        )
    )


def _prefixed(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).alias(f"_{c}") for c in df.columns])


def _same(columns: list[str]) -> Column:
    """Equality of the columns, for sales on the right that other joins share.

    Written null-safe with the NULLs of the left shut out. Plain equality makes
    the optimizer filter NULLs on the right, differently in each join, and the
    sales would then be scanned and totalled once per join instead of once.
    """
    tests = [F.col(c).eqNullSafe(F.col(f"_{c}")) & F.col(c).isNotNull() for c in columns]
    return reduce(and_, tests)


def plan_fact_view(
    mart: DataFrame, region: DataFrame, channel: DataFrame, product: DataFrame, prices: DataFrame
) -> DataFrame:
    """Report over the mart: names, brand, and the price in that region and channel.

    Lines whose region, channel or material is unknown drop out; a missing
    price stays NULL. Products and prices grow with the data: they are joined
    shuffled, never broadcast, only regions and channels are.
    """
    regions = region.select("region", F.col("txt").alias("region_name"))
    channels = channel.select(
        F.col("dist_chan").alias("distr_chan"), F.col("txtsh").alias("chan_name")
    )
    named = checked_join(mart, few_rows(regions), ["region"])
    named = checked_join(named, few_rows(channels), ["distr_chan"])
    named = fact_join(
        named,
        product.select("material", "brand", F.col("txt").alias("product_name")),
        ["material"],
    )
    listed = prices.select("material", "region", F.col("dist_chan").alias("distr_chan"), "price")
    priced = fact_join(named, listed, ["material", "region", "distr_chan"], "left")
    return priced.select(
        "region", "region_name", "matdirec", "distr_chan", "chan_name", "plan_exec_perc",
        "material", "brand", "product_name", "price",
    )
