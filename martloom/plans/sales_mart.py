"""Store sales mart: one row per store and day with visitors, and the store report."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.dates import as_date
from martloom.functions.rounding import cents, ratio, round_ratio
from martloom.operators.joins import checked_join, few_rows

DAY = ["calday", "plant"]
TOTAL = "decimal(27,2)"


def _period(start: dt.date | str, end: dt.date | str | None) -> Column:
    lo = as_date(start)
    return F.col("calday").between(F.lit(lo), F.lit(lo if end is None else as_date(end)))


def discounts_daily(
    coupons: DataFrame, start: dt.date | str, end: dt.date | str | None = None
) -> DataFrame:
    """Coupon discount and number of coupons per store and day."""
    return (
        coupons.filter(_period(start, end))
        .groupBy(DAY)
        .agg(
            F.sum("discount").cast(TOTAL).alias("sum_coupon_discount"),
            F.count(F.lit(1)).alias("discount_material_count"),
        )
    )


def bills_daily(
    bills: DataFrame, start: dt.date | str, end: dt.date | str | None = None
) -> DataFrame:
    """Turnover, items, bills and their averages per store and day.

    Bills are first totalled one by one and then counted, so the distinct count
    needs no set of bill numbers, a busy store is worked on by many tasks, and
    the rows keep the placement the bill join gave them.
    """
    per_bill = (
        bills.filter(_period(start, end))
        .groupBy(*DAY, "billnum")
        .agg(F.sum("rpa_sat").alias("rpa_sat"), F.sum("qty").alias("qty"))
    )
    return (
        per_bill.groupBy(DAY)
        .agg(
            F.sum("rpa_sat").cast(TOTAL).alias("turnover"),
            F.sum("qty").alias("count_materials"),
            F.count("billnum").alias("bills_count"),
        )
        .withColumn("avg_materials", ratio(F.col("count_materials"), F.col("bills_count")))
        .withColumn("avg_bill", ratio(F.col("turnover"), F.col("bills_count")))
    )


def bill_sets(bills: DataFrame, start: dt.date | str, end: dt.date | str | None = None) -> DataFrame:
    """Bill numbers of each store and day as bitmaps, for distinct counts over any of the days.

    Counts of distinct bills cannot be added up over days, since a bill can have
    items of several; the bitmaps can be united. Bill numbers that are close to
    each other share a bitmap (``bucket``), so a day's bills, being numbered in a row
    or nearly so, take few. Rows without a bill number are not counted.
    """
    numbered = bills.filter(_period(start, end) & F.col("billnum").isNotNull())
    return (
        numbered.select(*DAY, "billnum")
        .distinct()
        .groupBy(*DAY, F.bitmap_bucket_number("billnum").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("billnum")).alias("bills"))
    )


def distinct_bills(sets: DataFrame, by: list[str], start: dt.date | str, end: dt.date | str) -> DataFrame:
    """Distinct bills of a period from their bitmaps, exact, by store, day or both; no bill is read."""
    united = sets.filter(_period(start, end)).groupBy(*by, "bucket").agg(F.bitmap_or_agg("bills").alias("bills"))
    return united.groupBy(by).agg(F.sum(F.bitmap_count("bills")).alias("bills_count"))


def traffic_daily(
    traffic: DataFrame, start: dt.date | str, end: dt.date | str | None = None
) -> DataFrame:
    """Visitors per store and day."""
    return (
        traffic.filter(_period(start, end))
        .groupBy(DAY)
        .agg(F.sum("quantity").alias("total_traffic"))
    )


def sales_mart_daily(
    bills: DataFrame,
    coupons: DataFrame,
    traffic: DataFrame,
    start: dt.date | str,
    end: dt.date | str | None = None,
    with_avg_materials: bool = False,
) -> DataFrame:
    """Daily mart for a period; without ``end`` for the one day ``start``.

    Traffic decides which store days appear. Discounts reach a row only through
    its bills: a day with coupons but no bill shows zero. All three inputs are
    totalled by store and day before they meet, so the joins are small and
    reuse the placement of the totals.
    """
    sold = bills_daily(bills, start, end).join(
        discounts_daily(coupons, start, end), DAY, "left"
    )
    money, zero = F.lit(0).cast(TOTAL), F.lit(0)
    average = [F.coalesce("avg_materials", F.lit(0.0)).alias("avg_materials")]
    return (
        traffic_daily(traffic, start, end)
        .join(sold, DAY, "left")
        .select(
            *DAY,
            F.coalesce("turnover", money).alias("turnover"),
            F.coalesce("sum_coupon_discount", money).alias("sum_coupon_discount"),
            F.coalesce("count_materials", zero).alias("count_materials"),
            F.coalesce("bills_count", zero).alias("bills_count"),
            "total_traffic",
            F.coalesce("discount_material_count", zero).alias("discount_material_count"),
            *(average if with_avg_materials else []),
            F.coalesce("avg_bill", F.lit(0.0)).alias("avg_bill"),
        )
    )


MEASURES = [
    "turnover",
    "sum_coupon_discount",
    "count_materials",
    "bills_count",
    "total_traffic",
    "discount_material_count",
]


def store_totals(mart: DataFrame, by: list[str]) -> DataFrame:
    """Sums of the daily measures. Bills are counted per day and added up."""
    sums = [F.sum(m).alias(m) for m in MEASURES]
    totals = mart.groupBy(by).agg(*sums)
    return totals.withColumns({m: F.col(m).cast(TOTAL) for m in MEASURES[:2]})


def sales_mart_view(mart: DataFrame, stores: DataFrame) -> DataFrame:
    """Store report with percentages and averages, rounded half up.

    Stores that are not in the store table drop out. A ratio over zero is NULL.
    """
    names = stores.select("plant", F.col("txt").alias("plant_name"))
    totals = store_totals(checked_join(mart, few_rows(names), ["plant"]), ["plant_name", "plant"])
    items, bills, visitors = (
        F.col(c) for c in ("count_materials", "bills_count", "total_traffic")
    )
    turnover = cents("turnover")
    return totals.select(
        "plant_name",
        "plant",
        "turnover",
        "sum_coupon_discount",
        (F.col("turnover") - F.col("sum_coupon_discount"))
        .cast(TOTAL)
        .alias("turnover_with_discount"),
        "count_materials",
        "bills_count",
        "total_traffic",
        "discount_material_count",
        round_ratio(F.col("discount_material_count") * 100, items, 1).alias(
            "discount_materials_share"
        ),
        round_ratio(items, bills, 2).alias("avg_materials"),
        round_ratio(bills * 100, visitors, 2).alias("conversion"),
        round_ratio(turnover, bills * 100, 1).alias("avg_bill"),
        round_ratio(turnover, visitors * 100, 1).alias("avg_revenue_per_visitor"),
    )
