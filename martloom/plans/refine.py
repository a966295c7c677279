"""Refinement: raw tables to retyped ones, and those to joined detail tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from martloom import schemas
from martloom.functions.dates import COMPACT_DAY, DOTTED_DAY, as_date, parse_day
from martloom.functions.rounding import cents, half_up, ratio, unscale
from martloom.operators.joins import fact_join, salted_join
from martloom.operators.quality import not_empty_predicate

# How a promotion's discount is meant.
ABSOLUTE, PERCENT = "001", "002"


def _readable(values: dict[str, Column]) -> Column:
    """No column holds a text whose value could not be read."""
    tests = [F.col(name).isNull() | value.isNotNull() for name, value in values.items()]
    return reduce(and_, tests)


class Rejects:
    """Counts unreadable rows of a raw table while another job reads it.

    ``watch`` wraps the raw rows; once a job over them has run, ``found`` is the
    number of rows it could not read, and ``rows`` are these rows.
    """

    def __init__(self, raw: DataFrame, values: dict[str, Column]):
        self.raw, self.values, self.seen = raw, values, Observation()

    def watch(self) -> DataFrame:
        return self.raw.observe(self.seen, F.count_if(~_readable(self.values)).alias("found"))

    @property
    def found(self) -> int:
        return self.seen.get["found"]

    @property
    def rows(self) -> DataFrame:
        return self.raw.filter(~_readable(self.values))


# ---- traffic ---------------------------------------------------------------


def traffic_ods(traffic: DataFrame) -> DataFrame:
    """Raw visitor counts with the day as a date; an unreadable day becomes NULL."""
    return traffic.select(
        "plant", parse_day("date", DOTTED_DAY).alias("calday"), "time", "frame_id", "quantity"
    )


def traffic_rejects(traffic: DataFrame) -> Rejects:
    return Rejects(traffic, {"date": parse_day("date", DOTTED_DAY)})


# ---- coupons and promotions ------------------------------------------------


def _coupon_values() -> dict[str, Column]:
    return {
        "calday": parse_day("calday", COMPACT_DAY),
        "material": F.col("material").try_cast("bigint"),
        "billnum": F.col("billnum").try_cast("bigint"),
    }


def _promo_values() -> dict[str, Column]:
    return {"material": F.col("material").try_cast("bigint")}


def coupons_ods(
    coupons: DataFrame, start: dt.date | str | None = None, end: dt.date | str | None = None
) -> DataFrame:
    """Coupons with typed day, material and bill; of a period, if one is given.

    Rows with a blank text value that stays text are dropped; rows with an
    unreadable value are left to ``coupons_rejects``. The period is compared with
    the day as the text it arrives in, which sorts as the day does, so rows
    outside of it are not parsed at all.
    """
    if start is not None:
        lo = as_date(start)
        hi = lo if end is None else as_date(end)
        coupons = coupons.filter(F.col("calday").between(f"{lo:%Y%m%d}", f"{hi:%Y%m%d}"))
    values = _coupon_values()
    kept = coupons.filter(_readable(values) & not_empty_predicate(schemas.ODS_COUPONS))
    return kept.withColumns(values).select(schemas.ODS_COUPONS.names)


def coupons_rejects(coupons: DataFrame) -> Rejects:
    return Rejects(coupons, _coupon_values())


def promos_ods(promos: DataFrame) -> DataFrame:
    """Promotions with a typed material, without blank text values."""
    values = _promo_values()
    kept = promos.filter(_readable(values) & not_empty_predicate(schemas.ODS_PROMOS))
    return kept.withColumns(values).select(schemas.ODS_PROMOS.names)


def promos_rejects(promos: DataFrame) -> Rejects:
    return Rejects(promos, _promo_values())


# ---- detail layer ----------------------------------------------------------


def bills_dds(items: DataFrame, heads: DataFrame) -> DataFrame:
    """Bill items with the store of their bill.

    Items without a header are dropped and a repeated header repeats its items.
    The bill number is the only join key; a partition that a bill with very many
    items makes too large is split at run time.
    """
    joined = fact_join(items, heads.select("billnum", "plant"), ["billnum"])
    return joined.select(schemas.DDS_BILLS.names)


# Parts that the coupons of a hot promotion are spread over.
SLICES = 64


def coupons_dds(
    coupons: DataFrame, items: DataFrame, promos: DataFrame, hot: Sequence[str | None] = ()
) -> DataFrame:
    """Coupons with the unit price paid and the discount in money.

    Inner joins drop coupons without a matching item or promotion; the
    promotion's own material plays no part. An absolute discount is taken as it
    is, a percentage is applied to the unit price, other kinds give NULL. Equal
    rows are merged on the exact values and only then rounded to money, so
    rows that look alike after rounding can remain.

    Coupons meet the promotions first: those of an unknown one, often half of
    all, never meet the bill items. ``hot`` names promotions, known or not, whose
    coupons are too many for one task, as ``stats.hot_keys`` finds them.

    Lines of a (material, bill) pair with the same unit price are made one first,
    and the joined rows are merged again, so repeated coupons and lines do not
    multiply. A pair too large for one task is split at run time.
    """
    on = ["material", "billnum"]
    kinds = promos.select("promo_id", "promo_type", F.col("discount").alias("_promo"))
    known = salted_join(coupons, kinds, ["promo_id"], [[key] for key in hot], SLICES)
    rows = fact_join(known, _one_per_price(items.select(*on, "rpa_sat", "qty"), on), on)
    absolute, percent = F.col("promo_type") == ABSOLUTE, F.col("promo_type") == PERCENT
    price = ratio(F.col("rpa_sat"), F.col("qty"))
    exact = rows.withColumn("_price", price).withColumn(
        "_discount",
        F.when(absolute, F.col("_promo").cast("double")).when(
            percent, F.col("_promo").cast("double") / 100 * F.col("_price")
        ),
    )
    # Merged rows have one unit price, so amount and quantity rise together, or
    # against each other below zero: the extremes belong to the same line.
    merged = exact.groupBy(*schemas.ODS_COUPONS.names, "promo_type", "_price", "_discount").agg(
        F.min("qty").alias("qty"),
        F.min("rpa_sat").alias("_least"),
        F.max("rpa_sat").alias("_most"),
        F.min("_promo").alias("_promo"),
    )
    amount = cents(F.when(F.col("_price") < 0, F.col("_most")).otherwise(F.col("_least")))
    # discount% of amount/qty in cents: (discount cents * amount cents) / (100 * 100 * qty)
    share = half_up(cents("_promo") * amount, F.col("qty") * 10_000)
    return merged.select(
        *schemas.ODS_COUPONS.names,
        unscale(half_up(amount, F.col("qty")), 2).alias("unit_price"),
        "promo_type",
        F.when(absolute, F.col("_promo")).when(percent, unscale(share, 2)).alias("discount"),
    )


def _one_per_price(lines: DataFrame, on: list[str]) -> DataFrame:
    """One line for all those of a bill and material with the same unit price."""
    price = ratio(F.col("rpa_sat"), F.col("qty")).alias("_price")
    # Of one unit price, amount and quantity rise together, or against each other
    # below zero; plain extremes are aggregated by hash, a struct would be sorted.
    merged = lines.groupBy(*on, price).agg(
        F.min("qty").alias("qty"), F.min("rpa_sat").alias("_least"), F.max("rpa_sat").alias("_most")
    )
    amount = F.when(F.col("_price") < 0, F.col("_most")).otherwise(F.col("_least"))
    return merged.select(*on, amount.alias("rpa_sat"), "qty")


def discount_by_store(coupons: DataFrame) -> DataFrame:
    """Total discount of each store."""
    return coupons.groupBy("plant").agg(F.sum("discount").alias("sum_discount"))
