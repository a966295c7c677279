"""Declared schemas of every table the jobs read or write.

Blank-padded text columns carry ``padded`` metadata: their trailing blanks are
not part of the value, so ingest trims them (see ``operators.quality.conform``).
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

MONEY = DecimalType(17, 2)
PRICE = DecimalType(19, 4)

_TYPES: dict[str, DataType] = {
    "text": StringType(),
    "padded": StringType(),
    "int": IntegerType(),
    "long": LongType(),
    "money": MONEY,
    "price": PRICE,
    "date": DateType(),
    "timestamp": TimestampType(),
    "bool": BooleanType(),
    "float": FloatType(),
}


def table(declaration: str) -> StructType:
    """Schema from ``name type`` pairs; a trailing ``!`` marks a required column."""
    fields = []
    for column in declaration.split(","):
        name, kind = column.split()
        required = kind.endswith("!")
        kind = kind.rstrip("!")
        metadata = {"padded": True} if kind == "padded" else {}
        fields.append(StructField(name, _TYPES[kind], not required, metadata))
    return StructType(fields)


# Plan-and-fact model
PRICES = table("material text!, region text!, dist_chan text!, price price")
PRODUCT = table(
    "material text!, asgrp text, brand text, matcateg text, matdirec text, txt text"
)
CHANNEL = table("dist_chan text!, txtsh text")
REGION = table("region text!, txt text")
SALES = table(
    "check_nm text!, check_pos text!, region text, material text, distr_chan text,"
    "quantity int, date date"
)
PLAN = table("date date!, region text!, matdirec text!, quantity int, distr_chan text!")

# Raw layer
TRAFFIC = table("plant padded, date padded, time padded, frame_id padded, quantity int")
BILLS_HEAD = table("billnum long, plant padded, calday date")
BILLS_ITEM = table(
    "billnum long, billitem long, material long, qty long, netval money, tax money,"
    "rpa_sat money, calday date"
)
COUPONS = table(
    "plant padded, calday padded, coupon_nm padded, promo_id padded, material padded,"
    "billnum padded"
)
STORES = table("plant padded, txt padded")
PROMOS = table(
    "promo_id padded, txt padded, promo_type padded, material padded, discount money"
)
PROMO_TYPES = table("promo_type padded, txt padded")

# Operational layer: retyped
ODS_TRAFFIC = table("plant padded, calday date, time padded, frame_id padded, quantity int")
ODS_COUPONS = table(
    "plant padded, calday date, coupon_nm padded, promo_id padded, material long, billnum long"
)
ODS_PROMOS = table(
    "promo_id padded, txt padded, promo_type padded, material long, discount money"
)

# Detail layer: joined
DDS_BILLS = table(
    "billnum long, billitem long, material long, plant padded, qty long, netval money,"
    "tax money, rpa_sat money, calday date"
)
DDS_COUPONS = table(
    "plant padded, calday date, coupon_nm padded, promo_id padded, material long,"
    "billnum long, unit_price money, promo_type padded, discount money"
)

# Serving copies: narrow numbers, cast only when a mart is exported
SERVING_PLAN_FACT = table(
    "region text, matdirec text, distr_chan text, sales_qt int, plan_qt int,"
    "plan_exec_perc float, material text"
)
SERVING_SALES_DAILY = table(
    "calday date, plant text, turnover float, sum_coupon_discount float,"
    "count_materials float, bills_count int, total_traffic int,"
    "discount_material_count int, avg_bill float"
)
SERVING_SALES_REPORT = table(
    "plant_name text, plant text, turnover float, sum_coupon_discount float,"
    "turnover_with_discount float, count_materials float, bills_count float,"
    "total_traffic float, discount_material_count float, discount_materials_share float,"
    "avg_materials float, conversion float, avg_bill float, avg_revenue_per_visitor float"
)

# Load journal
AUDIT = table(
    "log_id text!, log_timestamp timestamp!, log_type text!, log_msg text!,"
    "log_location text, is_error bool, log_user text"
)
