"""The warehouse's source tables, bound to the supplied test tables.

Every frame reads its whole tables. Rows that must not find a partner are made
by giving them an unknown key, never by leaving out part of a table.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.operators.joins import checked_join, fact_join


class Frames:
    """Source tables over the Parquet files of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """A supplied table; its file footers are looked at once per instance."""
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._raw[name]

    @cached_property
    def stores(self) -> DataFrame:
        return self.raw("nation").selectExpr(
            "lpad(cast(n_nationkey as string), 4, '0') as plant", "n_name as txt"
        )

    @cached_property
    def bills_head(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "o_orderkey as billnum",
            "lpad(cast(o_custkey % 25 as string), 4, '0') as plant",
            "cast(o_orderdate as date) as calday",
        )

    @cached_property
    def bills_item(self) -> DataFrame:
        return self.raw("lineitem").selectExpr(
            "l_orderkey as billnum",
            "cast(l_linenumber as bigint) as billitem",
            "l_partkey as material",
            "cast(l_quantity as bigint) as qty",
            "cast(l_extendedprice as decimal(17,2)) as netval",
            "cast(cast(l_extendedprice as decimal(17,2)) * cast(l_tax as decimal(4,2))"
            " as decimal(17,2)) as tax",
            "cast(l_extendedprice as decimal(17,2)) as rpa_sat",
            "cast(l_shipdate as date) as calday",
        )

    @cached_property
    def traffic(self) -> DataFrame:
        return self.raw("events").selectExpr(
            "lpad(cast(user_id % 23 as string), 4, '0') as plant",
            "date_format(ts - interval 29 year, 'dd.MM.yyyy') as date",
            "date_format(ts, 'HHmmss') as time",
            "event_type as frame_id",
            "cast(floor(value) as int) + 1 as quantity",
        )

    @cached_property
    def coupons(self) -> DataFrame:
        """A coupon per line, some twice; lines sold at less than 5 % off have an unknown promotion."""
        lines = self.raw("lineitem")
        plants = self.bills_head.select(F.col("billnum").alias("l_orderkey"), "plant")
        joined = fact_join(lines, plants, ["l_orderkey"])
        return joined.withColumn(
            "copy", F.expr("explode(sequence(0, if(l_partkey % 10 = 0, 1, 0)))")
        ).selectExpr(
            "plant",
            "replace(cast(cast(l_shipdate as date) as string), '-', '') as calday",
            "lpad(cast(l_linenumber as string), 7, '0') as coupon_nm",
            "if(l_tax = 0.08 or l_discount < 0.05, 'UNKNOWN',"
            " 'PROMO' || cast(l_partkey % 60 as string)) as promo_id",
            "cast(l_partkey as string) as material",
            "cast(l_orderkey as string) as billnum",
        )

    @cached_property
    def promos(self) -> DataFrame:
        return self.raw("part").selectExpr(
            "'PROMO' || cast(p_partkey as string) as promo_id",
            "p_name as txt",
            "case when p_partkey % 10 = 7 then '003' when p_partkey % 2 = 0 then '001'"
            " else '002' end as promo_type",
            "cast(p_partkey as string) as material",
            "cast(p_size as decimal(17,2)) as discount",
        )

    @cached_property
    def promo_types(self) -> DataFrame:
        kinds = self.promos.select("promo_type").distinct()
        return kinds.selectExpr("promo_type", "'type ' || promo_type as txt")

    @cached_property
    def sales(self) -> DataFrame:
        """Sales lines; some of an unknown material, and materials of unknown quantity."""
        return self.raw("lineitem").selectExpr(
            "cast(l_orderkey as string) as check_nm",
            "cast(l_linenumber as string) as check_pos",
            "'R' || cast(l_suppkey % 5 as string) as region",
            "if(l_tax = 0.08 and l_discount = 0.1, 'X', '') || cast(l_partkey as string)"
            " as material",
            "l_returnflag as distr_chan",
            "case when l_partkey % 997 = 0 then null else cast(l_quantity as int) end"
            " as quantity",
            "cast(l_shipdate as date) as date",
        )

    @cached_property
    def product(self) -> DataFrame:
        return self.raw("part").selectExpr(
            "cast(p_partkey as string) as material",
            "case when p_partkey % 11 = 0 then '' when p_partkey % 13 = 0 then null"
            " else p_type end as asgrp",
            "p_brand as brand",
            "left(p_type, 1) as matcateg",
            "p_type as matdirec",
            "p_name as txt",
        )

    @cached_property
    def region(self) -> DataFrame:
        return self.raw("region").selectExpr(
            "'R' || cast(r_regionkey as string) as region", "r_name as txt"
        )

    @cached_property
    def channel(self) -> DataFrame:
        codes = self.raw("lineitem").select(F.col("l_returnflag").alias("dist_chan")).distinct()
        return codes.selectExpr("dist_chan", "'channel ' || dist_chan as txtsh")

    @cached_property
    def prices(self) -> DataFrame:
        """Each part in every region and channel; economy parts are not sold in channel A."""
        # Lists of a few codes each, one value for the whole query.
        regions = self.raw("region").agg(F.collect_set("r_regionkey")).scalar()
        codes = self.channel.agg(F.collect_set("dist_chan")).scalar()
        economy = F.col("p_type") == "ECONOMY"
        channels = F.when(economy, F.array_remove(codes, "A")).otherwise(codes)
        listed = self.raw("part").select(
            "p_partkey", "p_retailprice", F.explode(regions).alias("region_no"), channels.alias("channels")
        )
        return listed.selectExpr(
            "cast(p_partkey as string) as material",
            "'R' || cast(region_no as string) as region",
            "explode(channels) as dist_chan",
            "cast(p_retailprice + region_no as decimal(19,4)) as price",
        )

    @cached_property
    def plan(self) -> DataFrame:
        """A tenth more than was sold in the month before; one region and channel plans zero."""
        directions = self.product.select("material", "matdirec")
        sold = (
            self.sales.groupBy(
                F.trunc("date", "month").alias("month"), "region", "material", "distr_chan"
            )
            .agg(F.sum("quantity").alias("quantity"))
            .transform(fact_join, directions, ["material"])
            .groupBy("month", "region", "matdirec", "distr_chan")
            .agg(F.sum("quantity").alias("quantity"))
        )
        return sold.selectExpr(
            "cast(add_months(month, 1) as date) as date",
            "region",
            "matdirec",
            "cast(case when region = 'R4' and distr_chan = 'N' then 0"
            " else quantity * 11 div 10 end as int) as quantity",
            "distr_chan",
        )

    @cached_property
    def real_estate(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "cast(o_totalprice as decimal(17,2)) as sale_price", "o_orderdate as date"
        )

    @cached_property
    def songs(self) -> DataFrame:
        return self.raw("part").selectExpr(
            "p_partkey as track_id", "p_brand as track_album_id", "p_size as track_popularity"
        )

    @cached_property
    def songs_artists(self) -> DataFrame:
        return self.raw("lineitem").selectExpr(
            "l_partkey as track_id",
            "'track ' || cast(l_partkey as string) as track_name",
            "l_returnflag as track_artist",
            "cast(cast(l_quantity as int) as string) as duration_ms",
        )
