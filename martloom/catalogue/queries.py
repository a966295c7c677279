"""One query per operator, over the supplied test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom import schemas
from martloom.catalogue.frames import Frames
from martloom.functions import dates, text
from martloom.operators import filters, loads, lookup, partitions, quality, shards, statistics, stats
from martloom.operators.joins import fact_join
from martloom.plans import pipeline, plan_fact, refine, sales_mart, serving
from martloom.session import fresh_path
from martloom.sources import delimited
from martloom.sources.tables import empty_table, read_partitioned, read_table
from martloom.streaming import arrivals

# Periods of the test tables with interesting rows.
START, END = "1995-01-01", "1995-02-28"
ONE_DAY = "1995-01-14"
MONTH = "199601"
TIES_MONTH = "199703"
YEAR = "1996-01-01"

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}


def query(run: Callable[[Frames], DataFrame]) -> Callable[[Frames], DataFrame]:
    _queries[run.__name__] = lambda spark, folder: run(Frames(spark, folder))
    return run


def all_queries() -> dict[str, Query]:
    return dict(_queries)


# ---- layers ------------------------------------------------------------------


def _ods_traffic(f: Frames) -> DataFrame:
    return refine.traffic_ods(f.traffic)


def _dds_bills(f: Frames) -> DataFrame:
    return refine.bills_dds(f.bills_item, f.bills_head)


def _dds_coupons(f: Frames, start=None, end=None) -> DataFrame:
    return refine.coupons_dds(
        refine.coupons_ods(f.coupons, start, end), f.bills_item, refine.promos_ods(f.promos)
    )


def _daily(f: Frames, start=START, end=END, **options) -> DataFrame:
    return sales_mart.sales_mart_daily(
        _dds_bills(f), _dds_coupons(f, start, end), _ods_traffic(f), start, end, **options
    )


def _older(items: DataFrame) -> DataFrame:
    """An earlier state of the bill items: every quantity was one higher."""
    return items.withColumn("qty", F.col("qty") + 1)


def _window(f: Frames, schema, rows: DataFrame, key: str = "calday") -> DataFrame:
    """Load a window of months into a table that is still empty."""
    nothing = empty_table(f.spark, schema)
    return partitions.delta_partition_load(rows, nothing, key, START, END)


# ---- sales mart ----------------------------------------------------------------


@query
def discounts_daily(f):
    return sales_mart.discounts_daily(_dds_coupons(f, START, END), START, END)


@query
def bills_daily(f):
    return sales_mart.bills_daily(_dds_bills(f), START, END)


@query
def distinct_bills(f):
    """Distinct bills per store from a Tuesday to a Monday, from stored bitmaps of two months."""
    path = fresh_path(f.spark, "bill_sets")
    loads.create_table_as(sales_mart.bill_sets(_dds_bills(f), START, END), path)
    sets = f.spark.read.parquet(path)
    return sales_mart.distinct_bills(sets, ["plant"], "1995-01-10", "1995-02-20")


@query
def traffic_daily(f):
    return sales_mart.traffic_daily(_ods_traffic(f), START, END)


@query
def sales_mart_daily(f):
    return _daily(f)


@query
def sales_mart_one_day(f):
    return _daily(f, ONE_DAY, None)


@query
def sales_mart_daily_avg(f):
    return _daily(f, with_avg_materials=True)


@query
def sales_mart_view(f):
    return sales_mart.sales_mart_view(_daily(f), f.stores)


@query
def sales_mart_export(f):
    report = sales_mart.sales_mart_view(_daily(f), f.stores)
    return serving.export_types(report, schemas.SERVING_SALES_REPORT)


# ---- plan and fact -------------------------------------------------------------


def _plan_fact(f: Frames, month: str = MONTH) -> DataFrame:
    return plan_fact.plan_fact_mart(f.sales, f.plan, f.product, month)


@query
def sales_by_direction(f):
    return plan_fact.sales_by_direction(f.sales, f.product, MONTH)


@query
def plan_by_direction(f):
    return plan_fact.plan_by_direction(f.plan, MONTH)


@query
def top_material_by_region(f):
    return plan_fact.top_material_by_region(f.sales, f.product, MONTH)


@query
def plan_fact_mart(f):
    return _plan_fact(f)


@query
def plan_fact_mart_ties(f):
    return _plan_fact(f, TIES_MONTH)


@query
def plan_fact_view(f):
    return plan_fact.plan_fact_view(_plan_fact(f), f.region, f.channel, f.product, f.prices)


# ---- refinement ----------------------------------------------------------------


@query
def load_traffic_ods(f):
    return _window(f, schemas.ODS_TRAFFIC, _ods_traffic(f))


@query
def load_coupons_ods(f):
    return refine.coupons_ods(f.coupons)


@query
def hot_keys(f):
    """Promotions with at least half a percent of all coupons."""
    return stats.hot_keys(f.coupons, ["promo_id"], 0.005)


@query
def skewed_coupons_dds(f):
    """The coupon detail with the coupons of hot promotions spread over many tasks."""
    coupons = refine.coupons_ods(f.coupons)
    hot = [row["promo_id"] for row in stats.hot_keys(coupons, ["promo_id"]).toLocalIterator()]
    return refine.coupons_dds(coupons, f.bills_item, refine.promos_ods(f.promos), hot)


@query
def load_promos_ods(f):
    return refine.promos_ods(f.promos)


@query
def load_coupons_dds(f):
    return _dds_coupons(f)


@query
def load_bills_dds(f):
    older = refine.bills_dds(_older(f.bills_item), f.bills_head)
    return partitions.delta_partition_load(_dds_bills(f), older, "calday", START, END)


@query
def discount_by_store(f):
    totals = refine.discount_by_store(_dds_coupons(f))
    return totals.withColumn("sum_discount", F.col("sum_discount").cast("decimal(27,2)"))


# ---- loads ---------------------------------------------------------------------


@query
def not_empty_filter(f):
    return quality.not_empty(f.product, schemas.PRODUCT)


@query
def full_load(f):
    path = fresh_path(f.spark, "product")
    loads.full_load(f.product, path, schemas.PRODUCT, truncate=True)
    return read_table(f.spark, path, schemas.PRODUCT)


@query
def insert_select(f):
    path = fresh_path(f.spark, "stores_and_promos")
    loads.insert_select(
        f.promos, path, schemas.PROMOS, F.col("promo_type") == "001", truncate=True
    )
    loads.insert_select(f.promos, path, schemas.PROMOS, F.col("promo_type") == "003")
    loads.insert_select(f.promos, path, schemas.PROMOS)
    return read_table(f.spark, path, schemas.PROMOS)


@query
def delta_partition_load(f):
    return partitions.delta_partition_load(
        f.bills_item, _older(f.bills_item), "calday", START, END
    )


@query
def month_partitions(f):
    """Months declared for the first sales month, extended past the last sale."""
    span = f.bills_item.agg(F.min("calday").alias("lo"), F.max("calday").alias("hi"))
    return partitions.declared_months(span, "lo", "lo", "hi")


@query
def partition_routing(f):
    routed = partitions.route_partitions(f.bills_item, "calday", "1995-06-01", "1997-01-01")
    return routed.groupBy("month").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("calday").alias("first_day")
    )


@query
def partition_validation(f):
    """Rows a swap of the window would refuse, by month."""
    lo, hi = dates.month_window(START, END)
    wrong = quality.outside_partition(f.bills_item, "calday", lo, hi)
    return wrong.groupBy(F.trunc("calday", "month").alias("month")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


@query
def table_stats(f):
    found = stats.table_stats(f.bills_item, exact=("billitem", "qty"))
    known = F.col("column_name").isin("billitem", "qty")
    return found.withColumn("distinct_count", F.when(known, F.col("distinct_count")))


@query
def replaced_load(f):
    """A product table after a replacement that fails while its rows are written."""
    path = fresh_path(f.spark, "product")
    loads.full_load(f.product, path, schemas.PRODUCT, truncate=True)
    unknown = f.product.withColumn("material", F.when(F.col("material") != "1", F.col("material")))
    try:
        loads.create_table_as(quality.require(unknown, schemas.PRODUCT), path)
    except PySparkException:
        pass  # What is read back shows that the table is as it was.
    return read_table(f.spark, path, schemas.PRODUCT)


def _items_on_disk(f: Frames) -> str:
    """Items on disk: months declared for three years, two reloaded, the second by nothing."""
    path = fresh_path(f.spark, "bills_item")
    loads.load_all_months(
        _older(f.bills_item), path, schemas.BILLS_ITEM, "calday", "1994-01-01", "1997-01-01"
    )
    delta = f.bills_item.filter(~dates.in_window("calday", *dates.month_window(END, END)))
    loads.load_months(delta, path, schemas.BILLS_ITEM, "calday", START, END)
    return path


@query
def load_months(f):
    return read_partitioned(f.spark, _items_on_disk(f), schemas.BILLS_ITEM, keep_month=True)


@query
def table_stats_merged(f):
    """Statistics of that table from those of its months; no item is read for them."""
    found = statistics.table_stats_merged(f.spark, _items_on_disk(f), schemas.BILLS_ITEM)
    known = F.col("column_name").isin("billitem", "qty")
    return found.withColumn("distinct_count", F.when(known, F.col("distinct_count")))


@query
def late_arrivals(f):
    """Items of two months that arrive in three files: an older state of some, all others, late and repeated ones."""
    window = f.bills_item.filter(dates.in_window("calday", *dates.month_window(START, END)))
    even = F.col("billnum") % 2 == 0
    landing = fresh_path(f.spark, "landing")
    files = (_older(window.filter(even)), window.filter(~even), window.filter(even | (F.col("billnum") % 3 == 0)))
    for number, rows in enumerate(files):
        rows.coalesce(1).write.parquet(f"{landing}/{number}")
    path, arrived, checkpoint = (fresh_path(f.spark, n) for n in ("bills_item", "arrived", "checkpoint"))
    arrivals.load_arrivals(
        f.spark, f"{landing}/*", path, schemas.BILLS_ITEM, "calday", ["billnum", "billitem"], arrived, checkpoint, 1
    )
    return read_partitioned(f.spark, path, schemas.BILLS_ITEM)


# ---- serving -------------------------------------------------------------------


@query
def dict_lookup(f):
    by_material = [
        lookup.Dictionary(f.product, "material", {"brand": "brand", "txt": "product_name"}),
        lookup.Dictionary(f.prices, "material", {"price": "price"}, ("region", "dist_chan")),
    ]
    priced = lookup.dict_lookups(f.sales, "material", by_material)
    return priced.select("check_nm", "check_pos", "material", "brand", "product_name", "price")


@query
def plan_fact_report(f):
    return serving.plan_fact_report(_plan_fact(f), f.region, f.channel, f.product, f.prices)


@query
def plan_fact_export(f):
    return serving.export_types(_plan_fact(f), schemas.SERVING_PLAN_FACT)


def _written(f: Frames, mart: DataFrame, name: str) -> DataFrame:
    """A mart as later steps find it: stored."""
    path = fresh_path(f.spark, name)
    loads.create_table_as(mart, path)
    return f.spark.read.schema(mart.schema).parquet(path)


@query
def daily_export(f):
    return serving.export_types(_written(f, _daily(f), "daily"), schemas.SERVING_SALES_DAILY)


@query
def sharded_copy(f):
    """The daily mart, stored by shard of store and day, with the number of shards of each store day."""
    path = fresh_path(f.spark, "shards")
    serving.publish_sales(_written(f, _daily(f), "daily"), path, 4)
    copy = f.spark.read.parquet(path)
    places = copy.groupBy("calday", "plant").agg(F.count_distinct("bucket").alias("shards"))
    return copy.drop("bucket").join(places, ["calday", "plant"])


@query
def plan_fact_copy(f):
    path = fresh_path(f.spark, "shards")
    serving.publish_plan_fact(_written(f, _plan_fact(f), "plan_fact"), path, 2)
    return f.spark.read.parquet(path).drop("bucket")


# Items a bucket of ``colocated_join`` holds at most, so that one task's rows stay bounded.
ITEMS_A_BUCKET = 1_000_000


@query
def colocated_join(f):
    """Bills of both facts from tables bucketed alike, totalled without a shuffle.

    Both tables get 8 buckets, or more as the items grow: one per million items.
    """
    run = uuid.uuid4().hex
    buckets = max(8, -(-f.bills_item.count() // ITEMS_A_BUCKET))
    stored = []
    for name, fact in (("items", f.bills_item), ("heads", f.bills_head)):
        path = fresh_path(f.spark, name)
        stored.append(loads.save_bucketed(fact, f"{name}_{run}", path, ["billnum"], buckets))
    items, heads = stored
    # What has been looked up needs no name in the catalog any more; the files stay.
    for name in ("items", "heads"):
        f.spark.sql(f"DROP TABLE {name}_{run}")
    joined = fact_join(items, heads.select("billnum", "plant"), ["billnum"])
    return joined.groupBy("billnum", "plant").agg(
        F.count(F.lit(1)).alias("item_count"), F.sum("rpa_sat").cast("decimal(27,2)").alias("turnover")
    )


@query
def sales_report(f):
    return serving.sales_report(_daily(f), f.stores)


@query
def point_lookup(f):
    keys = {"region": "R2", "matdirec": "ECONOMY", "distr_chan": "A"}
    return serving.point_lookup(_plan_fact(f), keys)


@query
def stored_point_lookup(f):
    """The same rows as ``point_lookup``, from the one shard of the published mart that has them."""
    path, mart = fresh_path(f.spark, "shards"), _plan_fact(f)
    serving.publish_plan_fact(mart, path, 8)
    return serving.plan_fact_lookup(f.spark, path, mart.schema, "R2", "ECONOMY", "A")


@query
def shard_distribution(f):
    """Items per shard of the bill number, which other engines can compute too."""
    placed = f.bills_item.withColumn("bucket", F.pmod("billnum", F.lit(16)).cast("int"))
    return shards.shard_distribution(placed)


@query
def shard_hash_totals(f):
    """Hash shards of store and day: each is in one shard with all its rows."""
    days = [F.col("plant"), dates.day_number("calday")]
    placed = shards.shard(_dds_bills(f), days, 4).groupBy("calday", "plant", "bucket").count()
    return placed.groupBy("calday", "plant").agg(
        F.count(F.lit(1)).alias("shards"), F.sum("count").alias("row_count")
    )


# ---- filters -------------------------------------------------------------------



def _artist():
    return F.col("track_artist") == "R"


def _song(joined: DataFrame) -> DataFrame:
    return joined.select("track_id", "track_name", "track_album_id", "track_popularity")


@query
def year_trunc_sum(f):
    return filters.sum_of_truncated_period(f.real_estate, "date", "year", YEAR, "sale_price")


@query
def year_range_sum(f):
    return filters.sum_of_period(f.real_estate, "date", "year", YEAR, "sale_price")


@query
def union_all_filters(f):
    numbers = filters.whole_number_between("duration_ms", 10, 20)
    return _song(
        filters.union_all_filters(f.songs_artists, f.songs, ["track_id"], _artist(), numbers)
    )


@query
def or_filter_join(f):
    texts = filters.text_between("duration_ms", "10", "20")
    return _song(filters.or_filter_join(f.songs_artists, f.songs, ["track_id"], _artist(), texts))


@query
def distinct_then_join(f):
    numbers = filters.whole_number_between("duration_ms", 10, 20)
    columns = ["track_id", "track_name"]
    return _song(
        filters.distinct_then_join(
            f.songs_artists, f.songs, ["track_id"], _artist(), numbers, columns
        )
    )


@query
def text_between(f):
    return f.songs_artists.filter(filters.text_between("duration_ms", "10", "20"))


# ---- functions -----------------------------------------------------------------


@query
def date_functions(f):
    day = "calday"
    return f.bills_head.select(
        "billnum",
        F.trunc(day, "month").alias("month_start"),
        F.trunc(day, "year").alias("year_start"),
        dates.month_end(day).alias("month_end"),
        F.add_months(day, 1).alias("next_month"),
        dates.day_text(day).alias("day_text"),
        dates.day_number(day).alias("day_number"),
        dates.month_key(day).alias("month_key"),
        dates.parse_day(dates.day_text(day), dates.COMPACT_DAY).alias("parsed_compact"),
        dates.parse_day(F.date_format(day, "dd.MM.yyyy"), dates.DOTTED_DAY).alias("parsed_dotted"),
        F.to_date(dates.month_key(day), dates.YEAR_MONTH).alias("parsed_month"),
        dates.period_range(day, "year", YEAR).alias("in_year"),
    )


@query
def string_functions(f):
    name = F.concat(F.lit("Raw."), F.col("p_name"), F.lit("."), F.col("p_brand"))
    named = f.raw("part").select("p_partkey", name.alias("full_name"))
    return named.select(
        "p_partkey",
        F.upper("full_name").alias("upper_name"),
        F.lower("full_name").alias("lower_name"),
        F.replace("full_name", F.lit("."), F.lit("''")).alias("replaced"),
        F.left("full_name", F.lit(3)).alias("left_part"),
        F.right("full_name", F.lit(3)).alias("right_part"),
        F.instr("full_name", ".").alias("dot_at"),
        F.length("full_name").alias("name_length"),
        text.schema_part("full_name").alias("schema_part"),
        text.table_part("full_name").alias("table_part"),
        F.format_string("%s_%s", F.col("full_name"), F.col("p_partkey")).alias("formatted"),
    )


@query
def normalize_key(f):
    messy = F.concat(F.lit("  ';"), F.col("p_name"), F.lit("/"), F.col("p_brand"), F.lit("; "))
    return f.raw("part").select("p_partkey", text.normalize_key(messy).alias("key"))


# ---- sources, audit, whole runs --------------------------------------------------


def _as_file(f: Frames, df: DataFrame, name: str) -> str:
    path = fresh_path(f.spark, name)
    delimited.write_delimited(df, path)
    return path


@query
def csv_scan(f):
    path = _as_file(f, f.product, "product.csv")
    staging = fresh_path(f.spark, "product_staging")
    return delimited.read_delimited(f.spark, path, schemas.PRODUCT, staging=staging)


@query
def csv_rejects(f):
    """Items from a file in which every gift line has no readable quantity."""
    quantity = F.when(F.col("qty") == 50, F.lit("fifty")).otherwise(F.col("qty").cast("string"))
    path = _as_file(f, f.bills_item.withColumn("qty", quantity), "bills_item.csv")
    scan = delimited.scan_delimited(f.spark, path, schemas.BILLS_ITEM)
    return scan.groupBy(F.col(delimited.REJECT).isNotNull().alias("rejected")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("billnum").alias("sum_billnum"),
        F.sum("rpa_sat").cast("decimal(27,2)").alias("sum_rpa_sat"),
    )


@query
def reject_limit(f):
    """One file of promotions with unreadable discounts, read with a limit above and at their number."""
    discount = F.when(F.col("discount") == 50, F.lit("fifty")).otherwise(F.col("discount").cast("string"))
    path = _as_file(f, f.promos.withColumn("discount", discount), "promos.csv")
    staging = fresh_path(f.spark, "promos_staging")
    scan = delimited.scan_delimited(f.spark, path, schemas.PROMOS)
    scan.write.parquet(staging)
    bad = delimited.rejected(f.spark.read.schema(scan.schema).parquet(staging)).count()
    outcomes = []
    for over in (1, 0):
        limit = F.lit(over).alias("limit_over_rejects")
        try:
            read = delimited.read_delimited(
                f.spark, path, schemas.PROMOS, reject_limit=bad + over, staging=f"{staging}_{over}"
            )
            counted = read.agg(F.count(F.lit(1)).alias("row_count"), F.sum("discount").cast("decimal(27,2)").alias("sum_discount"))
            outcomes.append(counted.select(limit, F.lit(True).alias("loaded"), "row_count", "sum_discount"))
        except delimited.RejectLimitReached:
            none = [F.lit(None).cast(t).alias(n) for n, t in (("row_count", "bigint"), ("sum_discount", "decimal(27,2)"))]
            outcomes.append(f.spark.range(1).select(limit, F.lit(False).alias("loaded"), *none))
    return reduce(DataFrame.unionByName, outcomes)


@query
def audit_log(f):
    """Journal of real loads: whole, by month, from an empty source, and one that fails."""
    house = pipeline.Warehouse(f.spark, fresh_path(f.spark, "audited"))
    house.full("Product", schemas.PRODUCT, f.product)
    house.full("Traffic", schemas.TRAFFIC, f.traffic)
    house.full("Region", schemas.REGION, empty_table(f.spark, schemas.REGION).limit(0))
    house.months("Bills_Item", schemas.BILLS_ITEM, f.bills_item, "calday", START, END)
    unknown = f.channel.unionByName(f.channel.withColumn("dist_chan", F.lit(None).cast("string")))
    try:
        house.replace("Channel", quality.require(unknown, schemas.CHANNEL))
    except PySparkException:
        pass  # The journal has it, as it has what the others did.
    return house.journal.outcomes()


SALES_SOURCES = ("coupons", "stores", "promos", "promo_types", "traffic", "bills_head", "bills_item")


@query
def pipeline_run(f):
    house = pipeline.Warehouse(f.spark, fresh_path(f.spark, "warehouse"))
    return pipeline.run_sales_pipeline(house, {t: getattr(f, t) for t in SALES_SOURCES}, START, END)


def _run_again(f: Frames) -> tuple[pipeline.Warehouse, DataFrame]:
    """A run in which January's items are an older state, and one in which they are not."""
    house = pipeline.Warehouse(f.spark, fresh_path(f.spark, "warehouse"))
    sources = {t: getattr(f, t) for t in SALES_SOURCES}
    january = dates.in_window("calday", *dates.month_window(START, START))
    items = f.bills_item
    older = items.withColumn("qty", F.when(january, F.col("qty") + 1).otherwise(F.col("qty")))
    pipeline.run_sales_pipeline(house, sources | {"bills_item": older}, START, END)
    return house, pipeline.run_sales_pipeline(house, sources, START, END)


@query
def pipeline_rerun(f):
    return _run_again(f)[1]


@query
def rerun_months(f):
    """Rows that the second of these runs wrote, for each month of each fact; NULL for a month it left alone."""
    house, _ = _run_again(f)
    rows = [
        (table, month, house.results[table].months.get(month))
        for table in ("bills_head", "bills_item", "ods_traffic", "dds_bills", "dds_coupons")
        for month in [f"{first:%Y%m}" for first in dates.months_between(*dates.month_window(START, END))]
    ]
    return f.spark.createDataFrame(rows, "table_name string, month string, rows_written bigint")


@query
def plan_fact_pipeline_run(f):
    house = pipeline.Warehouse(f.spark, fresh_path(f.spark, "warehouse"))
    sources = {
        "sales": f.sales, "plan": f.plan, "region": f.region, "price": f.prices,
        "channel": f.channel, "product": f.product,
    }
    return pipeline.run_plan_fact_pipeline(
        house, sources, "1996-01-01", "1996-08-01", MONTH
    )
