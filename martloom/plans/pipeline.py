"""Batch runs: raw tables through the layers to the marts, in load order.

Each step is one Spark job over stored tables; a later step reads what an
earlier one wrote, so a run that stops can be started again from the top. Steps
that do not read each other run side by side. A run that is repeated writes the
months that have changed and what is derived from them: stored fingerprints of
the rows tell which.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from martloom import schemas
from martloom.functions.dates import in_window, month_window, months_between, next_month
from martloom.functions.text import (
    plan_fact_name,
    plan_fact_view_name,
    sales_mart_name,
    sales_view_name,
)
from martloom.operators import statistics
from martloom.operators.loads import LoadResult, create_table_as, full_load, load_months
from martloom.operators.stats import hot_keys
from martloom.plans import refine
from martloom.plans.audit import ERROR, Journal
from martloom.plans.plan_fact import plan_fact_mart, plan_fact_view
from martloom.plans.sales_mart import sales_mart_daily, sales_mart_view
from martloom.sources.tables import (
    declare_folders,
    declared_folders,
    read_months,
    read_partitioned,
    read_table,
)

Day = dt.date | str

# Loads that run side by side; each is a Spark job that may use the whole cluster.
SIDE_BY_SIDE = 4


class Warehouse:
    """Stored tables under one folder, with a journal of their loads.

    With ``only_changed`` a load leaves alone what holds the same rows already, or
    was derived from the same rows. Turn it off for one run after a change of the
    rules by which tables are derived. ``results`` has the last load of each table.
    """

    def __init__(self, spark: SparkSession, root: str, only_changed: bool = True):
        self.spark = spark
        self.root = root.rstrip("/")
        self.only_changed = only_changed
        self.journal = Journal(spark, f"{self.root}/journal")
        self.results: dict[str, LoadResult] = {}

    def side_by_side(self, *loads: Callable[[], object]) -> None:
        """Run independent loads; the first failure is raised when all have ended."""
        with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
            running = [pool.submit(inheritable_thread_target(self.spark)(load)) for load in loads]
        for load in running:
            load.result()

    def state(self, table: str, months: list[str] | None = None) -> str:
        """Digest of a stored table or of some of its months; empty if it is not known."""
        return statistics.state(statistics.known(self.spark, self.path(table)), months)

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str, schema: StructType) -> DataFrame:
        return read_table(self.spark, self.path(table), schema)

    def full(self, table: str, schema: StructType, source: DataFrame) -> LoadResult:
        with self.journal.load(table) as results:
            results.append(full_load(source, self.path(table), schema, truncate=True, only_changed=self.only_changed))
        return self._note(table, results[0])

    def months(
        self, table: str, schema: StructType, source: DataFrame, key: str, start: Day, end: Day,
        guard: DataFrame | None = None, derived_from: Mapping[str, bool] | None = None,
    ) -> LoadResult:
        """Replace months of a table.

        ``derived_from`` names the tables that the rows come from, and whether a
        month depends on the same month of it alone. Without it the rows arrive
        from outside, and their fingerprints are compared.
        """
        inputs = None
        if derived_from and self.only_changed:
            inputs = self._inputs(derived_from, start, end)
        arrives = self.only_changed and not derived_from
        with self.journal.load(table) as results:
            results.append(
                load_months(source, self.path(table), schema, key, start, end, guard, arrives, inputs)
            )
            if not results[0].skipped:
                self.declare(table, start, end)
        return self._note(table, results[0])

    def _inputs(self, derived_from: Mapping[str, bool], start: Day, end: Day) -> dict[str, str]:
        """Digest of what each month of the window is derived from."""
        pieces = {t: statistics.known(self.spark, self.path(t)) for t in derived_from}
        names = [f"{first:%Y%m}" for first in months_between(*month_window(start, end))]
        return {
            name: statistics.digest(
                *[statistics.state(pieces[t], [name] if monthly else None) for t, monthly in derived_from.items()]
            )
            for name in names
        }

    def replace(self, table: str, df: DataFrame, inputs: str = "") -> DataFrame:
        """Store a query result under ``table`` and read it back."""
        with self.journal.load(table) as results:
            results.append(create_table_as(df, self.path(table), inputs if self.only_changed else ""))
        self._note(table, results[0])
        return self.spark.read.schema(df.schema).parquet(self.path(table))

    def _note(self, table: str, result: LoadResult) -> LoadResult:
        self.results[table] = result
        return result

    def set_aside(self, table: str, rejects: refine.Rejects) -> None:
        """Keep rows a refinement could not read, and say so in the journal.

        The refinement has counted them, so the raw table is read again only if there are any.
        """
        if rejects.found:
            path = self.path(f"rejects/{table}")
            create_table_as(rejects.rows, path)
            self.journal.write((ERROR, f"{rejects.found} rows set aside in {path}", table))

    def declare(self, table: str, start: Day, end: Day) -> list[str]:
        """Months declared for a table, by folder, extended without gaps to hold the window."""
        path = self.path(table)
        lo, hi = month_window(start, end)
        known = declared_folders(self.spark, path)
        days = [dt.datetime.strptime(name, "%Y%m").date() for name in known]
        months = months_between(min([lo, *days]), max([hi, *map(next_month, days)]))
        names = [f"{first:%Y%m}" for first in months]
        declare_folders(self.spark, path, [name for name in names if name not in known])
        return names

    def view(self, name: str, df: DataFrame) -> DataFrame:
        df.createOrReplaceTempView(name)
        return df


def refresh_sales_mart(house: Warehouse, start: Day, end: Day | None = None) -> DataFrame:
    """Calculate the store mart of a period (or of one day) and its report view."""
    last = start if end is None else end
    bills = read_months(
        house.spark, house.path("dds_bills"), schemas.DDS_BILLS, "calday", start, last
    )
    traffic = read_months(
        house.spark, house.path("ods_traffic"), schemas.ODS_TRAFFIC, "calday", start, last
    )
    coupons = read_months(
        house.spark, house.path("dds_coupons"), schemas.DDS_COUPONS, "calday", start, last
    )
    months = [f"{first:%Y%m}" for first in months_between(*month_window(start, last))]
    facts = ("dds_bills", "ods_traffic", "dds_coupons")
    inputs = statistics.digest(*[house.state(t, months) for t in facts])
    daily = house.replace(
        sales_mart_name(start, end), sales_mart_daily(bills, coupons, traffic, start, end), inputs
    )
    stores = house.read("stores", schemas.STORES)
    return house.view(sales_view_name(start, end), sales_mart_view(daily, stores))


def run_sales_pipeline(
    house: Warehouse, sources: Mapping[str, DataFrame], start: Day, end: Day
) -> DataFrame:
    """Load all layers for a period and return the store report.

    ``sources`` holds coupons, stores, promos, promo_types, traffic, bills_head
    and bills_item as they arrive.
    """
    _load_sales_layers(house, sources, start, end)
    return refresh_sales_mart(house, start, end)


def _load_sales_layers(
    house: Warehouse, sources: Mapping[str, DataFrame], start: Day, end: Day
) -> None:
    read, full = house.read, ("coupons", "stores", "promos", "promo_types", "traffic")
    raw = {name: getattr(schemas, name.upper()) for name in (*full, "bills_head", "bills_item")}

    def arrive(table: str) -> Callable[[], object]:
        if table in full:
            return lambda: house.full(table, raw[table], sources[table])
        return lambda: house.months(table, raw[table], sources[table], "calday", start, end)

    # The largest first, so that the small ones fill the gaps.
    house.side_by_side(*map(arrive, ("bills_item", "bills_head", "coupons", "traffic", "promos", "stores", "promo_types")))

    def coupons_ods() -> None:
        raw_coupons = refine.coupons_rejects(read("coupons", schemas.COUPONS))
        _retype(house, "ods_coupons", schemas.ODS_COUPONS, "coupons", raw_coupons, refine.coupons_ods)

    def promos_ods() -> None:
        raw_promos = refine.promos_rejects(read("promos", schemas.PROMOS))
        _retype(house, "ods_promos", schemas.ODS_PROMOS, "promos", raw_promos, refine.promos_ods)

    def traffic_ods() -> None:
        traffic = refine.traffic_rejects(read("traffic", schemas.TRAFFIC))
        loaded = house.months(
            "ods_traffic", schemas.ODS_TRAFFIC, refine.traffic_ods(traffic.watch()), "calday", start, end,
            guard=traffic.raw, derived_from={"traffic": False},
        )
        if loaded.pieces:
            house.set_aside("ods_traffic", traffic)

    items = read_partitioned(house.spark, house.path("bills_item"), schemas.BILLS_ITEM)

    def bills_dds() -> None:
        heads = read_partitioned(house.spark, house.path("bills_head"), schemas.BILLS_HEAD)
        window = read_months(
            house.spark, house.path("bills_item"), schemas.BILLS_ITEM, "calday", start, end
        )
        # The header of an item may be of any month.
        house.months(
            "dds_bills", schemas.DDS_BILLS, refine.bills_dds(window, heads), "calday", start, end,
            guard=items, derived_from={"bills_item": True, "bills_head": False},
        )

    house.side_by_side(bills_dds, coupons_ods, promos_ods, traffic_ods)

    ods_coupons = read("ods_coupons", schemas.ODS_COUPONS)
    # A coupon of the window may be for a bill of any month.
    recent = ods_coupons.filter(in_window("calday", *month_window(start, end)))
    hot = [row["promo_id"] for row in hot_keys(recent, ["promo_id"]).toLocalIterator()]
    detail = refine.coupons_dds(recent, items, read("ods_promos", schemas.ODS_PROMOS), hot)
    house.months(
        "dds_coupons", schemas.DDS_COUPONS, detail, "calday", start, end, guard=ods_coupons,
        derived_from={"ods_coupons": False, "bills_item": False, "ods_promos": False},
    )


def _retype(
    house: Warehouse,
    table: str,
    schema: StructType,
    raw: str,
    source: refine.Rejects,
    refined: Callable[[DataFrame], DataFrame],
) -> None:
    """Replace a refined table, unless the table it is refined from is empty or the same as before."""
    if source.raw.isEmpty():
        with house.journal.load(table) as results:
            results.append(LoadResult(0, skipped=True))
    else:
        inputs = statistics.digest(house.state(raw))
        house.replace(table, refined(source.watch()).select(schema.names), inputs)
        if house.results[table].pieces:
            house.set_aside(table, source)


def run_plan_fact_pipeline(
    house: Warehouse,
    sources: Mapping[str, DataFrame],
    start: Day,
    end: Day,
    yyyymm: str,
) -> DataFrame:
    """Load sales, plan and their dimensions, and return the plan-and-fact report of a month.

    ``sources`` holds sales, plan, region, price, channel and product.
    """
    facts = {"sales": schemas.SALES, "plan": schemas.PLAN}
    dimensions = {
        "region": schemas.REGION,
        "price": schemas.PRICES,
        "channel": schemas.CHANNEL,
        "product": schemas.PRODUCT,
    }

    def arrive(table: str) -> Callable[[], object]:
        if table in facts:
            return lambda: house.months(table, facts[table], sources[table], "date", start, end)
        return lambda: house.full(table, dimensions[table], sources[table])

    house.side_by_side(*map(arrive, (*facts, *dimensions)))

    first = dt.datetime.strptime(yyyymm, "%Y%m").date()
    sales = read_months(house.spark, house.path("sales"), schemas.SALES, "date", first, first)
    plan = read_months(house.spark, house.path("plan"), schemas.PLAN, "date", first, first)
    product = house.read("product", schemas.PRODUCT)
    inputs = statistics.digest(house.state("sales", [yyyymm]), house.state("plan", [yyyymm]), house.state("product"))
    mart = house.replace(plan_fact_name(yyyymm), plan_fact_mart(sales, plan, product, yyyymm), inputs)
    return house.view(
        plan_fact_view_name(yyyymm),
        plan_fact_view(
            mart,
            house.read("region", schemas.REGION),
            house.read("channel", schemas.CHANNEL),
            product,
            house.read("price", schemas.PRICES),
        ),
    )
