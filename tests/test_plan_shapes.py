"""Physical plans: what reaches the scan, what is shuffled, and what never appears."""

import re

import pytest
from conftest import day, formatted_plan_of, optimized_plan_of, plan_of

from martloom.catalogue.frames import Frames
from martloom.catalogue.queries import all_queries
from martloom.operators import partitions
from martloom.plans import plan_fact, refine, sales_mart

FOLDER = "/root/testdata/sf0.001"
WRITING = {
    "pipeline_run", "plan_fact_pipeline_run", "load_months", "audit_log", "reject_limit", "daily_export",
    "sharded_copy", "plan_fact_copy", "replaced_load", "late_arrivals", "distinct_bills", "stored_point_lookup", "skewed_coupons_dds", "hot_keys",
    "pipeline_rerun", "rerun_months",
}


@pytest.mark.parametrize("name", sorted(set(all_queries()) - WRITING))
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(all_queries()[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Arrow"):
        assert operator not in plan
    assert "Window" not in plan


def pushed(df):
    return re.findall(r"PushedFilters: \[([^\n]*)\]\n", formatted_plan_of(df))


def test_range_reaches_the_scan_and_truncation_does_not(spark):
    queries = all_queries()
    assert "GreaterThanOrEqual(o_orderdate" in pushed(queries["year_range_sum"](spark, FOLDER))[0]
    assert not any("o_orderdate," in f for f in pushed(queries["year_trunc_sum"](spark, FOLDER)))


def test_periods_reach_the_scan_of_the_facts(spark):
    filters = pushed(all_queries()["bills_daily"](spark, FOLDER))
    assert any("GreaterThanOrEqual(l_shipdate" in f for f in filters)
    filters = pushed(all_queries()["sales_by_direction"](spark, FOLDER))
    assert any("GreaterThanOrEqual(l_shipdate" in f for f in filters)


def test_delta_load_shuffles_nothing_and_filters_in_both_scans(spark, tmp_path):
    assert "Exchange" not in plan_of(all_queries()["delta_partition_load"](spark, FOLDER))
    items = Frames(spark, FOLDER).bills_item
    for name in ("old", "new"):
        items.write.parquet(str(tmp_path / name))
    old, new = (spark.read.parquet(str(tmp_path / name)) for name in ("old", "new"))
    loaded = partitions.delta_partition_load(new, old, "calday", "1995-01-01", "1995-02-28")
    kept, replaced = pushed(loaded)
    assert "IsNull(calday)" in kept and "LessThan(calday,1995-01-01)" in kept
    assert "GreaterThanOrEqual(calday,1995-01-01), LessThan(calday,1995-03-01)" in replaced


def test_only_needed_columns_are_read(spark):
    plan = formatted_plan_of(all_queries()["year_range_sum"](spark, FOLDER))
    schema = re.search(r"ReadSchema: (\S+)", plan).group(1)
    assert schema == "struct<o_totalprice:double,o_orderdate:timestamp_ntz>"


def exchanges(plan):
    return re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan)


def test_bill_totals_reuse_the_placement_of_the_bill_join(spark, no_broadcast):
    f = Frames(spark, FOLDER)
    bills = refine.bills_dds(f.bills_item, f.bills_head)
    plan = plan_of(sales_mart.bills_daily(bills, "1995-01-01", "1995-02-28"))
    keys = [re.sub(r"#\d+L?", "", k) for k in exchanges(plan)]
    # Both join sides by bill, then the totals of store days: no third shuffle of bills.
    assert sorted(keys) == ["billnum", "billnum", "calday, plant"]


def test_coupons_meet_lines_by_material_and_bill(spark, no_broadcast):
    f = Frames(spark, FOLDER)
    detail = refine.coupons_dds(
        refine.coupons_ods(f.coupons), f.bills_item, refine.promos_ods(f.promos)
    )
    keys = [re.sub(r"#\d+L?", "", k) for k in exchanges(plan_of(detail))]
    # Coupons once, lines once merged by unit price and once placed by pair.
    assert keys.count("material, billnum") == 2
    assert sum(k.startswith("material, billnum, _price") or "material, billnum, " in k for k in keys) <= 2


def test_promotions_are_met_below_the_join_of_the_facts(spark, no_broadcast):
    f = Frames(spark, FOLDER)
    detail = refine.coupons_dds(refine.coupons_ods(f.coupons), f.bills_item, refine.promos_ods(f.promos), ["UNKNOWN"])
    lines = [line for line in plan_of(detail).splitlines() if "SortMergeJoin" in line]
    promo, fact = (next(l for l in lines if key in l) for key in ("[promo_id", "[material"))
    # Deeper in the tree is further to the right, and further down.
    assert promo.index("SortMergeJoin") > fact.index("SortMergeJoin") and lines.index(promo) > lines.index(fact)
    assert "_slice" in promo


def test_a_stored_lookup_reads_one_shard(spark, tmp_path):
    from martloom.plans import serving

    path, schema = str(tmp_path / "copy"), "region string, matdirec string, distr_chan string, n int"
    rows = [(f"R{r}", f"M{m}", f"C{c}", r * m * c) for r in range(9) for m in range(9) for c in range(3)]
    mart = spark.createDataFrame(rows, schema)
    serving.publish_plan_fact(mart, path, 8)
    found = serving.plan_fact_lookup(spark, path, mart.schema, "R3", "M4", "C2")
    assert [tuple(r) for r in found.collect()] == [("R3", "M4", "C2", 24)]
    assert serving.plan_fact_lookup(spark, path, mart.schema, "R3", "M4", "C9").isEmpty()
    plan = formatted_plan_of(found)
    assert re.search(r"PartitionFilters: \[isnotnull\(bucket#\d+\), \(bucket#\d+ = \d\)\]", plan)
    assert "EqualTo(region,R3), EqualTo(matdirec,M4), EqualTo(distr_chan,C2)" in plan
    scan = found._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.selectedPartitions().partitionCount() == 1


def test_bucketed_facts_are_joined_where_they_are(spark, no_broadcast):
    plan = plan_of(all_queries()["colocated_join"](spark, FOLDER))
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_bucketed_facts_get_more_buckets_as_the_items_grow(spark, no_broadcast, monkeypatch):
    from martloom.catalogue import queries

    few = sorted(map(tuple, all_queries()["colocated_join"](spark, FOLDER).collect()))
    monkeypatch.setattr(queries, "ITEMS_A_BUCKET", 100)
    joined = all_queries()["colocated_join"](spark, FOLDER)
    assert "Exchange" not in plan_of(joined)
    assert joined.rdd.getNumPartitions() > 8
    assert sorted(map(tuple, joined.collect())) == few


def test_best_seller_join_is_spread_by_total(spark, no_broadcast):
    plan = plan_of(all_queries()["top_material_by_region"](spark, FOLDER))
    assert any("sales_qt" in k or "coalesce" in k for k in re.findall(r"Exchange (.*)", plan))
    logical = optimized_plan_of(all_queries()["top_material_by_region"](spark, FOLDER))
    assert "Window" not in logical


@pytest.mark.parametrize(
    "name", ["plan_fact_view", "plan_fact_report", "dict_lookup", "load_coupons_dds", "sales_report"]
)
def test_results_do_not_depend_on_the_way_of_joining(spark, no_broadcast, name, request):
    from compare import connect, duck_rows, spark_rows

    from martloom.catalogue.oracle import all_sql

    found = spark_rows(all_queries()[name](spark, FOLDER))
    wanted = duck_rows(connect(FOLDER), all_sql()[name])
    assert found[2] == wanted[2]


def test_sales_are_scanned_once_for_the_plan_fact_mart(spark, no_broadcast):
    f = Frames(spark, FOLDER)
    rows = [(day("1996-01-01"), "R1", kind, 1, "A") for kind in ("ECONOMY", "LARGE")]
    plan = spark.createDataFrame(
        rows, "date date, region string, matdirec string, quantity int, distr_chan string"
    )
    mart = plan_fact.plan_fact_mart(f.sales, plan, f.product, "199601")
    mart.collect()
    final = plan_of(mart).split("== Initial Plan ==")[0]
    scans = [line for line in final.splitlines() if "FileScan" in line and "l_quantity" in line]
    assert len(scans) == 1 and "ReusedExchange" in final


def test_products_and_prices_are_never_broadcast(spark):
    """They grow with the data; a broadcast of them is built on the driver."""
    plan = plan_of(all_queries()["plan_fact_view"](spark, FOLDER))
    keys = re.findall(r"BroadcastHashJoin \[([^\]]*)\]", plan)
    assert keys and not any("material" in k for k in keys)
    assert "SortMergeJoin [material" in plan


@pytest.mark.parametrize("name", ["dict_lookup", "plan_fact_report"])
def test_dictionaries_by_material_are_never_broadcast(spark, name):
    """Entries of every product and price: as many as products, not a few."""
    plan = plan_of(all_queries()[name](spark, FOLDER))
    keys = re.findall(r"BroadcastHashJoin \[([^\]]*)\]", plan)
    assert not any("material" in k for k in keys)
    assert "SortMergeJoin [material" in plan
