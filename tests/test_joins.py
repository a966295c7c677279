"""Joins: same meaning for any input, no jobs while planning, hot keys spread over many tasks."""

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from martloom.catalogue.queries import all_queries
from martloom.operators import joins, lookup
from martloom.operators.stats import hot_keys

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows hold key 7; identical copies among them; some keys are NULL."""
    return spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7))
        .when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(1000 + F.col("id"))
        .cast("bigint")
        .alias("k"),
        (F.col("id") % 5).alias("v"),
    )


@pytest.fixture(scope="module")
def heads(spark):
    return spark.range(0, 40_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("h"))


def counted(df):
    """Multiset of rows, as a frame small enough to compare."""
    names = sorted(df.columns)
    return sorted(map(tuple, df.groupBy(names).count().collect()), key=repr)


WAYS = {
    "checked": joins.checked_join,
    "fact": joins.fact_join,
    "salted": lambda a, b, on, how="inner": joins.salted_join(a, b, on, [[7], [None]], 8, how),
}


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("how", ["inner", "left"])
def test_every_way_equals_the_plain_join(facts, heads, way, how):
    right = heads.filter("k % 2 = 1")
    assert counted(WAYS[way](facts, right, ["k"], how)) == counted(facts.join(right, "k", how))
    assert counted(WAYS[way](right, facts, ["k"], how)) == counted(right.join(facts, "k", how))


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("how", ["right", "full", "left_anti", "cross"])
@pytest.mark.parametrize("size", [1, 1000])
def test_other_kinds_are_refused_at_every_size(facts, heads, way, how, size):
    with pytest.raises(ValueError):
        WAYS[way](facts.limit(size), heads, ["k"], how)


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("size", [1, 1000])
def test_keys_of_different_types_are_refused_at_every_size(facts, heads, way, size):
    with pytest.raises(TypeError):
        WAYS[way](facts.limit(size), heads.withColumn("k", F.col("k").cast("int")), ["k"])


def test_composite_keys(facts):
    left = facts.withColumn("m", F.col("v"))
    right = facts.select("k", F.col("v").alias("m")).distinct().withColumn("h", F.lit(1))
    joined = joins.salted_join(left, right, ["k", "m"], [[7, 0], [7, 1]], 4)
    assert counted(joined) == counted(left.join(right, ["k", "m"]))


@pytest.fixture
def plain_shuffles(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def tasks_of(df, key):
    held = df.filter(F.col("k") == key).groupBy(F.spark_partition_id()).count()
    return sorted(r["count"] for r in held.collect())


def test_hot_rows_are_spread(facts, heads, plain_shuffles):
    assert tasks_of(joins.checked_join(facts, heads, ["k"]), 7) == [10_000]
    spread = tasks_of(joins.salted_join(facts, heads, ["k"], [[7]], 16), 7)
    assert len(spread) >= 8 and max(spread) < 3_500


def test_a_key_with_half_a_percent_of_the_rows_is_split(spark, heads, plain_shuffles):
    facts = spark.range(100_000).select(
        F.when(F.col("id") % 200 == 0, F.lit(5)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    assert tasks_of(joins.salted_join(facts, heads, ["k"], [[5]], 8), 5)[-1] < 200
    assert len(tasks_of(joins.salted_join(facts, heads, ["k"], [[5]], 8), 5)) >= 4


def test_runtime_settings_split_a_skewed_partition(spark, heads):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.shuffle.partitions": "64",
    }
    joins.apply_runtime_settings(spark)
    busy = spark.range(0, 90_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.xxhash64("id").alias("v")
    )
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        joined = joins.fact_join(busy, heads, ["k"])
        joined.collect()
        assert "skew=true" in plan_of(joined)
    finally:
        for k in conf:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


# Queries that write look at what they wrote; a month load asks whether its source is empty.
RUNS_JOBS = {
    "hot_keys", "skewed_coupons_dds", "distinct_bills", "stored_point_lookup", "replaced_load",
    "pipeline_rerun", "rerun_months", "table_stats_merged", "late_arrivals",
    "full_load", "insert_select", "csv_scan", "csv_rejects", "pipeline_run", "plan_fact_pipeline_run",
    "delta_partition_load", "load_traffic_ods", "load_bills_dds", "load_months", "reject_limit",
    "audit_log", "daily_export", "sharded_copy", "plan_fact_copy", "colocated_join",
}


@pytest.mark.parametrize("name", sorted(set(all_queries()) - RUNS_JOBS))
def test_building_a_query_runs_no_job(spark, name):
    # A frame knows its schema by now; what is counted is what the joins and plans add.
    all_queries()[name](spark, FOLDER)
    group = f"plan-{name}"
    spark.sparkContext.setJobGroup(group, name)
    try:
        all_queries()[name](spark, FOLDER)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    footers = [j for j in jobs if _tasks(spark, j) > 1]
    assert not footers


def _tasks(spark, job):
    """Tasks of a job; reading the schema from one file's footer is a job of one task."""
    info = spark.sparkContext.statusTracker().getJobInfo(job)
    stages = [spark.sparkContext.statusTracker().getStageInfo(s) for s in info.stageIds]
    return sum(s.numTasks for s in stages if s)


@pytest.mark.parametrize("name", ["load_coupons_dds", "load_bills_dds", "sales_mart_view"])
def test_the_fact_is_never_broadcast(spark, name):
    plan = plan_of(all_queries()[name](spark, FOLDER)).splitlines()
    for i, line in enumerate(plan):
        if "BroadcastExchange" in line:
            depth = len(line) - len(line.lstrip(" :+-"))
            below = []
            for other in plan[i + 1 :]:
                if len(other) - len(other.lstrip(" :+-")) <= depth:
                    break
                below.append(other)
            assert not any("l_orderkey" in b for b in below)


# ---- lookups ------------------------------------------------------------------------


def test_lookup_picks_and_fills(spark):
    dim = spark.range(1000).select(
        F.format_string("K%03d", F.col("id") % 500).alias("k"),
        F.col("id").alias("price"),
        (F.col("id") % 7).cast("string").alias("pick"),
    )
    mart = spark.range(20).select(F.format_string("K%03d", F.col("id") * 40).alias("k"), F.col("id").alias("n"))
    mart = mart.unionByName(mart.limit(1).selectExpr("cast(null as string) as k", "-1L as n"))
    found = rows(lookup.dict_lookup(mart, dim, "k", {"price": "price", "pick": "choice"}, pick=["pick"]))
    assert len(found) == 21
    by_key = {r[0]: r[2:] for r in found}
    assert by_key[None] == (0, "") and by_key["K760"] == (0, "")
    # Of K040's entries 40 (pick 5) and 540 (pick 1) the one with the last pick stays.
    assert by_key["K040"] == (40, "5")


def test_lookup_takes_given_defaults(frame):
    mart = frame("k string", ("a",), ("b",))
    source = frame("k string, t string, p int", ("a", None, 4))
    found = lookup.dict_lookup(mart, source, "k", {"t": "t", "p": "p"}, defaults={"t": "?"})
    assert rows(found) == [("a", "?", 4), ("b", "?", 0)]




# ---- hot keys -------------------------------------------------------------------------


def test_hot_keys_are_found_and_counted_exactly(spark):
    """Half a percent among a great many keys, two columns, nulls in either."""
    a = F.when(F.col("id") % 200 == 0, "hot").when(F.col("id") % 100 == 1, None).otherwise(F.col("id").cast("string"))
    b = F.when(F.col("id") % 200 == 0, 1).when(F.col("id") % 200 == 1, None).otherwise(F.col("id") % 7)
    df = spark.range(0, 200_000, 1, 7).select(a.alias("a"), b.alias("b"), F.col("id").alias("n"))
    found = {(r.a, r.b): r.row_count for r in hot_keys(df, ["a", "b"], 0.005).collect()}
    exact = df.groupBy("a", "b").count().filter("count >= 1000").collect()
    assert found == {(r[0], r[1]): r[2] for r in exact} and found[("hot", 1)] == found[(None, None)] == 1000
    assert hot_keys(df, ["n"], 0.005).isEmpty()
    assert [tuple(r) for r in hot_keys(df.select(F.lit("x").alias("k")), ["k"], 1).collect()] == [("x", 200_000)]
    assert hot_keys(df.limit(0), ["a"]).isEmpty()
    with pytest.raises(ValueError):
        hot_keys(df, ["a"], 0)


def test_bill_sets_count_bills_of_several_days_once(spark):
    from conftest import day

    from martloom.plans import sales_mart

    rows = [("M1", day("2021-01-01"), 1), ("M1", day("2021-01-01"), 1), ("M1", day("2021-01-02"), 1), ("M1", day("2021-01-02"), 70_000),
            ("M1", day("2021-01-03"), 5), ("M2", day("2021-01-02"), 1), ("M2", day("2021-01-02"), None), ("M1", day("2021-01-02"), -9),
            ("M3", day("2021-01-01"), 2**62)]
    bills = spark.createDataFrame(rows, "plant string, calday date, billnum long")
    sets = sales_mart.bill_sets(bills, "2021-01-01", "2021-01-31")
    for first, last in (("2021-01-01", "2021-01-02"), ("2021-01-02", "2021-01-03"), ("2021-01-02", "2021-01-02")):
        for by in (["plant"], ["calday"], ["plant", "calday"]):
            found = sales_mart.distinct_bills(sets, by, first, last)
            wanted = bills.filter(F.col("calday").between(first, last)).groupBy(by).agg(F.count_distinct("billnum"))
            assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))
