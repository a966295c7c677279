"""Quality rules, partitions and loads that write."""

from decimal import Decimal

import pytest
from conftest import day, plan_of, rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from martloom import schemas
from martloom.operators import loads, partitions, quality, statistics
from martloom.operators.stats import analyze, table_stats
from martloom.sources import storage
from martloom.sources.tables import read_months, read_partitioned, read_table

KEYED = schemas.table("k text, n int")
DATED = schemas.table("d date, n int")
DAYS = "d date, n int"


# ---- filters and checks ---------------------------------------------------------


def test_not_empty_drops_null_and_blank(frame):
    df = frame("k string, n int", ("a", 1), ("", 2), ("   ", 3), (None, 4), ("b", None))
    assert rows(quality.not_empty(df)) == [("a", 1), ("b", None)]


def test_not_empty_without_text_columns_keeps_all(frame):
    df = frame("n int, d date", (1, None), (None, day("2021-01-01")))
    assert quality.not_empty(df).count() == 2


def test_conform_trims_padding_and_orders_columns(frame):
    df = frame("txt string, plant string", (" Shop ", "M001  "))
    found = quality.conform(df, schemas.STORES)
    assert found.columns == ["plant", "txt"]
    assert rows(found) == [("M001", " Shop")]


def test_required_columns_fail_the_job(frame):
    df = frame("region string, txt string", ("R1", None), (None, "x"))
    with pytest.raises(PySparkException, match="required column region"):
        quality.require(df, schemas.REGION).collect()
    known = df.filter("region is not null")
    assert rows(quality.require(known, schemas.REGION)) == [("R1", None)]


def test_partition_check(frame):
    df = frame(DAYS, (day("2021-01-31"), 1))
    lo, hi = day("2021-01-01"), day("2021-02-01")
    assert quality.assert_in_partition(df, "d", lo, hi) is df
    for stray in (day("2021-02-01"), day("2020-12-31"), None):
        with pytest.raises(quality.LoadError):
            quality.assert_in_partition(df.union(frame(DAYS, (stray, 2))), "d", lo, hi)


# ---- partitions -----------------------------------------------------------------


def test_partitions_are_extended_past_the_date(frame):
    declared = frame(
        "partition_start date, partition_end date", (day("2021-01-01"), day("2021-02-01"))
    )

    def starts(value):
        needed = frame("v date", (day(value),))
        made = partitions.extend_partitions(declared, needed, "v")
        return [str(r[0])[:7] for r in made.orderBy("partition_start").collect()]

    assert starts("2021-01-31") == ["2021-01"]
    # A partition that ends on the date does not hold it yet.
    assert starts("2021-02-01") == ["2021-01", "2021-02"]
    assert starts("2021-04-15") == ["2021-01", "2021-02", "2021-03", "2021-04"]


def test_rows_are_routed_to_month_or_default(frame):
    df = frame(DAYS, (day("2021-01-31"), 1), (day("2021-03-01"), 2), (None, 3))
    routed = partitions.route_partitions(df, "d", "2021-01-01", "2021-03-01")
    assert [(r.n, r.month) for r in routed.orderBy("n").collect()] == [
        (1, "202101"),
        (2, "def"),
        (3, "def"),
    ]


OLD = [
    (day("2020-12-31"), 1),
    (day("2021-01-10"), 2),
    (day("2021-02-10"), 3),
    (day("2021-03-10"), 4),
    (None, 5),
]
NEW = [
    (day("2020-12-30"), 10),
    (day("2021-01-20"), 20),
    (day("2021-02-28"), 30),
    (day("2021-03-01"), 40),
    (None, 50),
]


def test_delta_replaces_whole_months_only(frame):
    found = partitions.delta_partition_load(
        frame(DAYS, *NEW), frame(DAYS, *OLD), "d", "2021-01-15", "2021-02-01"
    )
    assert sorted(r.n for r in found.collect()) == [1, 4, 5, 20, 30]


def test_delta_of_an_empty_month_empties_it(frame):
    found = partitions.delta_partition_load(
        frame(DAYS, (day("2021-01-20"), 20)), frame(DAYS, *OLD), "d", "2021-01-01", "2021-02-28"
    )
    assert sorted(r.n for r in found.collect()) == [1, 4, 5, 20]


def test_delta_from_an_empty_source_changes_nothing(spark, frame):
    empty = spark.createDataFrame([], DAYS)
    found = partitions.delta_partition_load(
        empty, frame(DAYS, *OLD), "d", "2021-01-01", "2021-02-28"
    )
    assert rows(found) == rows(frame(DAYS, *OLD))


# ---- loads on disk --------------------------------------------------------------


def test_full_load_modes(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    good = frame("k string, n int", ("a", 1), (" ", 2), (None, 3))
    assert loads.full_load(good, path, KEYED, truncate=True).rows == 1
    # Without truncation rows are added, so loading twice repeats them.
    assert loads.full_load(good, path, KEYED).rows == 1
    assert rows(read_table(spark, path, KEYED)) == [("a", 1), ("a", 1)]
    # An empty source is a no-op even when truncation is asked for.
    empty = spark.createDataFrame([], "k string, n int")
    assert loads.full_load(empty, path, KEYED, truncate=True).skipped
    assert read_table(spark, path, KEYED).count() == 2
    # A source that is filtered away completely still truncates.
    blank = frame("k string, n int", ("", 1))
    result = loads.full_load(blank, path, KEYED, truncate=True)
    assert (result.rows, result.skipped) == (0, False)
    assert read_table(spark, path, KEYED).count() == 0


def test_insert_select_counts_only_its_rows(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    df = frame("k string, n int", ("a", 1), ("b", 2))
    assert loads.insert_select(df, path, KEYED).rows == 2
    assert loads.insert_select(df, path, KEYED, F.col("n") > 1).rows == 1
    assert read_table(spark, path, KEYED).count() == 3
    assert loads.insert_select(df, path, KEYED, truncate=True).rows == 2
    assert read_table(spark, path, KEYED).count() == 2


def test_a_table_never_loaded_reads_as_empty(spark, tmp_path):
    found = read_table(spark, str(tmp_path / "none"), schemas.STORES)
    assert found.columns == ["plant", "txt"] and found.isEmpty()


def test_month_load_on_disk_equals_the_functional_form(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    old, new = frame(DAYS, *OLD), frame(DAYS, *NEW)
    assert loads.load_all_months(old, path, DATED, "d").rows == 5
    for _ in range(2):  # a rerun gives the same table
        result = loads.load_months(new, path, DATED, "d", "2021-01-15", "2021-02-01")
        assert result.rows == 2 and result.months == {"202101": 1, "202102": 1}
        expected = partitions.delta_partition_load(new, old, "d", "2021-01-15", "2021-02-01")
        assert rows(read_partitioned(spark, path, DATED)) == rows(expected)


def test_month_load_empties_months_without_rows(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    loads.load_all_months(frame(DAYS, *OLD), path, DATED, "d")
    january = frame(DAYS, (day("2021-01-20"), 20))
    result = loads.load_months(january, path, DATED, "d", "2021-01-01", "2021-02-28")
    assert result.months == {"202101": 1, "202102": 0}
    left = sorted(r.n for r in read_partitioned(spark, path, DATED).collect())
    assert left == [1, 4, 5, 20]
    # Source rows exist, but none in the window: all of it is emptied.
    later = frame(DAYS, (day("2022-01-20"), 7))
    assert loads.load_months(later, path, DATED, "d", "2021-01-01", "2021-02-28").rows == 0
    left = sorted(r.n for r in read_partitioned(spark, path, DATED).collect())
    assert left == [1, 4, 5]


def test_month_load_from_an_empty_source_changes_nothing(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    loads.load_all_months(frame(DAYS, *OLD), path, DATED, "d")
    empty = spark.createDataFrame([], DAYS)
    assert loads.load_months(empty, path, DATED, "d", "2021-01-01", "2021-02-28").skipped
    assert read_partitioned(spark, path, DATED).count() == 5


def test_a_stray_row_fails_the_load_before_anything_is_swapped(spark, frame, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    loads.load_all_months(frame(DAYS, *OLD), path, DATED, "d")
    before = rows(read_partitioned(spark, path, DATED))
    # A source whose rows change between the filter and the write, as a view over a busy table may.
    monkeypatch.setattr(loads, "in_window", lambda *_: F.lit(True))
    with pytest.raises(PySparkException, match="outside"):
        loads.load_months(frame(DAYS, *NEW), path, DATED, "d", "2021-01-01", "2021-02-28")
    assert rows(read_partitioned(spark, path, DATED)) == before


def test_rows_outside_the_declared_months_go_to_the_default_folder(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    loads.load_all_months(frame(DAYS, *OLD), path, DATED, "d", "2021-01-01", "2021-03-01")
    found = read_partitioned(spark, path, DATED, keep_month=True)
    assert sorted((r.n, r.month) for r in found.collect()) == [
        (1, "def"), (2, "202101"), (3, "202102"), (4, "def"), (5, "def"),
    ]


def test_a_load_knows_its_columns(frame, tmp_path):
    df = frame("k string, n int", ("a", 1), ("b", None), ("b", 7))
    stats = loads.insert_select(df, str(tmp_path / "t"), KEYED).stats
    assert stats["k"] == loads.ColumnStats(0, "a", "b", 2)
    assert stats["n"] == loads.ColumnStats(1, "1", "7", 2)


def test_declared_months_extend_past_the_needed_date(frame):
    def starts(needed):
        bounds = frame("a date, b date, c date", (day("2021-01-05"), day("2021-01-20"), day(needed)))
        made = partitions.declared_months(bounds, "a", "b", "c")
        return [str(r[0])[:7] for r in made.orderBy("partition_start").collect()]

    assert starts("2021-01-31") == ["2021-01"] == starts("2020-06-01")
    assert starts("2021-02-01") == ["2021-01", "2021-02"]


def test_reading_months_prunes_folders(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    loads.load_all_months(frame(DAYS, *OLD), path, DATED, "d")
    found = read_months(spark, path, DATED, "d", "2021-01-15", "2021-02-01")
    assert sorted(r.n for r in found.collect()) == [2, 3]
    assert len(found.inputFiles()) >= 2
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_a_busy_month_is_written_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "t")
    busy = spark.range(400_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("2021-01-05"))
        .otherwise(F.expr("date_add(date'2021-02-01', cast(id % 300 as int))"))
        .cast("date")
        .alias("d"),
        (F.col("id") % 1000).cast("int").alias("n"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        loads.load_all_months(busy, path, DATED, "d")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = spark.read.parquet(path).filter("month = '202101'").select(F.input_file_name())
    assert files.distinct().count() > 1
    assert read_partitioned(spark, path, DATED).count() == 400_000


def test_bucketed_tables_are_joined_without_a_shuffle(spark, no_broadcast, tmp_path):
    bills = spark.range(3000).withColumnRenamed("id", "billnum")
    try:
        heads = loads.save_bucketed(bills, "b_heads", str(tmp_path / "h"), ["billnum"], 4)
        lines = bills.selectExpr("billnum", "explode(array(1, 2)) as qty")
        items = loads.save_bucketed(lines, "b_items", str(tmp_path / "i"), ["billnum"], 4)
        joined = items.join(heads, "billnum").groupBy("billnum").agg(F.sum("qty").alias("qty"))
        assert "Exchange" not in plan_of(joined)
        assert joined.filter("qty = 3").count() == 3000
        few = bills.selectExpr("billnum % 3 as k")
        stored = loads.save_bucketed(few, "b_few", str(tmp_path / "x"), ["k"], 4)
        assert stored.groupBy("k").count().count() == 3
    finally:
        spark.sql("DROP TABLE IF EXISTS b_heads")
        spark.sql("DROP TABLE IF EXISTS b_items")
        spark.sql("DROP TABLE IF EXISTS b_few")


# ---- statistics -----------------------------------------------------------------


def test_table_stats(frame):
    df = frame("k string, m decimal(17,2)", ("a", Decimal("1.50")), ("b", None), ("b", None))
    found = {r.column_name: r for r in table_stats(df).collect()}
    assert tuple(found["k"])[1:] == (3, 0, "a", "b", 2)
    assert tuple(found["m"])[1:] == (3, 2, "1.50", "1.50", 1)


def test_analyze_stores_statistics(spark, tmp_path):
    spark.range(10).write.option("path", str(tmp_path / "t")).saveAsTable("analyzed")
    try:
        analyze(spark, "analyzed")
        detail = spark.sql("DESCRIBE EXTENDED analyzed id").collect()
        assert ("max", "9") in [(r.info_name, r.info_value) for r in detail]
    finally:
        spark.sql("DROP TABLE analyzed")


# ---- replacement, statistics, changes -----------------------------------------------


def failing(df):
    """Rows of which the second task cannot write its own."""
    broken = F.raise_error(F.lit("lost disk")).cast("int")
    return df.repartition(2).withColumn("n", F.when(F.spark_partition_id() == 1, broken).otherwise(F.col("n")))


def test_a_failed_replacement_leaves_the_old_rows(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    old = frame("k string, n int", ("a", 1), ("b", 2), ("c", 3))
    loads.full_load(old, path, KEYED, truncate=True)
    for load in (
        lambda df: loads.full_load(df, path, KEYED, truncate=True),
        lambda df: loads.insert_select(df, path, KEYED, truncate=True),
        lambda df: loads.create_table_as(df, path),
    ):
        with pytest.raises(PySparkException, match="lost disk"):
            load(failing(old))
        assert rows(read_table(spark, path, KEYED)) == rows(old)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]


def test_a_table_can_be_replaced_by_what_is_read_from_it(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    loads.create_table_as(frame("k string, n int", ("a", 1), ("b", 2)), path)
    loads.create_table_as(read_table(spark, path, KEYED).filter("n > 1"), path)
    assert rows(read_table(spark, path, KEYED)) == [("b", 2)]


@pytest.mark.parametrize("ready", [True, False])
def test_an_interrupted_swap_is_ended_by_the_next_load(spark, frame, tmp_path, monkeypatch, ready):
    path = str(tmp_path / "t")
    loads.create_table_as(frame("k string, n int", ("old", 1)), path)

    def dies(session, source, target):
        if source.endswith(storage.NEXT):
            raise KeyboardInterrupt
        rename(session, source, target)

    rename = storage.rename
    monkeypatch.setattr(storage, "rename", dies)
    with pytest.raises(KeyboardInterrupt):
        loads.create_table_as(frame("k string, n int", ("new", 2)), path)
    monkeypatch.setattr(storage, "rename", rename)
    # Until then the old rows are read.
    assert rows(read_table(spark, path, KEYED)) == [("old", 1)]
    if not ready:
        storage.remove(spark, f"{path}{storage.NEXT}/_READY")
    loads.insert_select(frame("k string, n int", ("more", 3)), path, KEYED)
    assert rows(read_table(spark, path, KEYED)) == [("more", 3), ("new", 2) if ready else ("old", 1)]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]


def merged(spark, path, schema):
    found = statistics.table_stats_merged(spark, path, schema)
    scans = [line for line in plan_of(found).splitlines() if "Scan" in line]
    assert len(scans) == 1 and "_statistics" in scans[0]  # no row of the table is read
    return rows(found)


def test_merged_statistics_equal_those_of_the_table(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    many = spark.range(2000).selectExpr("date_add(date'2021-01-01', cast(id % 200 as int)) d", "cast(id % 90 as int) n")
    loads.load_all_months(many.union(frame(DAYS, (None, 7), (day("2021-02-03"), None))), path, DATED, "d")
    assert merged(spark, path, DATED) == rows(table_stats(read_partitioned(spark, path, DATED), exact=("d", "n")))
    loads.load_months(frame(DAYS, (day("2021-01-31"), 900)), path, DATED, "d", "2021-01-01", "2021-03-31")
    assert merged(spark, path, DATED) == rows(table_stats(read_partitioned(spark, path, DATED), exact=("d", "n")))
    # More months than the writing tasks look at.
    loads.load_months(many.filter("n < 10"), path, DATED, "d", "2021-01-01", "2021-06-30")
    assert merged(spark, path, DATED) == rows(table_stats(read_partitioned(spark, path, DATED), exact=("d", "n")))


def test_merged_statistics_cover_appended_rows(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    assert [r[1] for r in rows(statistics.table_stats_merged(spark, path, KEYED))] == [0, 0]
    for part in ((("a", 9), ("b", None)), (("b", 10),), ((None, -1),)):
        loads.insert_select(frame("k string, n int", *part), path, KEYED)
    # Numbers are compared as numbers: 10 is more than 9.
    assert merged(spark, path, KEYED) == [("k", 4, 1, "a", "b", 2), ("n", 4, 1, "-1", "10", 3)]
    loads.insert_select(frame("k string, n int", ("z", 1)), path, KEYED, truncate=True)
    assert merged(spark, path, KEYED) == [("k", 1, 0, "z", "z", 1), ("n", 1, 0, "1", "1", 1)]


def test_sketches_estimate_many_values(spark, tmp_path):
    path = str(tmp_path / "t")
    loads.create_table_as(spark.range(60_000).selectExpr("cast(id as string) k", "cast(id % 30000 as int) n"), path)
    counts = [r.distinct_count for r in statistics.table_stats_merged(spark, path, KEYED).orderBy("column_name").collect()]
    assert abs(counts[0] - 60_000) < 3_000 and abs(counts[1] - 30_000) < 1_500


def test_fingerprints_do_not_depend_on_order_and_see_every_change(spark, frame):
    given = [("a", 1, "x"), ("a", 1, "x"), (None, 2, "x"), ("b", None, "x")]

    def of(*given):
        return statistics.fingerprints_by(frame("k string, n int, m string", *given).repartition(3), "m").get("x")

    base = of(*given)
    assert of(*reversed(given)) == base and base[0] == 4
    others = [given[1:], [*given, given[0]], [("a", 2, "x"), *given[1:]], [*given[:2], ("b", 2, "x"), (None, None, "x")],
              [*given[2:], ("c", 1, "x"), ("c", 1, "x")]]
    assert len({base, *(of(*g) for g in others)}) == 6
    assert of(("a", None, "x")) != of((None, None, "x"))


def test_only_changed_months_are_written(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    new, window = frame(DAYS, *NEW), ("d", "2020-12-01", "2021-02-01")
    options = {"only_changed": True}
    assert loads.load_months(new, path, DATED, *window, **options).months == {"202012": 1, "202101": 1, "202102": 1}
    again = loads.load_months(new.repartition(2), path, DATED, *window, **options)
    assert (again.rows, again.months, again.unchanged) == (0, {}, ("202012", "202101", "202102"))
    # One month changed and another emptied; an emptied one is known to be empty.
    less = new.filter("n <> 30").withColumn("n", F.when(F.col("n") == 10, 11).otherwise(F.col("n")))
    for months in ({"202012": 1, "202102": 0}, {}):
        assert loads.load_months(less, path, DATED, *window, **options).months == months
        assert sorted(r.n for r in read_partitioned(spark, path, DATED).collect()) == [11, 20]
    # A load that dies between its rows and their statistics leaves nothing wrong behind.
    statistics.forget(spark, path, ["202101"])
    assert loads.load_months(less, path, DATED, *window, **options).months == {"202101": 1}


def test_months_derived_from_the_same_are_not_computed(spark, frame, tmp_path):
    path, window = str(tmp_path / "t"), ("d", "2021-01-01", "2021-02-01")
    new = frame(DAYS, *NEW)
    inputs = {"202101": "one", "202102": "two"}
    assert loads.load_months(new, path, DATED, *window, inputs=inputs).rows == 2
    broken = new.withColumn("n", F.raise_error(F.lit("computed")).cast("int"))
    assert loads.load_months(broken, path, DATED, *window, guard=new, inputs=inputs).unchanged == ("202101", "202102")
    later = new.withColumn("n", F.when(F.month("d") == 1, F.raise_error(F.lit("computed")).cast("int")).otherwise(99))
    found = loads.load_months(later, path, DATED, *window, guard=new, inputs={**inputs, "202102": "other"})
    assert found.months == {"202102": 1} and found.unchanged == ("202101",)
    # What is not known is never taken for unchanged.
    unknown = {"202101": "", "202102": ""}
    for _ in range(2):
        assert loads.load_months(new, path, DATED, *window, inputs=unknown).rows == 2


def test_a_full_load_of_the_same_rows_writes_nothing(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    good = frame("k string, n int", ("a", 1), (" ", 2))
    assert loads.full_load(good, path, KEYED, truncate=True, only_changed=True).rows == 1
    assert loads.full_load(good, path, KEYED, truncate=True, only_changed=True).unchanged == ("whole",)
    assert loads.full_load(good.filter("n = 2"), path, KEYED, truncate=True, only_changed=True).pieces
    assert read_table(spark, path, KEYED).isEmpty()
    # Rows were added meanwhile, so the table is more than its first piece.
    loads.full_load(good, path, KEYED, truncate=True)
    loads.insert_select(good, path, KEYED)
    assert loads.full_load(good, path, KEYED, truncate=True, only_changed=True).rows == 1
    assert rows(read_table(spark, path, KEYED)) == [("a", 1)]
