"""Journal, serving copies and whole runs on disk."""

import os
import subprocess
import sys

import pytest
from conftest import day, rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from martloom import schemas
from martloom.catalogue.frames import Frames
from martloom.operators import shards
from martloom.operators.loads import LoadResult
from martloom.plans import audit, pipeline, refine, sales_mart, serving
from martloom.session import fresh_path, shared_dir
from martloom.sources import delimited, storage
from martloom.sources.tables import declared_folders, read_partitioned

FOLDER = "/root/testdata/sf0.001"
START, END = "1995-01-01", "1995-02-28"


# ---- journal ----------------------------------------------------------------------

ENTRY = "log_type string, log_msg string, log_location string"


def test_entries_are_normalised(frame):
    df = frame(ENTRY, ("info", "it's", "Some.Place"), ("Error", None, None))
    assert rows(audit.entries(df)) == [
        ("ERROR", "empty", "null", True),
        ("INFO", "it''s", "some.place", False),
    ]


@pytest.mark.parametrize("kind", ["debug", "", None])
def test_unknown_entry_types_fail(frame, kind):
    with pytest.raises(PySparkException, match="illegal log type"):
        audit.entries(frame(ENTRY, (kind, "m", "l"))).collect()
    with pytest.raises(ValueError):
        audit.check_type(kind)


def test_journal_outlives_a_failed_load(spark, tmp_path):
    journal = audit.Journal(spark, str(tmp_path / "journal"))
    assert journal.read().isEmpty()
    with journal.load("Good") as results:
        results.append(LoadResult(5))
    with journal.load("Empty") as results:
        results.append(LoadResult(0, skipped=True))
    with pytest.raises(RuntimeError):
        with journal.load("Bad"):
            raise RuntimeError("it's broken")
    found = journal.read()
    assert found.count() == 8 and found.select("log_id").distinct().count() == 8
    assert [r.log_msg for r in found.filter("is_error").collect()] == [
        "FAILED Bad: it''s broken"
    ]
    assert {r.log_msg for r in found.filter("log_location = 'empty'").collect()} == {
        "START Empty", "source table is empty", "END Empty",
    }
    summary = {r.log_location: (r.entries, r.errors) for r in journal.summary().collect()}
    assert summary == {"good": (3, 0), "empty": (3, 0), "bad": (2, 1)}
    assert found.filter("log_user is null or log_timestamp is null").isEmpty()


def test_a_killed_run_leaves_what_it_has_noted(spark, tmp_path):
    """The driver dies in its third load, without any chance to store something."""
    program = f"""
import os
from pyspark.sql import functions as F
from martloom import schemas
from martloom.plans.pipeline import Warehouse
from martloom.session import local_session
spark = local_session(1)
house = Warehouse(spark, {str(tmp_path)!r})
stores = spark.sql("select 'M1' plant, 'one' txt")
house.full("Stores", schemas.STORES, stores)
house.replace("Copy", stores)
with house.journal.load("Third"):
    os._exit(9)
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    ended = subprocess.run([sys.executable, "-c", program], cwd=root, timeout=300, capture_output=True)
    assert ended.returncode == 9, ended.stderr[-2000:]
    journal = audit.Journal(spark, str(tmp_path / "journal"))
    found = {(r.log_location, r.log_msg.split(":")[0]) for r in journal.read().collect()}
    assert found == {
        ("stores", "START Stores"), ("stores", "1 rows inserted"), ("stores", "statistics"), ("stores", "END Stores"),
        ("copy", "START Copy"), ("copy", "1 rows inserted"), ("copy", "statistics"), ("copy", "END Copy"),
        ("third", "START Third"),
    }


def test_joined_journal_files_give_the_same_entries(spark, tmp_path):
    journal = audit.Journal(spark, str(tmp_path / "journal"))
    assert journal.compact() == 0
    for n in range(5):
        journal.write(("info", f"it's \n entry {n}", "Here"), ("error", None, None))
    before, files = rows(journal.read()), storage.names(spark, journal.path)
    assert len(before) == 10 and journal.compact() == 5
    joined = storage.names(spark, journal.path)
    assert len(joined) == 1 and rows(journal.read()) == before
    # A crash between the joined file and the removal of the others leaves entries twice.
    (tmp_path / "journal" / files[0]).write_bytes((tmp_path / "journal" / joined[0]).read_bytes())
    assert rows(journal.read()) == before


# ---- shards -----------------------------------------------------------------------


def test_sharded_copy_keeps_every_row(spark, tmp_path):
    mart = spark.range(2000).select(
        F.expr("date_add(date'2021-01-01', cast(id % 40 as int))").alias("calday"),
        # One store holds a third of the rows.
        F.when(F.col("id") % 3 == 0, F.lit("M000"))
        .otherwise(F.format_string("M%03d", F.col("id") % 100))
        .alias("plant"),
    )
    path = str(tmp_path / "copy")
    serving.publish_sales(mart, path, 4)
    copy = spark.read.parquet(path)
    assert rows(copy.select("calday", "plant")) == rows(mart)
    placed = copy.groupBy("plant", "calday").agg(F.count_distinct("bucket").alias("n"))
    assert placed.filter("n > 1").isEmpty()
    report = shards.shard_distribution(copy).collect()
    assert sum(r.row_count for r in report) == 2000
    assert [r.row_count for r in report] == sorted((r.row_count for r in report), reverse=True)
    assert {r.bucket for r in report} <= set(range(4))


def test_sharded_files_are_sorted(spark, tmp_path):
    mart = spark.range(500).select(
        F.format_string("R%d", F.pmod(F.xxhash64("id"), F.lit(9))).alias("region"),
        F.lit("A").alias("matdirec"), F.col("id").cast("string").alias("distr_chan"),
    )
    serving.publish_plan_fact(mart, str(tmp_path / "copy"), 2)
    files = spark.read.parquet(str(tmp_path / "copy")).inputFiles()
    for file in files:
        regions = [r.region for r in spark.read.parquet(file).collect()]
        assert regions == sorted(regions)


def test_task_distribution(spark):
    report = shards.task_distribution(spark.range(0, 100, 1, 4)).collect()
    assert [(r.bucket, r.row_count) for r in report] == [(i, 25) for i in range(4)]


# ---- folders ----------------------------------------------------------------------


class Conf:
    def __init__(self, **values):
        self.values = values
        self.conf = self

    def get(self, key, default=None):
        return self.values.get(key, default)


def test_shared_folder_comes_from_the_session(spark):
    key = "spark.checkpoint.dir"
    assert shared_dir(Conf(**{key: "hdfs://any/dir/"})) == "hdfs://any/dir"
    with pytest.raises(RuntimeError):
        shared_dir(Conf(**{"spark.master": "yarn"}))
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


# ---- whole runs -------------------------------------------------------------------


@pytest.fixture(scope="module")
def sources(spark):
    frames = Frames(spark, FOLDER)
    names = ("coupons", "stores", "promos", "promo_types", "traffic", "bills_head", "bills_item")
    return {name: getattr(frames, name) for name in names}


@pytest.fixture(scope="module")
def house(spark, sources, tmp_path_factory):
    house = pipeline.Warehouse(spark, str(tmp_path_factory.mktemp("house")))
    bad = spark.createDataFrame([("M1", "99.99.1995", "101500", "f", 1)], sources["traffic"].schema)
    broken = {**sources, "traffic": sources["traffic"].union(bad)}
    pipeline.run_sales_pipeline(house, broken, START, END)
    return house


def test_run_sets_unreadable_rows_aside(spark, house):
    assert spark.read.parquet(house.path("rejects/ods_traffic")).count() == 1
    errors = house.journal.read().filter("is_error").collect()
    assert [e.log_location for e in errors] == ["ods_traffic"]


def test_a_failed_run_still_has_its_journal(spark, sources, tmp_path):
    house = pipeline.Warehouse(spark, str(tmp_path / "house"))
    broken = {**sources, "promos": sources["promos"].drop("discount")}
    with pytest.raises(Exception):
        pipeline.run_sales_pipeline(house, broken, START, END)
    found = {r.log_location: r.errors for r in house.journal.outcomes().collect()}
    # Loads that run side by side with the failing one end and are noted, later ones never start.
    assert found == dict.fromkeys(sources, 0) | {"promos": 1}


def test_loads_declare_their_months(spark, house):
    assert house.declare("dds_bills", START, END) == ["199501", "199502"]
    assert declared_folders(spark, house.path("dds_bills")) == ["199501", "199502"]
    other = pipeline.Warehouse(spark, f"{house.root}/other")
    assert other.declare("t", "2021-03-05", "2021-03-06") == ["202103"]
    assert other.declare("t", "2021-01-05", "2021-01-06") == ["202101", "202102", "202103"]


def test_layers_of_a_run(spark, house, sources):
    window = f"calday between date'{START}' and date'{END}'"
    items = sources["bills_item"].filter(window)
    heads = sources["bills_head"].filter(window)
    stored = read_partitioned(spark, house.path("dds_bills"), schemas.DDS_BILLS)
    assert rows(stored) == rows(refine.bills_dds(items, heads))
    traffic = read_partitioned(spark, house.path("ods_traffic"), schemas.ODS_TRAFFIC)
    assert rows(traffic) == rows(refine.traffic_ods(sources["traffic"]).filter(window))
    assert house.read("promo_types", schemas.PROMO_TYPES).count() == 3


def test_a_second_run_changes_nothing(spark, house, sources):
    name = "v_sales_mart19950101_19950228"
    before = rows(spark.table(name))
    tables = ("coupons", "ods_promos", "dds_coupons")
    counts = [spark.read.parquet(house.path(t)).count() for t in tables]
    pipeline.run_sales_pipeline(house, sources, START, END)
    assert rows(spark.table(name)) == before != []
    assert [spark.read.parquet(house.path(t)).count() for t in tables] == counts


def test_a_run_from_files_gives_the_same_report(spark, house, sources, tmp_path):
    before = rows(spark.table("v_sales_mart19950101_19950228"))
    files = {
        "coupons": schemas.COUPONS, "stores": schemas.STORES,
        "promos": schemas.PROMOS, "promo_types": schemas.PROMO_TYPES,
    }
    arrived = dict(sources)
    for name, schema in files.items():
        delimited.write_delimited(sources[name], str(tmp_path / name))
        arrived[name] = delimited.read_delimited(spark, str(tmp_path / name), schema)
    other = pipeline.Warehouse(spark, str(tmp_path / "house"))
    report = pipeline.run_sales_pipeline(other, arrived, START, END)
    assert rows(report) == before != []


def test_daily_refresh_reads_the_stored_layers(spark, house):
    report = pipeline.refresh_sales_mart(house, "1995-01-14")
    daily = spark.read.parquet(house.path("sales_data_19950114"))
    assert {r.calday for r in daily.collect()} == {day("1995-01-14")}
    whole = spark.read.parquet(house.path("sales_data_19950101_19950228"))
    assert rows(whole.filter("calday = date'1995-01-14'")) == rows(daily)
    stores = house.read("stores", schemas.STORES)
    assert rows(report) == rows(sales_mart.sales_mart_view(daily, stores))


def test_an_empty_source_leaves_the_stored_layers(spark, house, sources):
    before = house.read("ods_coupons", schemas.ODS_COUPONS).count()
    empty = {**sources, "coupons": sources["coupons"].filter("1 = 0")}
    pipeline.run_sales_pipeline(house, empty, START, END)
    assert house.read("ods_coupons", schemas.ODS_COUPONS).count() == before > 0
    notes = house.journal.read().filter("log_location = 'coupons'").select("log_msg")
    assert ("source table is empty",) in rows(notes)


def written(house):
    return {t: (dict(r.months) or r.rows) for t, r in house.results.items() if r.pieces}


def test_a_run_over_the_same_rows_writes_nothing(spark, sources, tmp_path):
    house = pipeline.Warehouse(spark, str(tmp_path / "house"))
    report = rows(pipeline.run_sales_pipeline(house, sources, START, END))
    assert len(written(house)) == len(house.results) == 13
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "house").rglob("part-*.parquet")}
    shuffled = {name: df.repartition(3) for name, df in sources.items()}
    assert rows(pipeline.run_sales_pipeline(house, shuffled, START, END)) == report
    assert written(house) == {}
    assert files == {p: p.stat().st_mtime_ns for p in (tmp_path / "house").rglob("part-*.parquet")}
    # On demand all is derived anew.
    pipeline.run_sales_pipeline(pipeline.Warehouse(spark, house.root, only_changed=False), sources, START, END)
    assert not set(files) & set((tmp_path / "house").rglob("part-*.parquet"))


def test_a_run_with_a_changed_month_equals_a_full_one(spark, sources, tmp_path):
    january = F.col("calday") < day("1995-02-01")
    items = sources["bills_item"]
    changed = {**sources, "bills_item": items.withColumn("qty", F.when(january, F.col("qty") + 1).otherwise(F.col("qty")))}
    house, full = (pipeline.Warehouse(spark, str(tmp_path / n)) for n in ("house", "full"))
    pipeline.run_sales_pipeline(house, sources, START, END)
    report = rows(pipeline.run_sales_pipeline(house, changed, START, END))
    assert {t: set(m) for t, m in written(house).items() if isinstance(m, dict)} == {
        "bills_item": {"199501"}, "dds_bills": {"199501"}, "dds_coupons": {"199501", "199502"},
    }
    assert report == rows(pipeline.run_sales_pipeline(full, changed, START, END))
    for table in ("dds_bills", "dds_coupons", "bills_item"):
        assert rows(spark.read.parquet(house.path(table))) == rows(spark.read.parquet(full.path(table)))
