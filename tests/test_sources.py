import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from martloom import schemas
from martloom.sources import delimited, jdbc

ITEM = schemas.table("k text, n int, m money, d date")


def write(tmp_path, *lines):
    path = tmp_path / "file.csv"
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_values_and_quotes(spark, tmp_path):
    path = write(
        tmp_path,
        "k;n;m;d",
        'a;1;2.50;2021-01-31',
        '"b;""x""";;;',
        '"";7;;',
        ';8;;',
        ' padded ;9;;',
        'naïve\\;10;1;2021-02-01',
    )
    found = delimited.read_delimited(spark, path, ITEM).orderBy("n").collect()
    assert found[0].k == 'b;"x"' and found[0].n is None
    assert (found[1].k, str(found[1].m), found[1].d) == ("a", "2.50", day("2021-01-31"))
    # An unquoted empty field is NULL, a quoted one is empty text.
    assert found[2].k == "" and found[3].k is None
    assert found[4].k == " padded " and found[5].k == "naïve\\"


def test_header_is_optional(spark, tmp_path):
    path = write(tmp_path, "R1;North", "R2;South")
    found = delimited.read_delimited(spark, path, schemas.REGION, header=False)
    assert rows(found) == [("R1", "North"), ("R2", "South")]
    assert delimited.read_delimited(spark, path, schemas.REGION).count() == 1


def test_padded_columns_are_trimmed(spark, tmp_path):
    path = write(tmp_path, "plant;txt", "M001;Shop   ")
    found = delimited.read_delimited(spark, path, schemas.STORES)
    assert rows(found) == [("M001", "Shop")]


BAD = [
    "a;one;1;2021-01-01",  # no number
    "b;2;1",  # too few fields
    "c;3;1;2021-01-01;x",  # too many
    "d;4;1;2021-02-30",  # no such day
    'e;"";1;2021-01-01',  # quoted empty text is no number
]


@pytest.mark.parametrize("staged", [False, True])
def test_reject_limit(spark, tmp_path, staged):
    path = write(tmp_path, "k;n;m;d", "ok;1;1;2021-01-01", *BAD)
    staging = str(tmp_path / "staging") if staged else None

    def read(limit):
        return delimited.read_delimited(spark, path, ITEM, reject_limit=limit, staging=staging)

    assert [r.k for r in read(6).collect()] == ["ok"]
    assert read(None).count() == 1
    with pytest.raises(delimited.RejectLimitReached):
        read(5)
    with pytest.raises(delimited.RejectLimitReached):
        read(1)


def test_rejects_do_not_depend_on_the_columns_used(spark, tmp_path):
    path = write(tmp_path, "k;n;m;d", "ok;1;1;2021-01-01", *BAD)
    scan = delimited.scan_delimited(spark, path, ITEM)
    assert delimited.accepted(scan, ITEM).select("k").count() == 1
    assert delimited.accepted(scan, ITEM).count() == 1
    texts = [r[0] for r in delimited.rejected(scan).select(delimited.REJECT).collect()]
    assert len(texts) == 5 and "a;one;1;2021-01-01" in texts and "b;2;1" in texts


def test_lines_inside_fields(spark, tmp_path):
    path = write(tmp_path, "region;txt", 'R1;"two', 'lines"', "R2;one")
    found = delimited.read_delimited(spark, path, schemas.REGION, multi_line=True)
    assert rows(found) == [("R1", "two\nlines"), ("R2", "one")]


def test_files_round_trip(spark, frame, tmp_path):
    df = frame(
        "region string, txt string",
        ("R1", 'a;"b"'), ("", None), (None, ""), ("\\", " x "), ("'", "é"),
    )
    delimited.write_delimited(df, str(tmp_path / "out"))
    found = delimited.read_delimited(spark, str(tmp_path / "out"), schemas.REGION)
    assert rows(found) == rows(df)


# ---- database tables: no database is started here -------------------------------


def test_date_slices_cover_every_row_once(spark, frame):
    lo, hi = day("2021-01-01"), day("2021-02-15")
    slices = jdbc.date_slices("d", lo, hi, days=10)
    assert slices[0] == "d >= DATE '2021-01-01' AND d < DATE '2021-01-11'"
    assert slices[-2] == "d >= DATE '2021-02-10' AND d < DATE '2021-02-15'"
    dates = spark.range(-40, 90).select(F.expr("date_add(date'2021-01-01', cast(id as int)) d"))
    dates = dates.unionByName(frame("d date", (None,)))
    hits = sum(F.when(F.coalesce(F.expr(s), F.lit(False)), 1).otherwise(0) for s in slices)
    assert dates.select(hits.alias("n")).distinct().collect()[0].n == 1
    assert dates.filter(hits == 1).count() == dates.count()
    assert len(jdbc.date_slices("d", lo, hi, days=10, complete=False)) == len(slices) - 1


class Reader:
    """Stands in for the session's reader and records what it is asked for."""

    def __init__(self, df):
        self.df = df
        self.calls = []

    @property
    def read(self):
        return self

    def jdbc(self, url, table, **options):
        self.calls.append((url, table, options))
        return self.df


def test_jdbc_options_and_types(frame):
    arrived = frame("plant string, billnum int, calday date", ("M1  ", 5, day("2021-01-01")))
    reader = Reader(arrived)
    options = {"url": "jdbc:any:db", "user": "u", "driver": "some.Driver"}
    slices = ["a", "b"]
    found = jdbc.read_jdbc(reader, options, "bills_head", schemas.BILLS_HEAD, slices)
    assert rows(found) == [(5, "M1", day("2021-01-01"))]
    assert found.schema["billnum"].dataType == schemas.BILLS_HEAD["billnum"].dataType
    jdbc.read_jdbc(reader, options, "bills_head", schemas.BILLS_HEAD, key="billnum", bounds=(0, 900, 9))
    with pytest.raises(ValueError):
        jdbc.read_jdbc(reader, options, "bills_head", schemas.BILLS_HEAD)
    properties = {"fetchsize": "10000", "user": "u", "driver": "some.Driver"}
    assert reader.calls == [
        ("jdbc:any:db", "bills_head", {"predicates": slices, "properties": properties}),
        (
            "jdbc:any:db",
            "bills_head",
            {
                "column": "billnum", "lowerBound": 0, "upperBound": 900, "numPartitions": 9,
                "properties": properties,
            },
        ),
    ]
    assert options["url"] == "jdbc:any:db"


def test_a_mart_is_read_back_in_its_types(frame):
    arrived = frame(
        "region string, matdirec string, distr_chan string, sales_qt long, plan_qt long,"
        " plan_exec_perc double, material string",
        ("R1", "A", "1", 10, 20, 50.0, "m1"),
    )
    regions = [f"region = 'R{i}'" for i in range(5)]
    mart = jdbc.read_jdbc(
        Reader(arrived), {"url": "jdbc:any:db"}, "plan_fact_202101", schemas.SERVING_PLAN_FACT, regions
    )
    assert [f.dataType for f in mart.schema] == [f.dataType for f in schemas.SERVING_PLAN_FACT]
    assert rows(mart) == [("R1", "A", "1", 10, 20, 50.0, "m1")]
