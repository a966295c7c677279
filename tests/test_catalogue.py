"""Every query against its SQL twin, over whole tables."""

import os

import pytest
from compare import connect, duck_rows, spark_rows

import __spark_entry__ as contract
from martloom.catalogue.oracle import all_sql
from martloom.catalogue.queries import all_queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

# Spark's name of each DuckDB type.
KINDS = {
    "INTEGER": "int",
    "BIGINT": "bigint",
    "VARCHAR": "string",
    "DATE": "date",
    "DOUBLE": "double",
    "FLOAT": "float",
    "BOOLEAN": "boolean",
}


@pytest.fixture(scope="module")
def duck():
    connection = connect(FOLDER)
    yield connection
    connection.close()


def test_every_query_has_a_twin():
    assert set(all_queries()) == set(all_sql())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_sql(spark, duck, name):
    names, kinds, found = spark_rows(all_queries()[name](spark, FOLDER))
    sql_names, sql_kinds, wanted = duck_rows(duck, all_sql()[name])
    assert names == sql_names
    assert kinds == [KINDS.get(k, k.lower().replace(" ", "")) for k in sql_kinds]
    assert found == wanted
    assert found or name in ("point_lookup", "stored_point_lookup")


def test_entry(spark):
    report = contract.entry(spark)
    assert report.columns[:2] == ["plant_name", "plant"]
    assert report.count() > 0
