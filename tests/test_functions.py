import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

import pytest
from conftest import day
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martloom.functions import dates, text
from martloom.functions.rounding import cents, half_up, ratio, round_ratio


@settings(max_examples=3, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.integers(-(10**17), 10**17),
            st.integers(-(10**6), 10**6).filter(bool),
        ),
        min_size=50,
        max_size=200,
    )
)
def test_round_ratio_is_exact(spark, pairs):
    pairs = [(n // 10**9, d) for n, d in pairs] + [(5, 2), (-5, 2), (25, 20), (1, 3), (0, 7)]
    df = spark.createDataFrame(pairs, "n long, d long")
    for digits in (1, 2):
        unit = Decimal(1).scaleb(-digits)
        for row in df.withColumn("r", round_ratio(F.col("n"), F.col("d"), digits)).collect():
            exact = (Decimal(row.n) / Decimal(row.d)).quantize(unit, ROUND_HALF_UP)
            assert row.r == exact, row


def test_half_up_of_products_beyond_64_bits(frame):
    df = frame(
        "a decimal(17,2), b decimal(17,2), d long",
        (Decimal("123456789012345.67"), Decimal("999999999999999.99"), 10**17),
    )
    found = df.select(half_up(cents("a") * cents("b"), F.col("d"))).first()[0]
    assert found == (12345678901234567 * 99999999999999999 * 2 + 10**17) // (2 * 10**17)


def test_ratios_over_zero_are_null(frame):
    df = frame("n long, d long", (5, 0), (0, 0), (None, 1), (1, None))
    made = df.select(ratio(F.col("n"), F.col("d")), round_ratio(F.col("n"), F.col("d"), 1))
    assert [tuple(r) for r in made.collect()] == [(None, None)] * 4


def test_month_windows():
    assert dates.month_bounds("202402") == (day("2024-02-01"), day("2024-02-29"))
    # The month of the end date is inside as a whole.
    assert dates.month_window("2021-01-15", "2021-02-01") == (day("2021-01-01"), day("2021-03-01"))
    assert dates.month_window("2021-12-31", "2021-12-31") == (day("2021-12-01"), day("2022-01-01"))
    lo, hi = dates.month_window("2021-11-05", "2022-01-02")
    assert [f"{m:%Y%m}" for m in dates.months_between(lo, hi)] == ["202111", "202112", "202201"]
    assert dates.as_date(dt.datetime(2021, 1, 2, 3)) == day("2021-01-02")


def test_period_range_must_start_a_period(spark):
    with pytest.raises(ValueError):
        dates.period_range("d", "year", "2009-02-01")
    with pytest.raises(ValueError):
        dates.period_range("d", "month", "2009-02-02")
    with pytest.raises(ValueError):
        dates.period_range("d", "week", "2009-02-02")


def test_unreadable_days_are_null(frame):
    df = frame("d string", ("20210230",), ("2021",), ("",), ("20210228",), (None,))
    found = [r[0] for r in df.select(dates.parse_day("d", dates.COMPACT_DAY)).collect()]
    assert found == [None, None, None, day("2021-02-28"), None]


def test_in_and_outside_window_split_all_rows(frame):
    lo, hi = day("2021-01-01"), day("2021-02-01")
    df = frame("d date", (lo,), (hi,), (day("2021-01-31"),), (day("2020-12-31"),), (None,))
    assert df.filter(dates.in_window("d", lo, hi)).count() == 2
    assert df.filter(dates.outside_window("d", lo, hi)).count() == 3


def test_names():
    assert text.sales_mart_name("2021-01-01", "2021-02-28") == "sales_data_20210101_20210228"
    assert text.sales_mart_name("2021-01-01") == "sales_data_20210101"
    assert text.sales_view_name("2021-01-01") == "v_sales_mart20210101"
    assert text.plan_fact_name("202101") == "plan_fact_202101"
    assert text.plan_fact_view_name("202101") == "v_plan_fact_202101"
    assert text.normalize_name(" A;b/'C ") == "abc"


def test_normalize_key_and_parts(frame):
    df = frame("n string", (" Raw.Sales;'/ ",), ("nodot",), ("a.b.c",))
    found = df.select(
        text.normalize_key("n"), text.schema_part("n"), text.table_part("n")
    ).collect()
    assert found[0][0] == "raw.sales"
    assert tuple(found[1][1:]) == ("", "nodot")
    assert tuple(found[2][1:]) == ("a", "b.c")
