"""Refinement, marts and reports on small frames with awkward rows."""

from decimal import Decimal

import pytest
from conftest import day, rows

from martloom import schemas
from martloom.plans import plan_fact, refine, sales_mart, serving

D1, D2 = day("2021-01-05"), day("2021-01-06")
BILLS = "billnum long, billitem long, material long, plant string, qty long," \
    " netval decimal(17,2), tax decimal(17,2), rpa_sat decimal(17,2), calday date"
COUPONS = "plant string, calday date, coupon_nm string, promo_id string, material long," \
    " billnum long, unit_price decimal(17,2), promo_type string, discount decimal(17,2)"
TRAFFIC = "plant string, calday date, time string, frame_id string, quantity int"
ITEMS = "billnum long, billitem long, material long, qty long, netval decimal(17,2)," \
    " tax decimal(17,2), rpa_sat decimal(17,2), calday date"


def money(text):
    return Decimal(text)


def bill(number, plant, amount, qty=1, date=D1):
    return (number, 1, 5, plant, qty, None, None, money(amount), date)


def coupon(plant, discount, date=D1):
    value = None if discount is None else money(discount)
    return (plant, date, "c", "P", 5, 1, None, "001", value)


# ---- refinement -------------------------------------------------------------------


def test_unreadable_rows_are_set_aside_not_lost(frame):
    raw = frame(
        "plant string, calday string, coupon_nm string, promo_id string, material string,"
        " billnum string",
        ("M1", "20210105", "c1", "P", "5", "1"),
        ("M1", "2021-01-05", "c2", "P", "5", "1"),
        ("M1", "20210105", "c3", "P", "five", "1"),
        ("M1", None, "c4", "P", None, None),  # nothing to read: stays, as NULL
        ("M1", "20210105", "  ", "P", "5", "1"),  # blank text: dropped
        (None, "20210105", "c6", "P", "5", "1"),
    )
    assert [r.coupon_nm for r in refine.coupons_ods(raw).collect()] == ["c1", "c4"]
    assert [r.coupon_nm for r in refine.coupons_rejects(raw).rows.collect()] == ["c2", "c3"]


def test_traffic_days(frame):
    raw = frame(
        "plant string, date string, time string, frame_id string, quantity int",
        ("M1", "05.01.2021", "101500", "f", 3),
        ("M1", "31.02.2021", "101500", "f", 4),
    )
    assert [r.calday for r in refine.traffic_ods(raw).collect()] == [D1, None]
    assert [r.quantity for r in refine.traffic_rejects(raw).rows.collect()] == [4]


def test_promos(frame):
    raw = frame(
        "promo_id string, txt string, promo_type string, material string, discount decimal(17,2)",
        ("P1", "t", "001", "5", money("1.00")),
        ("P2", "", "001", "5", money("1.00")),
        ("P3", "t", "001", "x", money("1.00")),
    )
    assert [r.promo_id for r in refine.promos_ods(raw).collect()] == ["P1"]
    assert [r.promo_id for r in refine.promos_rejects(raw).rows.collect()] == ["P3"]


def test_items_without_header_drop_and_repeated_headers_repeat(frame):
    items = frame(
        ITEMS,
        (1, 1, 5, 2, None, None, money("3.00"), D1),
        (2, 1, 5, 2, None, None, money("4.00"), D1),
        (3, 1, 5, 2, None, None, money("5.00"), D1),
        (None, 1, 5, 2, None, None, money("6.00"), D1),
    )
    heads = frame(
        "billnum long, plant string, calday date", (1, "M1", D1), (2, "M2", D1), (2, "M3", D2),
        (None, "M9", D1),
    )
    found = refine.bills_dds(items, heads)
    assert [(r.billnum, r.plant) for r in found.orderBy("billnum", "plant").collect()] == [
        (1, "M1"),
        (2, "M2"),
        (2, "M3"),
    ]
    assert found.columns == schemas.DDS_BILLS.names


def test_a_bill_with_a_third_of_all_items(spark, no_broadcast):
    items = spark.range(9000).selectExpr(
        "if(id % 3 = 0, 7L, id) as billnum", "id % 9 as billitem", "5L as material",
        "1 + id % 4 as qty", "cast(1 as decimal(17,2)) as netval",
        "cast(0 as decimal(17,2)) as tax", "cast(id % 11 as decimal(17,2)) as rpa_sat",
        "date'2021-01-05' as calday",
    )
    heads = spark.range(9000).selectExpr(
        "id as billnum", "concat('M', id % 5) as plant", "date'2021-01-05' as calday"
    )
    spread = refine.bills_dds(items, heads)
    plain = items.join(heads.select("billnum", "plant"), "billnum").select(spread.columns)
    assert rows(spread) == rows(plain)
    days = [sales_mart.bills_daily(df, "2021-01-05") for df in (spread, plain)]
    assert rows(days[0]) == rows(days[1])


def test_coupons_of_a_period_are_those_of_the_whole(frame):
    days = ["20210131", "20210201", "20210228", "20210301", "20210230", "2021021", None, "202102011"]
    raw = frame(
        "plant string, calday string, coupon_nm string, promo_id string, material string, billnum string",
        *[("M1", d, f"c{i}", "P1", "7", "9") for i, d in enumerate(days)],
    )
    whole = refine.coupons_ods(raw).filter("calday between '2021-02-01' and '2021-02-28'")
    assert rows(refine.coupons_ods(raw, "2021-02-01", "2021-02-28")) == rows(whole)
    assert whole.count() == 2
    assert rows(refine.coupons_ods(raw, "2021-02-01")) == rows(whole.filter("calday = '2021-02-01'"))


@pytest.fixture
def coupon_case(frame):
    coupons = frame(
        "plant string, calday date, coupon_nm string, promo_id string, material long, billnum long",
        ("M1", D1, "a", "ABS", 5, 1),
        ("M1", D1, "a", "ABS", 5, 1),  # a copy
        ("M1", D1, "b", "PCT", 5, 1),
        ("M1", D1, "c", "ODD", 5, 1),
        ("M1", D1, "d", "NONE", 5, 1),  # no such promotion
        ("M1", D1, "e", "ABS", 5, 9),  # no such bill
        ("M1", D1, "f", "PCT", 6, 2),
        ("M1", D1, "g", "ABS", 7, 3),
        ("M1", D1, "h", "PCT", 8, 4),
        ("M1", D1, "i", "PCT", 9, 5),
    )
    items = frame(
        ITEMS,
        (1, 1, 5, 4, None, None, money("10.01"), D1),
        (1, 2, 5, 8, None, None, money("20.02"), D1),  # the same unit price
        (2, 1, 6, 3, None, None, money("10.00"), D1),  # 3.33...
        (2, 2, 6, 300, None, None, money("999.99"), D1),  # 3.3333
        (3, 1, 7, 0, None, None, money("1.00"), D1),  # no quantity
        (4, 1, 8, 5, None, None, money("0.00"), D1),  # given away
        (5, 1, 9, 3, None, None, money("-10.00"), D1),  # taken back, twice at one price
        (5, 2, 9, 6, None, None, money("-20.00"), D1),
    )
    promos = frame(
        "promo_id string, txt string, promo_type string, material long, discount decimal(17,2)",
        ("ABS", "t", "001", 99, money("1.50")),  # another material: does not matter
        ("PCT", "t", "002", 99, money("20.00")),
        ("ODD", "t", "003", 99, money("7.00")),
    )
    return coupons, items, promos


def test_coupon_discounts(coupon_case):
    found = refine.coupons_dds(*coupon_case)
    assert found.columns == schemas.DDS_COUPONS.names
    seen = [(r.coupon_nm, r.unit_price, r.promo_type, r.discount) for r in found.collect()]
    assert sorted(seen, key=repr) == sorted(
        [
            # 10.01 / 4 = 2.5025; the copy and the equal unit price of item 2 merge
            ("a", money("2.50"), "001", money("1.50")),
            ("b", money("2.50"), "002", money("0.50")),
            ("c", money("2.50"), "003", None),
            # unequal before rounding: both stay and look alike
            ("f", money("3.33"), "002", money("0.67")),
            ("f", money("3.33"), "002", money("0.67")),
            ("g", None, "001", money("1.50")),
            ("h", money("0.00"), "002", money("0.00")),
            ("i", money("-3.33"), "002", money("-0.67")),
        ],
        key=repr,
    )


def test_ties_round_away_from_zero(frame, coupon_case):
    coupons, _, promos = coupon_case
    items = frame(ITEMS, (1, 1, 5, 8, None, None, money("1.00"), D1))  # 0.125, and 20 % 0.025
    found = {r.coupon_nm: r for r in refine.coupons_dds(coupons, items, promos).collect()}
    assert found["b"].unit_price == money("0.13")
    assert found["b"].discount == money("0.03")


# ---- sales mart -------------------------------------------------------------------


@pytest.fixture
def mart_inputs(frame):
    bills = frame(
        BILLS,
        bill(1, "M1", "10.00", 2), bill(1, "M1", "5.00", 1), bill(2, "M1", "3.00", 1),
        bill(2, "M1", "4.00", 1, D2),  # the same bill on another day counts again
        bill(3, "M2", "9.00"),  # a day without traffic
        (None, 1, 5, "M1", 1, None, None, money("1.00"), D1),  # no number: money counts
    )
    coupons = frame(
        COUPONS,
        coupon("M1", "0.50"), coupon("M1", None),
        coupon("M2", "1.00"),  # a day without traffic
        coupon("M3", "2.00"),  # traffic, but no bill
    )
    traffic = frame(
        TRAFFIC,
        ("M1", D1, "t", "f", 30), ("M1", D1, "t", "f", 10), ("M3", D1, "t", "f", 7),
        ("M1", D2, "t", "f", None),
        ("M1", day("2021-02-01"), "t", "f", 99),
    )
    return bills, coupons, traffic


def test_traffic_drives_the_daily_mart(mart_inputs):
    mart = sales_mart.sales_mart_daily(*mart_inputs, "2021-01-01", "2021-01-31")
    found = {(r.calday, r.plant): r for r in mart.collect()}
    assert set(found) == {(D1, "M1"), (D2, "M1"), (D1, "M3")}
    first = found[D1, "M1"]
    assert first.turnover == money("19.00") and first.count_materials == 5
    assert first.bills_count == 2 and first.avg_bill == 9.5
    assert first.total_traffic == 40
    assert (first.sum_coupon_discount, first.discount_material_count) == (money("0.50"), 2)
    # Coupons without a bill row do not show, and unknown traffic stays unknown.
    assert found[D1, "M3"].discount_material_count == 0 and found[D1, "M3"].turnover == 0
    assert found[D2, "M1"].total_traffic is None and found[D2, "M1"].bills_count == 1


def test_one_day_mart(mart_inputs):
    mart = sales_mart.sales_mart_daily(*mart_inputs, "2021-01-06")
    assert [(r.calday, r.plant) for r in mart.collect()] == [(D2, "M1")]
    whole = sales_mart.sales_mart_daily(*mart_inputs, "2021-01-05", with_avg_materials=True)
    assert {r.plant: r.avg_materials for r in whole.collect()} == {"M1": 2.5, "M3": 0.0}


def test_daily_rows_are_the_days_with_traffic(mart_inputs):
    bills, coupons, traffic = mart_inputs
    mart = sales_mart.sales_mart_daily(bills, coupons, traffic, "2021-01-01", "2021-03-01")
    assert mart.count() == traffic.select("calday", "plant").distinct().count()


def test_store_report(frame, mart_inputs):
    mart = sales_mart.sales_mart_daily(*mart_inputs, "2021-01-01", "2021-01-31")
    stores = frame("plant string, txt string", ("M1", "One"), ("M9", "Nine"))
    report = sales_mart.sales_mart_view(mart, stores).collect()
    assert len(report) == 1  # M3 is no known store
    line = report[0]
    assert line.plant_name == "One" and line.bills_count == 3
    assert line.turnover_with_discount == money("22.50")
    assert line.discount_materials_share == money("33.3")  # 2 of 6
    assert line.avg_materials == money("2.00")
    assert line.conversion == money("7.50")  # 3 of 40
    assert line.avg_bill == money("7.7")  # 23 / 3
    assert line.avg_revenue_per_visitor == money("0.6")  # 0.575


def test_reports_over_nothing_are_null(frame, mart_inputs):
    mart = sales_mart.sales_mart_daily(*mart_inputs, "2021-01-01", "2021-01-31")
    stores = frame("plant string, txt string", ("M3", "Three"))
    line = sales_mart.sales_mart_view(mart, stores).first()
    assert line.avg_bill is None and line.discount_materials_share is None
    assert line.conversion == 0
    served = {r.plant: r for r in serving.sales_report(mart, stores).collect()}
    assert served["M3"].avg_bill is None and served["M3"].conversion == 0.0
    # The serving report keeps stores it has no name for.
    assert served["M1"].plant_name == "" and served["M1"].avg_bill == 23.0 / 3


def test_export_narrows_types(frame, mart_inputs):
    mart = sales_mart.sales_mart_daily(*mart_inputs, "2021-01-01", "2021-01-31")
    copy = serving.export_types(mart, schemas.SERVING_SALES_DAILY)
    assert [(f.name, f.dataType) for f in copy.schema] == [
        (f.name, f.dataType) for f in schemas.SERVING_SALES_DAILY
    ]
    assert copy.count() == mart.count()


# ---- plan and fact ----------------------------------------------------------------

SALES = "check_nm string, check_pos string, region string, material string, distr_chan string," \
    " quantity int, date date"
PLAN = "date date, region string, matdirec string, quantity int, distr_chan string"
PRODUCT = "material string, brand string, matdirec string, txt string"


def sale(region, material, quantity, channel="1", date="2021-01-31"):
    return ("c", "p", region, material, channel, quantity, day(date))


@pytest.fixture
def plan_inputs(frame):
    sales = frame(
        SALES,
        sale("R1", "m1", 6), sale("R1", "m2", 4), sale("R1", "m2", 2, "2"),  # tie at 6
        sale("R1", "m3", 1), sale("R1", "xx", 99),  # unknown material
        sale("R2", "m1", 50), sale("R2", "m3", None),  # unknown total ranks first
        sale("R3", "m1", 5),  # no plan
        sale("R1", "m3", 999, date="2021-02-01"), sale("R1", "m3", 999, date="2020-12-31"),
    )
    plan = frame(
        PLAN,
        (day("2021-01-01"), "R1", "A", 10, "1"), (day("2021-01-31"), "R1", "A", 10, "1"),
        (day("2021-01-31"), "R1", "B", 0, "1"),  # nothing planned
        (day("2021-01-31"), "R1", "B", 5, "9"),  # nothing sold
        (day("2021-01-31"), "R2", "B", 5, "1"),
        (day("2021-01-31"), "R4", "A", 5, "1"),  # region without sales
        (day("2021-02-01"), "R1", "A", 77, "1"),
    )
    product = frame(
        PRODUCT, ("m1", "b1", "A", "one"), ("m2", "b2", "A", "two"), ("m3", "b3", "B", "three")
    )
    return sales, plan, product


def test_best_sellers_with_ties_and_unknown_totals(plan_inputs):
    sales, _, product = plan_inputs
    top = plan_fact.top_material_by_region(sales, product, "202101")
    assert rows(top.select("region", "material", "sales_qt")) == [
        ("R1", "m1", 6), ("R1", "m2", 6), ("R2", "m3", None), ("R3", "m1", 5),
    ]


def test_plan_fact_mart(plan_inputs):
    mart = plan_fact.plan_fact_mart(*plan_inputs, "202101")
    assert rows(mart) == sorted(
        [
            *[("R1", "A", "1", 10, 20, 50.0, m) for m in ("m1", "m2")],
            *[("R1", "B", "1", 1, 0, 0.0, m) for m in ("m1", "m2")],
            *[("R1", "B", "9", 0, 5, 0.0, m) for m in ("m1", "m2")],
            ("R2", "B", "1", 0, 5, 0.0, "m3"),
        ],
        key=repr,
    )


def test_a_month_without_plan_is_empty(plan_inputs):
    assert plan_fact.plan_fact_mart(*plan_inputs, "202012").isEmpty()


def test_repeated_products_repeat_their_sales(frame, plan_inputs):
    sales, plan, product = plan_inputs
    twice = product.union(frame(PRODUCT, ("m1", "b1", "A", "one again")))
    found = plan_fact.sales_by_direction(sales, twice, "202101")
    assert ("R1", "A", "1", 16) in rows(found)


@pytest.fixture
def report_inputs(frame, plan_inputs):
    mart = plan_fact.plan_fact_mart(*plan_inputs, "202101")
    region = frame("region string, txt string", ("R1", "North"))
    channel = frame("dist_chan string, txtsh string", ("1", "shop"))
    prices = frame(
        "material string, region string, dist_chan string, price decimal(19,4)",
        ("m1", "R1", "1", Decimal("1.2500")), ("m1", "R2", "2", Decimal("9.0000")),
        ("m2", "R2", "1", Decimal("2.0000")),
    )
    return mart, region, channel, plan_inputs[2].drop("matdirec"), prices


def test_view_drops_unknown_names_and_keeps_missing_prices(report_inputs):
    view = plan_fact.plan_fact_view(*report_inputs)
    found = [(r.matdirec, r.region_name, r.chan_name, r.brand, r.price) for r in view.collect()]
    assert sorted(found, key=repr) == sorted(
        [
            ("A", "North", "shop", "b1", Decimal("1.2500")), ("A", "North", "shop", "b2", None),
            ("B", "North", "shop", "b1", Decimal("1.2500")), ("B", "North", "shop", "b2", None),
        ],
        key=repr,
    )


def test_report_keeps_every_line_and_prices_by_material(report_inputs):
    report = serving.plan_fact_report(*report_inputs)
    assert report.count() == report_inputs[0].count()
    found = {(r.region, r.matdirec, r.distr_chan, r.material): r for r in report.collect()}
    known = found["R1", "A", "1", "m1"]
    assert (known.region_name, known.product_name, known.price) == ("North", "one", 9)
    unknown = found["R2", "B", "1", "m3"]
    assert (unknown.region_name, unknown.chan_name, unknown.price) == ("", "shop", 0)
    assert found["R1", "B", "9", "m1"].chan_name == ""


def test_point_lookup(report_inputs):
    keys = {"region": "R1", "matdirec": "A", "distr_chan": "1"}
    assert serving.point_lookup(report_inputs[0], keys).count() == 2
    assert serving.point_lookup(report_inputs[0], {**keys, "region": "R9"}).count() == 0
