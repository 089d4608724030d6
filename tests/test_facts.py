from datetime import date

import pytest
from conftest import as_dicts, by, d

from tradeloom.functions.calendar import add_missing_days, mart_calendar, warehouse_calendar
from tradeloom.plans import mart, warehouse

LINES = "order_id int, product_id int, unit_price decimal(10,2), quantity int, discount decimal(3,2)"
ORDERS = "order_id int, customer_id int, employee_id int, order_date date, ship_via int, freight decimal(10,2)"
DAY = date(1997, 5, 5)


@pytest.fixture
def products(frame):
    return frame("product_id int, category_id int, supplier_id int", (1, 10, 100))


def _order(order_id, customer=1, day=DAY, freight="10.00"):
    return (order_id, customer, 1, day, 1, d(freight))


def test_calendars(spark):
    days = by(warehouse_calendar(spark), "date")
    assert len(days) == 4018
    assert days[date(1997, 12, 29)]["week_of_year"] == 1
    assert days[date(1999, 1, 1)]["week_of_year"] == 53
    assert days[date(1997, 5, 4)]["day_of_week"] == 7
    assert days[date(1997, 5, 4)]["is_weekend"]
    assert days[date(1997, 5, 4)]["month_name"] == "May      "
    assert days[date(1990, 1, 1)]["date_id"] == 1
    mart_days = by(mart_calendar(spark), "date")
    assert len(mart_days) == 13149
    assert mart_days[date(1997, 5, 4)]["day_of_week"] == 0
    assert mart_days[date(1997, 5, 3)]["day_name"] == "Saturday "


def test_stored_days_are_kept(spark):
    calendar = mart_calendar(spark, (date(2000, 1, 1), date(2000, 1, 3)))
    stored = calendar.filter("date_id = 2").replace(False, True, "is_holiday")
    merged = by(add_missing_days(stored, calendar), "date_id")
    assert {key: row["is_holiday"] for key, row in merged.items()} == {1: False, 2: True, 3: False}


def test_dimension_defaults(frame):
    schema = (
        "customer_id int, company_name string, contact_name string, contact_title string, address string, city string, "
        "region string, postal_code string, country string, phone string, fax string"
    )
    nothing = (None,) * 10
    rows = as_dicts(warehouse.dim_customer(frame(schema, (1, *nothing), (None, "lost", *nothing[1:]))))
    assert [(r["customer_id"], r["company_name"], r["city"], r["country"], r["region"]) for r in rows] == [
        (1, "Unknown", "Unknown", "Unknown", None)
    ]


def test_product_dimension(frame):
    schema = (
        "product_id int, product_name string, supplier_id int, category_id int, quantity_per_unit string, "
        "unit_price decimal(10,2), units_in_stock int, discontinued boolean"
    )
    staged = frame(
        schema,
        (1, None, 1, 1, None, None, None, None),
        (2, "no supplier", None, 1, None, None, None, None),
        (3, "unknown category", 1, 9, None, None, None, None),
        (None, "no key", 1, 1, None, None, None, None),
    )
    rows = as_dicts(warehouse.dim_product(staged, frame("supplier_id int", (1,)), frame("category_id int", (1,))))
    assert len(rows) == 1
    assert rows[0]["product_name"] == "Unknown"
    assert rows[0]["unit_price"] == d("0.00")
    assert rows[0]["units_in_stock"] == 0
    assert rows[0]["discontinued"] is False


def test_warehouse_fact_filters_and_rounding(spark, frame, products):
    calendar = warehouse_calendar(spark)
    orders = frame(
        ORDERS, _order(1), _order(2, day=None), _order(3, day=date(2001, 1, 1)), _order(4, customer=99)
    )
    lines = frame(
        LINES,
        (1, 1, d("10.05"), 1, None),
        (1, 1, d("10.05"), 0, d("0")),
        (1, 1, d("-1.00"), 1, d("0")),
        (1, 1, d("1.00"), 1, d("-0.10")),
        (1, 1, d("1.00"), 1, d("1.10")),
        (1, 1, d("7.77"), 3, d("1.00")),
        (1, 1, d("0.30"), 1, d("0.15")),
        (1, 2, d("1.00"), 1, d("0")),
        (2, 1, d("1.00"), 1, d("0")),
        (3, 1, d("1.00"), 1, d("0")),
        (4, 1, d("1.00"), 1, d("0")),
    )
    dated = warehouse.dated_orders(orders, frame("customer_id int", (1,)), calendar)
    rows = as_dicts(warehouse.fact_sales(lines, dated, products))
    # 0.255 rounds up to 0.26; its tax 0.0255 comes from the unrounded amount.
    assert sorted((r["unit_price"], r["total_amount"], r["tax_amount"]) for r in rows) == [
        (d("0.30"), d("0.26"), d("0.03")),
        (d("7.77"), d("0.00"), d("0.00")),
        (d("10.05"), d("10.05"), d("1.01")),
    ]
    assert {(r["category_id"], r["supplier_id"], r["order_year"]) for r in rows} == {(10, 100, 1997)}


def test_mart_freight_and_rejects(spark, frame, products):
    calendar = mart_calendar(spark)
    details = frame(
        LINES,
        (1, 1, d("2.00"), 1, d("0")),
        (1, 1, d("2.00"), 2, d("0.50")),
        (1, 1, d("2.00"), 3, None),
        (2, 1, d("2.00"), -3, d("0")),
    )
    dated = mart.dated_orders(frame(ORDERS, _order(1), _order(2)), calendar)
    orders = mart.with_freight_share(dated, mart.line_counts(details))
    sales = mart.fact_sales(mart.priced_lines(details, orders, products))
    accepted = by(mart.accepted_sales(sales), "quantity_sold")
    assert {key: row["freight_cost"] for key, row in accepted.items()} == {1: d("3.33"), 2: d("3.33")}
    assert accepted[2]["line_total"] == d("2.00")
    assert accepted[2]["tax_amount"] == d("0.20")
    rejected = {row["quantity_sold"]: row["reason"] for row in as_dicts(mart.rejected_sales(sales))}
    assert rejected == {3: "discount is null", -3: "violated: quantity_sold is positive"}


def test_customer_days(spark, frame):
    calendar = mart_calendar(spark)
    orders = frame(ORDERS, _order(1), _order(2), _order(3, day=date(1997, 5, 10)), _order(4, day=date(1997, 5, 1)))
    details = frame(
        LINES,
        (1, 1, d("1.00"), 1, d("0")),
        (1, 1, d("2.00"), 1, d("0")),
        (2, 1, d("2.00"), 1, d("0")),
        (3, 1, d("9.00"), 1, d("0")),
    )
    rows = by(mart.fact_customer_sales(details, mart.dated_orders(orders, calendar)), "days_since_first_purchase")
    # Order 4 has no lines, so the first purchase is on the fifth of May.
    assert set(rows) == {0, 5}
    assert rows[0]["number_of_transactions"] == 2
    assert rows[0]["average_transaction_value"] == d("1.67")


INVENTORY = (
    "product_id int, units_in_stock int, units_on_order int, reorder_level int, unit_price decimal(10,2)"
)


def test_inventory(spark, frame):
    stocked = frame(INVENTORY, (1, 25, 0, 25, d("2.00")), (2, 5, 0, 4, d("1.00")), (3, None, 0, 0, d("1.00")))
    details = frame(LINES, (1, 1, d("1"), 10, d("0")), (2, 1, d("1"), 10, d("0")))
    rows = by(mart.fact_inventory(stocked, details, mart_calendar(spark), DAY), "product_id")
    assert set(rows) == {1, 2}
    assert rows[1]["days_of_supply"] == 3
    assert rows[1]["is_below_reorder_level"]
    assert rows[1]["stock_value"] == d("50.00")
    assert rows[2]["days_of_supply"] is None
    assert not rows[2]["is_below_reorder_level"]
    with pytest.raises(Exception, match="outside the calendar"):
        mart.fact_inventory(stocked, details, mart_calendar(spark), date(2030, 1, 1)).collect()
