"""Reports on small facts that reach the branches test data cannot."""

from datetime import date

import pytest
from conftest import as_dicts, by, d

from tradeloom.functions.calendar import warehouse_calendar
from tradeloom.plans import mart_reports, sales_reports

FACT = (
    "date_id int, customer_id int, product_id int, category_id int, quantity_sold int, "
    "total_amount decimal(15,2), tax_amount decimal(15,2), order_year int"
)
CUSTOMERS = "customer_id int, company_name string, country string, city string"
CATEGORIES = "category_id int, category_name string"
START = date(1990, 1, 1)


@pytest.fixture(scope="module")
def calendar(spark):
    return warehouse_calendar(spark).cache()


@pytest.fixture
def fact(frame):
    def make(*sales):
        """(day, customer, product, category, amount) per sale."""
        rows = [
            ((day - START).days + 1, customer, product, category, 1, d(amount), d("0.10"), day.year)
            for day, customer, product, category, amount in sales
        ]
        return frame(FACT, *rows)

    return make


@pytest.fixture
def categories(frame):
    return frame(CATEGORIES, (1, "Tea"), (2, "Rice"))


def test_trend_over_a_gap_and_from_zero(fact, calendar, categories):
    sales = fact(
        (date(1995, 3, 1), 1, 1, 1, "10.00"),
        (date(1995, 4, 1), 1, 1, 1, "99.00"),
        (date(1997, 1, 1), 1, 1, 1, "0.00"),
        (date(1997, 2, 1), 1, 1, 1, "5.00"),
        (date(1997, 3, 1), 1, 1, 1, "3.33"),
        (date(1997, 3, 2), 1, 1, 1, "3.34"),
    )
    rows = by(sales_reports.monthly_category_trend(sales, calendar, categories), "year", "month")
    assert set(rows) == {(1995, 3), (1997, 1), (1997, 2), (1997, 3)}
    assert rows[(1995, 3)]["previous_month_sales"] is None
    assert rows[(1997, 1)]["previous_month_sales"] == d("10.00")
    assert rows[(1997, 1)]["sales_growth_percent"] == d("-100.00")
    assert rows[(1997, 2)]["sales_growth_percent"] is None
    assert rows[(1997, 3)]["sales_growth_percent"] == d("33.40")
    assert rows[(1997, 3)]["avg_sales_amount"] == d("3.34")


def test_top_products_keep_ties(frame, fact, calendar, categories):
    day = date(1997, 1, 15)
    # Products 1 to 6 tie for value; product 7 sells more often for less.
    sales = fact(*[(day, 1, p, 1, "10.00") for p in range(1, 7)], (day, 1, 7, 1, "1.00"), (day, 1, 7, 1, "1.00"))
    products = frame("product_id int, product_name string, category_id int", *[(p, f"p{p}", 1) for p in range(1, 8)])
    rows = by(sales_reports.top_products_monthly(sales, calendar, products, categories), "product_name")
    assert {name: (r["transaction_rank"], r["sales_rank"], r["performance_category"]) for name, r in rows.items()} == {
        **{f"p{p}": (2, 1, "Top in Both") for p in range(1, 7)},
        "p7": (1, 7, "Top in Transactions"),
    }


def test_top_customers_with_ties(frame, fact, calendar):
    day = date(1997, 1, 15)
    sales = fact(*[(day, c, 1, 1 + c % 2, "10.00") for c in range(12)], (day, 11, 1, 1, "90.00"))
    customers = frame(CUSTOMERS, *[(c, f"c{c}", "X", "Y") for c in range(12)])
    rows = as_dicts(sales_reports.top_customers(sales, calendar, customers))
    assert [row["customer_id"] for row in rows] == [11, 0, 1, 2, 3, 4, 5, 6, 7, 8]
    assert rows[0]["customer_value_score"] == d("0.61")
    assert rows[0]["unique_categories_purchased"] == 2 - (11 % 2 == 0)
    assert {row["purchase_rank"] for row in rows[1:]} == {2}


def test_first_week_uses_the_lowest_iso_week(fact, calendar):
    sales = fact(
        (date(1997, 12, 29), 1, 1, 1, "5.00"),
        (date(1997, 12, 1), 1, 1, 1, "7.00"),
        (date(1998, 12, 31), 1, 1, 1, "9.00"),
        (date(1998, 12, 1), 1, 1, 1, "5.00"),
        (date(1999, 1, 1), 1, 1, 1, "3.00"),
        (date(1999, 1, 4), 1, 1, 1, "4.00"),
    )
    rows = by(sales_reports.first_week_sales(sales, calendar), "year", "month")
    # The last days of December 1997 are ISO week 1; 1 January 1999 is week 53 of the year before.
    assert rows[(1997, 12)]["first_week"] == 1
    assert rows[(1997, 12)]["total_sales_amount"] == d("5.00")
    assert rows[(1998, 12)]["first_week"] == 49
    assert rows[(1998, 12)]["growth_status"] == "Stable"
    assert rows[(1999, 1)]["total_sales_amount"] == d("4.00")
    assert rows[(1999, 1)]["growth_status"] == "Stable"


def test_weekly_share_and_running_sum(fact, calendar, categories):
    sales = fact(
        (date(1997, 12, 1), 1, 1, 1, "10.00"),
        (date(1997, 12, 31), 1, 1, 1, "30.00"),
        (date(1998, 12, 1), 1, 1, 1, "50.00"),
    )
    rows = by(sales_reports.weekly_category_sales(sales, calendar, categories), "week_of_year")
    assert set(rows) == {1, 49}
    # Week 1 sorts first although its days are the last of the month.
    assert rows[1]["running_monthly_sales"] == d("30.00")
    assert rows[49]["running_monthly_sales"] == d("40.00")
    assert rows[49]["weekly_contribution_percent"] == d("25.00")


def test_median_needs_three_months(frame, fact, calendar, categories):
    customers = frame(CUSTOMERS, (1, "a", "X", "c"), (2, "b", "Y", "c"))
    months = [(date(1997, m, 1), 1, 1, 1, amount) for m, amount in ((1, "10.00"), (2, "10.00"), (3, "13.00"), (4, "0.00"))]
    sales = fact(*months, (date(1997, 1, 1), 2, 1, 1, "1.00"), (date(1997, 2, 1), 2, 1, 1, "1.00"))
    rows = as_dicts(sales_reports.median_sales(sales, calendar, customers, categories))
    assert len(rows) == 1
    assert rows[0]["monthly_periods"] == 3
    # The average is exactly ten percent above the median, which does not count as skewed.
    assert (rows[0]["avg_monthly_sales"], rows[0]["median_sales"]) == (d("11.00"), d("10.00"))
    assert rows[0]["distribution_type"] == "Symmetric"
    assert (rows[0]["third_quartile"], rows[0]["inter_quartile_range"]) == (d("11.50"), d("1.50"))


def test_category_ranking(fact, categories):
    day = date(1997, 1, 1)
    sales = fact((day, 1, 1, 1, "30.00"), (day, 1, 2, 2, "5.00"), (day, 2, 2, 2, "5.00"))
    rows = by(sales_reports.category_ranking(sales, categories), "category_name")
    assert rows["Tea"]["performance_category"] == "Top Seller"
    assert rows["Tea"]["performance_score"] == d("0.50")
    assert rows["Rice"]["performance_score"] == d("0.50")
    assert rows["Rice"]["market_share_percent"] == d("25.00")


def test_rfm_with_few_customers(frame, fact, calendar):
    customers = frame(CUSTOMERS, *[(c, f"c{c}", "X", "Y") for c in (1, 2, 3)])
    sales = fact(*[(date(1997, 1, c), c, 1, 1, "5.00") for c in (1, 2, 3)])
    rows = by(sales_reports.rfm_segments(sales, calendar, customers, date(1997, 1, 10)), "customer_id")
    assert {c: (r["recency"], r["r_score"], r["f_score"], r["m_score"]) for c, r in rows.items()} == {
        1: (9, 1, 1, 1), 2: (8, 2, 2, 2), 3: (7, 3, 3, 3),
    }
    assert [rows[c]["customer_segment"] for c in (1, 2, 3)] == ["Lost Customers", "Potential Loyalists", "Loyal Customers"]


PURCHASES = (
    "supplier_id int, date_id int, total_purchase_amount decimal(15,2), average_unit_price decimal(10,2), total_quantity int"
)


def test_scorecard_literal_and_corrected(frame):
    purchases = frame(
        PURCHASES,
        (1, 1, d("100.00"), d("1.00"), 10), (2, 1, d("100.00"), d("2.00"), 10), (2, 2, d("50.00"), d("3.00"), 5),
        (3, 1, d("999.00"), d("9.00"), 1),
    )
    suppliers = frame("supplier_id int, company_name string, country string", (1, "one", "X"), (2, "two", "X"), (3, "none", "X"))
    products = frame("product_id int, supplier_id int", (1, 1), (2, 2), (3, 2), (4, 2))
    literal = by(mart_reports.supplier_scorecard(purchases, suppliers, products), "supplier")
    corrected = by(mart_reports.supplier_scorecard(purchases, suppliers, products, corrected=True), "supplier")
    assert set(literal) == set(corrected) == {"one", "two"}
    assert (literal["two"]["total_spend"], corrected["two"]["total_spend"]) == (d("450.00"), d("150.00"))
    assert (literal["two"]["total_units"], corrected["two"]["total_units"]) == (45, 15)
    assert literal["two"]["avg_price"] == corrected["two"]["avg_price"] == d("2.50")
    assert literal["one"] == corrected["one"]


@pytest.mark.parametrize(
    ("bands", "expected"),
    [
        (mart_reports.SUPPLIER_TIERS, {"100000.01": 0, "100000": 1, "50000": 1, "49999.99": 2, "10000": 2, "9999.99": 3, "0": 3}),
        (mart_reports.DEMAND_BANDS, {"1001": 0, "1000": 1, "500": 1, "499": 2}),
        (mart_reports.SUPPLY_BANDS, {"61": 0, "60": 1, "30": 1, "29": 2, "15": 2, "14": 3, None: 3}),
        (mart_reports.VALUE_TIERS, {"50000.01": 0, "50000": 1, "20000": 1, "19999.99": 2, "10000": 2, "9999.99": 3}),
        (mart_reports.PERFORMANCE_BANDS, {"100000.01": 0, "100000": 1, "50000": 1, "25000": 2, "24999.99": 3}),
    ],
)
def test_bands(frame, bands, expected):
    df = frame("v decimal(15,2)", *[(d(value),) for value in expected])
    labels = [row["label"] for row in df.select(mart_reports.band(df.v, bands).alias("label")).collect()]
    assert labels == [bands[index][1] for index in expected.values()]


CUSTOMER_DAYS = (
    "customer_id int, date_id int, total_amount decimal(15,2), total_quantity int, number_of_transactions int, "
    "average_transaction_value decimal(15,2), days_since_first_purchase int"
)


def test_geography_keeps_a_null_region_apart_from_the_total(frame):
    days = frame(
        CUSTOMER_DAYS,
        (1, 1, d("10.00"), 1, 1, d("10.00"), 0), (1, 2, d("20.00"), 2, 1, d("20.00"), 1), (2, 1, d("5.00"), 1, 1, d("5.00"), 0),
    )
    customers = frame("customer_id int, country string, region string", (1, "X", None), (2, "X", "R"))
    rows = by(mart_reports.customer_geography(days, customers), "country", "region", "grouping_id")
    assert rows[("X", None, 1)]["total_revenue"] == d("35.00")
    assert rows[("X", None, 0)]["total_revenue"] == d("30.00")
    assert rows[("X", "R", 0)]["customer_count"] == 1
    assert rows[("X", None, 1)]["customer_count"] == 2
    assert rows[("X", None, 1)]["revenue_per_customer"] == d("17.50")
    assert rows[("X", None, 1)]["avg_order_value"] == d("11.67")


SALES = (
    "date_id int, order_id int, customer_id int, product_id int, supplier_id int, category_id int, employee_id int, "
    "quantity_sold int, unit_price decimal(10,2), line_total decimal(15,2)"
)


def test_links_count_orders_of_suppliers_that_share_a_name(frame, categories):
    # Suppliers 1 and 2 have one name; orders 1 and 2 hold lines of both.
    rows = [(1, o, 1, p, p, 1, 1, 1, d("2.00"), d("2.00")) for o in (1, 2) for p in (1, 2)]
    sales = frame(SALES, *rows)
    suppliers = frame("supplier_id int, company_name string", (1, "twin"), (2, "twin"))
    customers = frame(CUSTOMERS, (1, "c", "X", "Y"))
    named = sales.join(suppliers.withColumnRenamed("company_name", "supplier"), "supplier_id")
    named = named.join(categories.select("category_id", "category_name"), "category_id")
    found = as_dicts(mart_reports.supplier_customer_links(named, customers, min_orders=2))
    assert [(row["supplier"], row["shared_transactions"], row["total_units"]) for row in found] == [("twin", 2, 4)]
    assert as_dicts(mart_reports.supplier_customer_links(named, customers, min_orders=3)) == []


def test_sales_trend_status(spark, frame, calendar):
    days = [((date(1997, m, 1) - START).days + 1, amount) for m, amount in ((1, "10.00"), (2, "20.00"), (3, "15.00"))]
    days += [((date(1998, 1, 1) - START).days + 1, "15.00")]
    sales = frame(SALES, *[(day, 1, 1, 1, 1, 1, 1, 1, d("1.00"), d(amount)) for day, amount in days])
    rows = by(mart_reports.sales_trend(sales, calendar), "year", "month")
    assert [rows[key]["trend_status"] for key in sorted(rows)] == ["On Trend", "Above Trend", "On Trend", "Below Trend"]
    assert rows[(1998, 1)]["three_month_moving_avg"] == d("16.67")
    assert rows[(1998, 1)]["ytd_sales"] == d("15.00")
    assert rows[(1997, 3)]["ytd_sales"] == d("45.00")


def test_units_per_product_is_an_integer_division(frame, categories):
    sales = frame(SALES, *[(1, 1, 1, p, 1, 1, 1, q, d("1.00"), d("1.00")) for p, q in ((1, 4), (2, 3))])
    row = as_dicts(mart_reports.category_deep_dive(sales, categories, frame("product_id int", (1,), (2,))))[0]
    assert row["avg_units_per_product"] == 3
    assert row["avg_price_per_unit"] == d("0.29")
    assert row["market_share_percent"] == d("100.00")
