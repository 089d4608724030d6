import pytest
from conftest import as_dicts, by, d
from pyspark.sql import functions as F

from tradeloom.functions.calendar import warehouse_calendar
from tradeloom.plans import quality
from tradeloom.plans.constraints import line_rules, sales_rules

FACT = (
    "date_id int, customer_id int, product_id int, quantity_sold int, unit_price decimal(10,2), discount decimal(3,2), "
    "total_amount decimal(15,2), tax_amount decimal(15,2)"
)


def _row(date_id=1, customer=1, product=1, quantity=1, price="1.00", discount="0.00", total="1.00"):
    return (date_id, customer, product, quantity, d(price), d(discount), d(total), d("0.10"))


@pytest.fixture
def dimensions(spark, frame):
    return frame("customer_id int", (1,)), frame("product_id int", (1,)), warehouse_calendar(spark)


def test_orphans(frame, dimensions):
    fact = frame(FACT, _row(), _row(customer=2), _row(customer=None), _row(product=5), _row(date_id=99999), _row(date_id=99999))
    assert as_dicts(quality.orphans(fact, *dimensions)) == [
        {"orphaned_customer_records": 2, "orphaned_product_records": 1, "orphaned_date_records": 2}
    ]


def test_integrity_and_ranges(frame):
    fact = frame(FACT, _row(customer=None), _row(quantity=0, total="-1.00"), _row(total="7.00"))
    row = as_dicts(quality.fact_integrity(fact))[0]
    assert row == {
        "total_fact_records": 3, "missing_customer_id": 1, "missing_product_id": 0, "missing_date_id": 0,
        "negative_total_amount": 1, "invalid_quantity": 1,
    }
    assert as_dicts(quality.amount_ranges(fact))[0]["avg_total_amount"] == d("4.00")
    assert as_dicts(quality.business_ranges(fact))[0]["min_total_amount"] == d("-1.00")


def test_checks_of_an_empty_fact(frame, dimensions):
    fact = frame(FACT)
    assert as_dicts(quality.fact_integrity(fact))[0]["missing_customer_id"] == 0
    assert as_dicts(quality.quality_score(fact, *dimensions))[0]["total_quality_score"] is None
    assert as_dicts(quality.completeness({"fact": (fact, ["customer_id"])}))[0]["null_percentage"] is None


def test_completeness(frame):
    df = frame("a int, b string", (1, None), (2, None), (None, "x"))
    rows = by(quality.completeness({"t": (df, ["a", "b"])}), "column_name")
    assert (rows["a"]["null_count"], rows["a"]["null_percentage"]) == (1, d("33.33"))
    assert (rows["b"]["null_count"], rows["b"]["null_percentage"]) == (2, d("66.67"))


def test_score_literal_and_corrected(frame, dimensions):
    # 3 * 0.15 * 0.90 is 0.405, stored as 0.41.
    fact = frame(FACT, _row(), _row(quantity=3, price="0.15", discount="0.10", total="0.41"))
    literal = as_dicts(quality.quality_score(fact, *dimensions))[0]
    corrected = as_dicts(quality.quality_score(fact, *dimensions, corrected=True))[0]
    assert (literal["consistency"], literal["total_quality_score"], literal["quality_rating"]) == (d("15.00"), d("85.00"), "Good")
    assert (corrected["total_quality_score"], corrected["quality_rating"]) == (d("100.00"), "Excellent")


@pytest.mark.parametrize(
    ("bad", "of", "rating"), [(1, 6, "Excellent"), (1, 2, "Good"), (5, 6, "Fair"), (6, 7, "Poor"), (0, 3, "Excellent")]
)
def test_ratings(frame, dimensions, bad, of, rating):
    rows = [_row(total="2.00") if i < bad else _row() for i in range(of)]
    assert as_dicts(quality.quality_score(frame(FACT, *rows), *dimensions))[0]["quality_rating"] == rating


def test_missing_dimension_lowers_completeness(frame, dimensions):
    fact = frame(FACT, _row(customer=7), _row(product=7), _row(date_id=0), _row())
    assert as_dicts(quality.quality_score(fact, *dimensions))[0]["completeness"] == d("10.00")


def test_gate_counts_each_rule(frame):
    parent = frame("id int", (1,), (2,))
    rows = frame("id int, ref int, name string, n int", (1, 1, "abc", 1), (1, 3, "abcdef", -1), (None, None, None, None), (2, 3, "x", 7))
    rules = [
        *quality.required("id"),
        quality.at_most("name", 3),
        quality.within("n", 0, 5),
        quality.UniqueRule("id is unique", ("id",)),
        quality.ReferenceRule("ref exists", "ref", parent, "id"),
    ]
    found = by(quality.constraint_gate({"t": (rows, rules)}), "table_name", "rule")
    assert {rule: row["violations"] for (_, rule), row in found.items()} == {
        "id is required": 1, "name has at most 3 characters": 1, "n in 0..5": 2, "id is unique": 1, "ref exists": 2,
    }
    clean, rejected = quality.split_rows(rows, [rule for rule in rules if isinstance(rule, quality.RowRule)])
    assert [row["name"] for row in as_dicts(clean)] == ["abc"]
    assert {row["name"]: row["reason"] for row in as_dicts(rejected)} == {
        "abcdef": "name has at most 3 characters", None: "id is required", "x": "n in 0..5",
    }


LINES = "unit_price decimal(10,2), quantity int, discount decimal(3,2)"


def test_line_rules_each_fail_once(frame):
    rows = frame(
        LINES, (d("1"), 1, d("0")), (None, 1, d("0")), (d("1"), None, d("0")), (d("1"), 1, None), (d("1"), 0, d("0")),
        (d("-1"), 1, d("0")), (d("1"), 1, d("1.01")),
    )
    counts = {row["rule"]: row["violations"] for row in as_dicts(quality.violations("lines", rows, line_rules()))}
    assert set(counts.values()) == {1}
    assert len(counts) == 6


def test_sales_rules_cover_every_column(frame):
    columns = ["date_id", "customer_id", "product_id", "employee_id", "category_id", "shipper_id", "supplier_id", "order_id",
               "quantity_sold", "unit_price", "discount", "line_total", "tax_amount", "freight_cost"]
    empty = frame(", ".join(f"{name} int" for name in columns), tuple([None] * len(columns)))
    counts = {row["rule"]: row["violations"] for row in as_dicts(quality.violations("sales", empty, sales_rules()))}
    assert {rule for rule, count in counts.items() if count} == {f"{name} is required" for name in columns}
    fine = empty.select(*[F.lit(1).alias(name) for name in columns])
    assert all(row["violations"] == 0 for row in as_dicts(quality.violations("sales", fine, sales_rules())))
