from datetime import date, datetime

import pytest
from conftest import as_dicts, by, d

from tradeloom.plans import order_jobs

ORDERS = "order_id int, customer_id int, order_date date"
LINES = "order_id int, product_id int, unit_price decimal(10,2), quantity int, discount decimal(3,2)"
AT, LATER = datetime(2000, 1, 1, 10), datetime(2000, 1, 2, 11)


@pytest.fixture
def orders(frame):
    return frame(ORDERS, (1, 1, date(1997, 2, 1)), (2, 1, date(1997, 2, 1)), (3, 2, date(1997, 12, 31)), (4, 9, date(1997, 3, 1)),
                 (5, None, date(1996, 1, 1)))


@pytest.fixture
def lines(frame):
    # Both lines of order 1 are 0.125 and round up before they are summed.
    return frame(LINES, (1, 1, d("0.25"), 1, d("0.50")), (1, 2, d("0.25"), 1, d("0.50")), (3, 1, d("10.00"), 2, None))


@pytest.fixture
def customers(frame):
    return frame("customer_id int, company_name string", (1, "one"), (2, "two"))


def test_totals(frame, orders, lines):
    requested = frame("order_id int", (1,), (2,), (3,), (99999,))
    rows = by(order_jobs.order_totals(requested, orders, lines), "order_id")
    assert {key: (r["order_total"], r["order_exists"]) for key, r in rows.items()} == {
        1: (d("0.26"), True), 2: (d("0.00"), True), 3: (d("20.00"), True), 99999: (d("0.00"), False),
    }


def test_check(orders, customers, lines):
    rows = by(order_jobs.order_total_check(orders, customers, lines, ids=(1, 2)), "order_id")
    assert {key: row["validation"] for key, row in rows.items()} == {1: "VALID", 2: "CHECK"}
    assert set(by(order_jobs.order_total_check(orders, customers, lines), "order_id")) == {1, 2, 3}


def test_batch_takes_the_newest_and_fullest(orders, customers, lines):
    whole = by(order_jobs.order_batch(orders, customers, lines, "b", AT), "order_id")
    assert {key: row["item_count"] for key, row in whole.items()} == {1: 2, 2: 0, 3: 1}
    top = order_jobs.order_batch(orders, customers, lines, "b", AT, limit=2)
    assert set(by(top, "order_id")) == {3, 1}
    assert as_dicts(order_jobs.batch_progress(top))[0] == {
        "records_processed": 2, "total_amount": d("20.26"), "average_order": d("10.13"),
    }


def test_bulk_rerun_refreshes_only_the_time(orders, lines, frame):
    first = order_jobs.order_bulk(orders, lines, "b", AT, limit=1)
    assert set(by(first, "order_id")) == {1}
    changed = frame(LINES, (1, 1, d("500.00"), 1, None))
    rows = by(order_jobs.order_bulk(orders, changed, "b", LATER, stored=first), "order_id")
    assert set(rows) == {1, 2, 4}
    assert (rows[1]["total_amount"], rows[1]["processing_timestamp"]) == (d("0.26"), LATER)
    assert rows[2]["total_amount"] == 0
    other = order_jobs.order_bulk(orders, changed, "c", LATER, limit=1, stored=first)
    assert len(as_dicts(other)) == 2


def test_summaries(orders, customers, lines):
    batch = order_jobs.order_batch(orders, customers, lines, "a", AT)
    analytics = batch.unionByName(order_jobs.order_bulk(orders, lines, "b", LATER))
    batches = by(order_jobs.batch_summary(analytics), "batch_id")
    assert batches["a"]["started_at"] == "2000-01-01 10:00:00"
    assert batches["a"]["avg_order_value"] == d("6.75")
    assert batches["b"]["orders_processed"] == 3
    spenders = as_dicts(order_jobs.customer_summary(analytics, limit=2))
    assert [(row["customer_id"], row["order_count"]) for row in spenders] == [(2, 1), (1, 4)]
    assert as_dicts(order_jobs.overall(analytics))[0]["total_processed_value"] == d("20.52")
