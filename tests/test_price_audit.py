import glob
import json
import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from conftest import as_dicts, by, d

from tradeloom.operators.price_audit import audit_listing, change_summary, latest_products, price_changes, price_steps, with_log_id
from tradeloom.streaming.price_feed import CHANGE_SCHEMA, PriceFeed, read_changes

SCHEMA = "product_id int, product_name string, category_id int, unit_price decimal(10,2)"
AT = datetime(2001, 5, 4, 3, 2, 1)


@pytest.fixture
def log(frame):
    before = frame(
        SCHEMA,
        (1, "null to zero", 1, None), (2, "zero to null", 1, d("0")), (3, "null to five", 1, None),
        (4, "same", 1, d("5")), (5, "from zero", 1, d("0")), (6, "steep", 1, d("1")), (7, "gone", 1, d("4")),
        (8, "five to null", 1, d("5")),
    )
    after = frame(
        SCHEMA,
        (1, "null to zero", 1, d("0")), (2, "zero to null", 1, None), (3, "renamed", 2, d("5")),
        (4, "same", 1, d("5")), (5, "from zero", 1, d("3")), (6, "steep", 1, d("25")), (8, "five to null", 1, None),
        (9, "new", 3, None),
    )
    return price_changes(before, after, "me", AT)


def test_snapshot_differences(log):
    rows = by(log, "product_id")
    assert {key: row["operation_type"] for key, row in rows.items()} == {
        3: "UPDATE", 5: "UPDATE", 6: "UPDATE", 7: "DELETE", 8: "UPDATE", 9: "INSERT",
    }
    assert (rows[3]["product_name"], rows[3]["category_id"]) == ("null to five", 1)
    assert rows[5]["change_percentage"] is None
    assert rows[6]["change_percentage"] == d("2400.00")
    assert rows[7]["change_percentage"] == d("-100.00")
    assert rows[9]["new_price"] == 0
    assert json.loads(rows[3]["session_info"]) == {"action": "price_adjustment", "price_difference": None, "session_user": "me"}
    assert json.loads(rows[7]["session_info"]) == {"action": "product_removal", "session_user": "me"}
    assert json.loads(rows[9]["session_info"])["current_time"] == "2001-05-04 03:02:01"


def test_change_below_a_tenth_of_a_cent_is_not_logged(frame):
    schema = SCHEMA.replace("decimal(10,2)", "decimal(10,4)")
    before, after = frame(schema, (1, "a", 1, d("5"))), frame(schema, (1, "a", 1, d("5.0005")))
    assert price_changes(before, after, "me", AT).count() == 0


def test_listing_and_summary(log):
    numbered = with_log_id(log, after=100)
    listing = as_dicts(audit_listing(numbered))
    assert [row["log_id"] for row in listing] == [106, 105, 104, 103, 102, 101]
    assert listing[0]["audit_action"] == "initial_price_set"
    assert as_dicts(audit_listing(numbered, product_id=6))[0]["change_pct"] == "2400.00%"
    twice = log.unionByName(log)
    row = by(change_summary(twice, product_id=6), "product_id")[6]
    assert (row["change_count"], row["total_change"], row["avg_change_pct"]) == (2, d("48.00"), d("2400.00"))
    assert row["first_change"] == "2001-05-04"


def _change(product, seq, price, removed=False, name="p"):
    return (product, seq, name, 1, price, removed, AT + timedelta(minutes=seq))


def test_feed_logs_every_change(frame):
    before = frame(SCHEMA, (11, "p", 1, d("10.00")))
    feed = frame(
        CHANGE_SCHEMA,
        _change(11, 1, d("11.50")), _change(11, 2, d("12.00")), _change(11, 3, d("12.00")),
        _change(11, 4, None, removed=True), _change(11, 5, d("9.00")), _change(12, 1, None, removed=True),
    )
    rows = sorted(as_dicts(price_steps(before, feed, "me")), key=lambda row: row["seq"])
    assert [(r["seq"], r["operation_type"], r["old_price"], r["new_price"]) for r in rows] == [
        (1, "UPDATE", d("10.00"), d("11.50")),
        (2, "UPDATE", d("11.50"), d("12.00")),
        (4, "DELETE", d("12.00"), d("0.00")),
        (5, "INSERT", d("0.00"), d("9.00")),
    ]
    assert as_dicts(latest_products(before, feed)) == [
        {"product_id": 11, "product_name": "p", "category_id": 1, "unit_price": d("9.00")}
    ]


def test_feed_with_a_hot_product_equals_a_loop(spark, frame):
    rng = random.Random(5)
    prices = {product: Decimal(rng.randint(1, 4)) for product in range(4)}
    feed, expected, now = [], [], dict(prices)
    for seq in range(600):
        product = 0 if rng.random() < 0.8 else rng.randrange(6)
        price, removed = Decimal(rng.randint(1, 4)), rng.random() < 0.1
        feed.append(_change(product, seq, price, removed))
        old, new = now.get(product), None if removed else price
        if old != new:
            expected.append((product, seq, old or Decimal(0), new or Decimal(0)))
        now.pop(product, None)
        if new is not None:
            now[product] = new
    before = frame(SCHEMA, *[(product, "p", 1, price) for product, price in prices.items()])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = as_dicts(price_steps(before, frame(CHANGE_SCHEMA, *feed), "me"))
        after = by(latest_products(before, frame(CHANGE_SCHEMA, *feed)), "product_id")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted((r["product_id"], r["seq"], r["old_price"], r["new_price"]) for r in rows) == sorted(expected)
    assert {product: row["unit_price"] for product, row in after.items()} == now


def test_stream(spark, frame, tmp_path):
    feed = PriceFeed(spark, str(tmp_path / "audit"), "me")
    feed.start_from(frame(SCHEMA, (11, "p", 1, d("10.00"))))
    source = str(tmp_path / "changes")
    for changes in ([_change(11, 1, d("11.50")), _change(11, 2, d("12.00"))], [_change(11, 3, d("12.50")), _change(5, 4, d("1.00"))]):
        frame(CHANGE_SCHEMA, *changes).coalesce(1).write.mode("append").json(source)
    query = feed.run(read_changes(spark, source, files_per_batch=1), str(tmp_path / "checkpoint"))
    query.awaitTermination(120)
    rows = sorted(as_dicts(feed.log()), key=lambda row: row["seq"])
    assert len({row["batch"] for row in rows}) == 2
    assert [(r["operation_type"], r["old_price"], r["new_price"]) for r in rows] == [
        ("UPDATE", d("10.00"), d("11.50")),
        ("UPDATE", d("11.50"), d("12.00")),
        ("UPDATE", d("12.00"), d("12.50")),
        ("INSERT", d("0.00"), d("1.00")),
    ]
    before = as_dicts(feed.log())
    feed.process(frame(CHANGE_SCHEMA, _change(11, 3, d("12.50")), _change(5, 4, d("1.00"))), 1)
    assert sorted(map(str, as_dicts(feed.log()))) == sorted(map(str, before))
    assert {key: row["unit_price"] for key, row in by(feed.products(2), "product_id").items()} == {11: d("12.50"), 5: d("1.00")}


def test_a_batch_writes_only_its_buckets(spark, frame, tmp_path):
    folder = str(tmp_path / "audit")
    feed = PriceFeed(spark, folder, "me", buckets=16)
    feed.start_from(spark.range(200).selectExpr("id as product_id", "'p' as product_name", "1 as category_id", "5.00 as unit_price"))
    first = set(glob.glob(f"{folder}/products/**/*.parquet", recursive=True))
    feed.process(frame(CHANGE_SCHEMA, _change(7, 1, d("6.00")), _change(7, 2, d("7.00")), _change(900, 3, d("1.00"))), 0)
    second = set(glob.glob(f"{folder}/products/**/*.parquet", recursive=True))
    assert first < second and len({path.split("key_bucket=")[1].split("/")[0] for path in second - first}) <= 2
    state = {key: row["unit_price"] for key, row in by(feed.products(1), "product_id").items()}
    assert state == {**{i: d("5.00") for i in range(200)}, 7: d("7.00"), 900: d("1.00")}
    assert by(feed.products(0), "product_id").keys() == set(range(200))


def test_buckets_that_lose_all_products(spark, frame, tmp_path):
    feed = PriceFeed(spark, str(tmp_path / "audit"), "me", buckets=4)
    feed.start_from(frame(SCHEMA, (11, "p", 1, d("10.00"))))
    feed.process(frame(CHANGE_SCHEMA, _change(11, 1, None, True)), 0)
    assert as_dicts(feed.products(1)) == []
    feed.process(frame(CHANGE_SCHEMA), 1)  # a batch without changes
    assert as_dicts(feed.products(2)) == []
    for _ in range(2):  # replayed
        feed.process(frame(CHANGE_SCHEMA, _change(11, 2, d("3.00")), _change(12, 3, d("4.00"))), 2)
    assert {key: row["unit_price"] for key, row in by(feed.products(3), "product_id").items()} == {11: d("3.00"), 12: d("4.00")}
    assert [r["operation_type"] for r in sorted(as_dicts(feed.log()), key=lambda r: r["seq"])] == ["DELETE", "INSERT", "INSERT"]


def test_no_products_at_first(spark, frame, tmp_path):
    feed = PriceFeed(spark, str(tmp_path / "audit"), "me", buckets=4)
    feed.start_from(frame(SCHEMA))
    feed.process(frame(CHANGE_SCHEMA, _change(1, 1, d("3.00"))), 0)
    assert by(feed.products(1), "product_id").keys() == {1}
