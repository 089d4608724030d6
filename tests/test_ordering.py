"""Distributed ranks against plain windows, on data with hot values and many runs."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tradeloom.operators.ordering import RUN, add_ntiles, add_ranks, add_row_number, sorted_runs


@pytest.fixture
def many_runs(spark):
    """Keep every shuffle partition, so that ties and groups cross runs."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


def _rows(seed, size):
    rng = random.Random(seed)
    return [(i, rng.choice([1, 1, 1, 1, 2, 3]), rng.choice([None, 0, 0, 0, 0, 1, 2, rng.randint(0, 50)])) for i in range(size)]


@pytest.mark.parametrize(("seed", "size"), [(1, 0), (2, 1), (3, 4), (4, 300), (5, 900)])
def test_equal_to_plain_windows(spark, frame, many_runs, seed, size):
    df = frame("k int, g int, v int", *_rows(seed, size))
    ranked = add_ranks(add_ranks(df, {"overall": "v"}, ["k"]), {"in_group": "v"}, ["k"], ["g"])
    actual = add_row_number(add_ntiles(ranked, {"tile": ["v", "k"]}, 5), "number", ["g", "v", "k"])
    expected = df.select(
        "*",
        F.rank().over(Window.orderBy(F.desc("v"))).alias("overall"),
        F.rank().over(Window.partitionBy("g").orderBy(F.desc("v"))).alias("in_group"),
        F.ntile(5).over(Window.orderBy("v", "k")).alias("tile"),
        F.row_number().over(Window.orderBy("g", "v", "k")).alias("number"),
    )
    assert sorted(map(str, actual.collect())) == sorted(map(str, expected.collect()))


def test_one_value_fills_every_run(frame, many_runs):
    df = frame("k int, v int", *[(i, 7) for i in range(500)], (500, 9), (501, 1))
    ranks = {row["k"]: row["r"] for row in add_ranks(df, {"r": "v"}, ["k"]).collect()}
    assert ranks[500] == 1
    assert {ranks[i] for i in range(500)} == {2}
    assert ranks[501] == 502


def test_hot_value_is_spread_over_runs(spark, frame, many_runs):
    df = frame("k int, v int", *[(i, 7) for i in range(800)])
    sizes = [row["count"] for row in sorted_runs(df, ["v", "k"]).groupBy(RUN).count().collect()]
    assert max(sizes) < 400


def test_ntile_with_fewer_rows_than_buckets(frame, many_runs):
    df = frame("k int", (1,), (2,), (3,))
    assert sorted((row["k"], row["t"]) for row in add_ntiles(df, {"t": ["k"]}, 5).collect()) == [(1, 1), (2, 2), (3, 3)]


def test_reports_agree_with_many_runs(spark):
    from tradeloom.plans.catalog import queries

    names = ["dw_top_products_monthly", "dw_rfm_segments", "mart_customer_ltv", "price_audit_listing"]
    few = [sorted(map(str, queries()[name](spark, "/root/testdata/sf0.001").collect())) for name in names]
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        many = [sorted(map(str, queries()[name](spark, "/root/testdata/sf0.001").collect())) for name in names]
    finally:
        spark.conf.set(setting, before)
    assert few == many
