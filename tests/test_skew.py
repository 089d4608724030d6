"""A third of all lines in one product and one order: joins must split them and keep every row."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tradeloom.functions.calendar import mart_calendar
from tradeloom.plans import mart

LINES = 60000
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
}


@pytest.fixture
def shuffled_joins(spark):
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture
def tables(spark):
    number = F.col("id")
    hot = number % 3 == 0
    details = spark.range(0, LINES, 1, 8).select(
        F.when(hot, 0).otherwise(number % 5000).alias("order_id"),
        F.when(hot, 0).otherwise(number % 700).alias("product_id"),
        # Values that do not compress, as the hot partition is found by its size in bytes.
        (F.abs(F.hash("id")) % 1000000).cast("decimal(10,2)").alias("unit_price"),
        F.lit(2).alias("quantity"),
        F.lit(0).cast("decimal(3,2)").alias("discount"),
    )
    orders = spark.range(5000).select(
        number.alias("order_id"), (number % 50).alias("customer_id"), F.lit(1).alias("employee_id"),
        F.date_add(F.lit(date(1997, 1, 1)), (number % 300).cast("int")).alias("order_date"), F.lit(1).alias("ship_via"), F.lit(1).cast("decimal(10,2)").alias("freight"),
    )
    products = spark.range(700).select(
        number.alias("product_id"), (number % 7).alias("category_id"), (number % 9).alias("supplier_id")
    )
    return details, orders, products


def test_hot_keys_are_split_and_kept(spark, tables, shuffled_joins):
    details, orders, products = tables
    dated = mart.dated_orders(orders, mart_calendar(spark))
    lines = mart.priced_lines(details, dated, products)
    assert lines.count() == LINES
    kept = lines.select("order_id", "product_id", "amount")
    assert kept.filter("product_id = 0 and order_id = 0").count() >= LINES // 3
    kept.collect()
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan


def test_facts_of_hot_keys_are_whole(spark, tables, shuffled_joins):
    details, orders, products = tables
    dated = mart.dated_orders(orders, mart_calendar(spark))
    lines = mart.priced_lines(details, dated, products)
    daily = mart.fact_product_sales(lines)
    totals = daily.agg(F.sum("quantity_sold").alias("units"), F.sum("total_sales").alias("sales")).first()
    expected = details.agg(F.sum("unit_price") * 2).first()[0]
    assert (totals["units"], totals["sales"]) == (2 * LINES, expected)
    customers = mart.fact_customer_sales(details, dated)
    assert customers.agg(F.sum("total_quantity")).first()[0] == 2 * LINES
    shares = mart.with_freight_share(dated, mart.line_counts(details))
    assert shares.count() == details.select("order_id").distinct().count()
