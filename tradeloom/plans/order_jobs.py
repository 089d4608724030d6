"""Order totals and order batches, computed for all orders at once."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.money import grand_total, line_amount, money_sum, ratio
from tradeloom.operators.upsert import upsert

# Periods and sizes of the two batches, status of a processed order.
BATCH_PERIOD = (date(1997, 1, 1), date(1997, 12, 31))
BATCH_SIZE = 15
BULK_PERIOD = (date(1997, 1, 1), date(1997, 3, 31))
BULK_SIZE = 20
TOP_SPENDERS = 10
PROCESSED = "PROCESSED"

ANALYTICS_COLUMNS = [
    "order_id", "customer_id", "order_date", "total_amount", "item_count", "avg_item_value",
    "processing_timestamp", "processing_batch_id", "status",
]


def rounded_line() -> Column:
    """Line value rounded to cents before it is summed; a missing discount is none."""
    discount = F.coalesce("discount", F.lit(0).cast("decimal(3,2)"))
    return line_amount(F.col("quantity"), F.col("unit_price"), discount).cast("decimal(12,2)")


def _lines_of(order_details: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines of the picked orders only, so that no other line is summed. Spark broadcasts few orders."""
    return order_details.join(orders.select("order_id"), "order_id", "left_semi")


def _line_sums(order_details: DataFrame) -> DataFrame:
    return order_details.groupBy("order_id").agg(
        money_sum(rounded_line()).cast("decimal(12,2)").alias("line_sum"), F.count("product_id").alias("items")
    )


def order_totals(requested: DataFrame, orders: DataFrame, order_details: DataFrame) -> DataFrame:
    """Total of every requested order id; zero for an unknown order or one without lines."""
    zero = F.lit(0).cast("decimal(12,2)")
    known = orders.select("order_id", F.lit(True).alias("known")).join(_line_sums(order_details), "order_id", "left")
    return requested.select("order_id").join(known, "order_id", "left").select(
        "order_id",
        F.coalesce("line_sum", zero).alias("order_total"),
        F.coalesce("known", F.lit(False)).alias("order_exists"),
    )


def order_total_check(
    orders: DataFrame,
    customers: DataFrame,
    order_details: DataFrame,
    ids: tuple[int, int] | None = None,
) -> DataFrame:
    """Totals with the customer's name; orders without value are marked for a check."""
    if ids is not None:
        orders = orders.filter(F.col("order_id").between(*ids))
        order_details = order_details.filter(F.col("order_id").between(*ids))
    total = F.coalesce("line_sum", F.lit(0).cast("decimal(12,2)"))
    return (
        orders.join(customers.select("customer_id", "company_name"), "customer_id")
        .join(_line_sums(order_details), "order_id", "left")
        .select(
            "order_id",
            "order_date",
            "company_name",
            total.alias("order_total"),
            F.when(total > 0, "VALID").otherwise("CHECK").alias("validation"),
        )
        .orderBy(F.desc("order_total"), "order_id")
    )


def order_batch(
    orders: DataFrame,
    customers: DataFrame,
    order_details: DataFrame,
    batch_id: str,
    at: datetime,
    period: tuple[date, date] = BATCH_PERIOD,
    limit: int | None = None,
) -> DataFrame:
    """Analytics rows for a period's orders; with a limit, the newest and then fullest ones."""
    picked = orders.filter(F.col("order_date").between(*period)).join(
        customers.select("customer_id"), "customer_id", "left_semi"
    )
    batch = (
        picked.join(_line_sums(_lines_of(order_details, picked)), "order_id", "left")
        .withColumn("item_count", F.coalesce("items", F.lit(0)).cast("int"))
        .withColumn("total_amount", F.coalesce("line_sum", F.lit(0).cast("decimal(12,2)")))
    )
    if limit is not None:
        batch = batch.orderBy(F.desc("order_date"), F.desc("item_count"), "order_id").limit(limit)
    return _analytics(batch, batch_id, at)


def order_bulk(
    orders: DataFrame,
    order_details: DataFrame,
    batch_id: str,
    at: datetime,
    period: tuple[date, date] = BULK_PERIOD,
    limit: int | None = None,
    stored: DataFrame | None = None,
) -> DataFrame:
    """Analytics rows without item counts; with a limit, the earliest orders.

    Rows already stored for the order and batch keep their values and only get the new timestamp.
    """
    picked = orders.filter(F.col("order_date").between(*period))
    if limit is not None:
        picked = picked.orderBy("order_date", "order_id").limit(limit)
    totals = picked.join(_line_sums(_lines_of(order_details, picked)), "order_id", "left").withColumn(
        "total_amount", F.coalesce("line_sum", F.lit(0).cast("decimal(12,2)"))
    )
    fresh = _analytics(totals.withColumn("item_count", F.lit(None).cast("int")), batch_id, at)
    if stored is None:
        return fresh
    return upsert(stored, fresh, ["order_id", "processing_batch_id"], ["processing_timestamp"])


def _analytics(rows: DataFrame, batch_id: str, at: datetime) -> DataFrame:
    return rows.select(
        "order_id",
        "customer_id",
        "order_date",
        "total_amount",
        "item_count",
        F.lit(None).cast("decimal(10,2)").alias("avg_item_value"),
        F.lit(at).cast("timestamp_ntz").alias("processing_timestamp"),
        F.lit(batch_id).alias("processing_batch_id"),
        F.lit(PROCESSED).alias("status"),
    )


def batch_summary(analytics: DataFrame) -> DataFrame:
    """Per batch: size, first and last processing time, sum, average, largest and smallest order."""
    at = F.col("processing_timestamp")
    return (
        analytics.groupBy(F.col("processing_batch_id").alias("batch_id"))
        .agg(
            F.count("*").alias("orders_processed"),
            F.date_format(F.min(at), "yyyy-MM-dd HH:mm:ss").alias("started_at"),
            F.date_format(F.max(at), "yyyy-MM-dd HH:mm:ss").alias("completed_at"),
            money_sum("total_amount").alias("total_volume"),
            ratio(money_sum("total_amount"), F.count("total_amount")).alias("avg_order_value"),
            F.max("total_amount").alias("largest_order"),
            F.min("total_amount").alias("smallest_order"),
        )
        .orderBy(F.desc("started_at"))
    )


def batch_progress(analytics: DataFrame) -> DataFrame:
    """One row for a finished batch: records, total and average order."""
    return analytics.agg(
        F.count("*").alias("records_processed"),
        grand_total("total_amount").alias("total_amount"),
        ratio(grand_total("total_amount"), F.count("*")).alias("average_order"),
    )


def customer_summary(analytics: DataFrame, limit: int = TOP_SPENDERS) -> DataFrame:
    """The customers who spent most over all processed batches."""
    return (
        analytics.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.count("*").alias("order_count"),
            grand_total("total_amount").alias("total_spent"),
            ratio(grand_total("total_amount"), F.count("total_amount")).alias("avg_order_value"),
            ratio(grand_total("total_amount"), F.count("*")).alias("customer_lifetime_value"),
        )
        .orderBy(F.desc("total_spent"), "customer_id")
        .limit(limit)
    )


def overall(analytics: DataFrame) -> DataFrame:
    at = F.col("processing_timestamp")
    return analytics.agg(
        F.count("*").alias("total_records_processed"),
        F.date_format(F.min(at), "yyyy-MM-dd").alias("first_processing_date"),
        F.date_format(F.max(at), "yyyy-MM-dd").alias("last_processing_date"),
        grand_total("total_amount").alias("total_processed_value"),
    )
