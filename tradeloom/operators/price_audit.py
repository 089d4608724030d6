"""Price audit: product changes as an append-only log, from two snapshots or from an ordered feed."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions.money import growth_percent, money_sum, ratio
from tradeloom.operators.ordering import ROW, RUN, add_row_number, checkpointed, sorted_runs

# Smallest logged change, compared attributes, operation names and JSON actions.
SMALLEST_CHANGE = Decimal("0.001")
ATTRIBUTES = ["product_name", "category_id", "unit_price"]
ACTIONS = {"INSERT": "initial_price_set", "UPDATE": "price_adjustment", "DELETE": "product_removal"}


def price_changes(before: DataFrame, after: DataFrame, user: str, at: datetime) -> DataFrame:
    """One row per inserted, repriced or removed product. Both snapshots are keyed by product_id."""
    old = before.select("product_id", F.struct(*ATTRIBUTES).alias("old"))
    new = after.select("product_id", F.struct(*ATTRIBUTES).alias("new"))
    return _logged(old.join(new, "product_id", "full_outer"), user, F.lit(at).cast("timestamp_ntz"))


def price_steps(before: DataFrame, changes: DataFrame, user: str) -> DataFrame:
    """One log row per priced change of an ordered feed, each against the state just before it.

    `changes` has product_id, seq (unique per product), the attributes, `removed` and `changed_at`. The
    feed is sorted into runs, so a product that changes very often is spread over many of them; only
    the last row of a run is handed to the next one.
    """
    state = F.when(~F.col("removed"), F.struct(*ATTRIBUTES))
    steps = changes.select("product_id", "seq", "changed_at", state.alias("new"))
    runs = checkpointed(sorted_runs(steps, ["product_id", "seq"]))
    last_rows = runs.groupBy(RUN).agg(F.max_by(F.struct("product_id", "new"), ROW).alias("_last"))
    # One row per run: the last row of the run before it.
    previous_run = F.lag("_last").over(Window.orderBy(RUN)).alias("_from_run")
    handed_on = last_rows.select(RUN, previous_run)
    in_run = Window.partitionBy(RUN).orderBy(ROW)
    known = before.select("product_id", F.struct(*ATTRIBUTES).alias("_stored"))
    chained = (
        runs.withColumn("_in_run", F.lag(F.struct("product_id", "new")).over(in_run))
        .join(F.broadcast(handed_on), RUN)
        .withColumn("_previous", F.coalesce("_in_run", "_from_run"))
        .join(known, "product_id", "left")
    )
    follows = F.coalesce(F.col("_previous.product_id") == F.col("product_id"), F.lit(False))
    old = F.when(follows, F.col("_previous.new")).otherwise(F.col("_stored"))
    pairs = chained.withColumn("old", old).filter(F.col("old").isNotNull() | F.col("new").isNotNull())
    return _logged(pairs.drop("_previous", "_stored"), user, F.col("changed_at"), "seq")


def latest_products(before: DataFrame, changes: DataFrame) -> DataFrame:
    """The snapshot after a feed: the last state per product, without the removed ones."""
    state = F.max_by(F.struct(*ATTRIBUTES, "removed"), "seq").alias("new")
    changed = changes.groupBy("product_id").agg(state)
    stored = before.select("product_id", F.struct(*ATTRIBUTES, F.lit(False).alias("removed")).alias("old"))
    merged = stored.join(changed, "product_id", "full_outer").select("product_id", F.coalesce("new", "old").alias("now"))
    return merged.filter("not now.removed").select("product_id", *[f"now.{name}" for name in ATTRIBUTES])


def _logged(pairs: DataFrame, user: str, stamp: Column, *extra: str) -> DataFrame:
    """Log rows of (product_id, old, new) pairs, where a missing side is an insert or a removal."""
    zero = F.lit(0).cast("decimal(10,2)")
    old_price = F.when(F.col("old").isNull(), zero).otherwise(F.coalesce("old.unit_price", zero))
    new_price = F.when(F.col("new").isNull(), zero).otherwise(F.coalesce("new.unit_price", zero))
    operation = (
        F.when(F.col("old").isNull(), "INSERT")
        .when(F.col("new").isNull(), "DELETE")
        .when(
            ~F.col("old.unit_price").eqNullSafe(F.col("new.unit_price"))
            & (F.abs(F.col("old_price") - F.col("new_price")) > F.lit(SMALLEST_CHANGE)),
            "UPDATE",
        )
    )
    changes = (
        pairs.withColumns({"old_price": old_price, "new_price": new_price})
        .withColumn("operation_type", operation)
        .filter(F.col("operation_type").isNotNull())
    )
    return changes.select(
        "product_id",
        F.coalesce("old.product_name", "new.product_name").alias("product_name"),
        F.when(F.col("old").isNull(), F.col("new.category_id")).otherwise(F.col("old.category_id")).alias("category_id"),
        "old_price",
        "new_price",
        (F.col("new_price") - F.col("old_price")).alias("price_change"),
        F.when(F.col("old_price") > 0, growth_percent(F.col("new_price"), F.col("old_price")))
        .cast("decimal(12,2)")
        .alias("change_percentage"),
        "operation_type",
        F.lit(user).alias("updated_by"),
        stamp.alias("updated_at"),
        _context(user, stamp).alias("session_info"),
        *extra,
    )


def _context(user: str, stamp: Column) -> Column:
    """JSON context of a change; null fields are kept."""
    keep_nulls = {"ignoreNullFields": "false"}
    session_user = F.lit(user).alias("session_user")

    def action(operation: str) -> Column:
        return F.lit(ACTIONS[operation]).alias("action")

    difference = (F.col("new.unit_price") - F.col("old.unit_price")).alias("price_difference")
    at = F.date_format(stamp, "yyyy-MM-dd HH:mm:ss").alias("current_time")
    return (
        F.when(F.col("operation_type") == "INSERT", F.to_json(F.struct(action("INSERT"), session_user, at), keep_nulls))
        .when(
            F.col("operation_type") == "UPDATE",
            F.to_json(F.struct(action("UPDATE"), difference, session_user), keep_nulls),
        )
        .otherwise(F.to_json(F.struct(action("DELETE"), session_user), keep_nulls))
    )


def with_log_id(log: DataFrame, after: int = 0) -> DataFrame:
    """Number new log rows from `after` + 1 in product order, in parallel."""
    numbered = add_row_number(log, "log_id", ["product_id", "operation_type"])
    return numbered.withColumn("log_id", F.col("log_id") + after).select("log_id", *log.columns)


def audit_listing(log: DataFrame, product_id: int | None = None) -> DataFrame:
    """The log for reading, newest first; optionally one product."""
    if product_id is not None:
        log = log.filter(F.col("product_id") == product_id)
    return log.select(
        "log_id",
        "product_id",
        "product_name",
        "old_price",
        "new_price",
        "price_change",
        F.concat(F.col("change_percentage").cast("string"), F.lit("%")).alias("change_pct"),
        "operation_type",
        "updated_by",
        F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss").alias("updated_time"),
        F.get_json_object("session_info", "$.action").alias("audit_action"),
    ).orderBy(F.desc("log_id"))


def change_summary(log: DataFrame, product_id: int | None = None) -> DataFrame:
    """Per product: number of changes, price range, total and average change, first and last day."""
    if product_id is not None:
        log = log.filter(F.col("product_id") == product_id)
    grouped = log.groupBy("product_id", "product_name").agg(
        F.count("*").alias("change_count"),
        F.min("old_price").alias("min_old_price"),
        F.max("new_price").alias("max_new_price"),
        money_sum("price_change").alias("total_change"),
        F.sum("change_percentage").alias("percent_sum"),
        F.count("change_percentage").alias("percent_count"),
        F.date_format(F.min("updated_at"), "yyyy-MM-dd").alias("first_change"),
        F.date_format(F.max("updated_at"), "yyyy-MM-dd").alias("last_change"),
    )
    average = ratio(F.col("percent_sum"), F.col("percent_count")).alias("avg_change_pct")
    return grouped.select(
        "product_id", "product_name", "change_count", "min_old_price", "max_new_price",
        "total_change", average, "first_change", "last_change",
    )
