"""Ordered stock movements with a floor at zero, as a scan over sorted runs.

One move maps a stock level s to max(0, s + q). After i moves the level is
`level_i - least(0, min(level_1..level_i))`, where level_i is the opening stock plus the plain running
sum. Sums and minima of runs combine, so a product whose moves fill many partitions is scanned run by
run and only one row per product and run crosses between them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.operators.ordering import ROW, RUN, checkpointed, sorted_runs

# Names of the two operations.
ADDITION = "STOCK_ADDITION"
REDUCTION = "STOCK_REDUCTION"


def rejected_moves(moves: DataFrame, products: DataFrame) -> DataFrame:
    """Moves that cannot be applied, with the reason. Zero moves are ignored, not rejected."""
    known = products.select("product_id", F.lit(True).alias("_known"))
    checked = moves.filter(F.col("quantity").isNull() | (F.col("quantity") != 0)).join(known, "product_id", "left")
    reason = F.when(F.col("_known").isNull(), "product not found").when(F.col("quantity").isNull(), "quantity is null")
    return checked.select("product_id", "seq", reason.alias("reason")).filter(F.col("reason").isNotNull())


def apply_moves(moves: DataFrame, products: DataFrame) -> DataFrame:
    """Stock before and after every valid move, in `seq` order per product.

    `moves` has product_id, seq (unique per product) and quantity; `products` has product_id and
    units_in_stock. With an unknown opening stock the first move sets the level to zero.
    """
    valid = moves.filter(F.col("quantity").isNotNull() & (F.col("quantity") != 0)).select("product_id", "seq", "quantity")
    opening = products.join(valid.groupBy("product_id").agg(F.min("seq").alias("_first_seq")), "product_id").select(
        "product_id", F.col("units_in_stock").cast("bigint").alias("_opening"), "_first_seq"
    )
    sets_zero = F.col("_opening").isNull() & (F.col("seq") == F.col("_first_seq"))
    prepared = valid.join(opening, "product_id").withColumn(
        "_step", F.when(sets_zero, F.lit(0)).otherwise(F.col("quantity")).cast("bigint")
    )

    runs = checkpointed(sorted_runs(prepared, ["product_id", "seq"]))
    in_run = Window.partitionBy(RUN, "product_id").orderBy(ROW).rowsBetween(Window.unboundedPreceding, 0)
    scanned = runs.withColumn("_sum", F.sum("_step").over(in_run)).withColumn("_low", F.min("_sum").over(in_run))

    earlier = Window.partitionBy("product_id").orderBy(RUN).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        scanned.groupBy(RUN, "product_id")
        .agg(F.sum("_step").alias("_run_sum"), F.min("_low").alias("_run_low"))
        .withColumn("_base", F.coalesce(F.sum("_run_sum").over(earlier), F.lit(0)))
        .withColumn("_base_low", F.min(F.col("_base") + F.col("_run_low")).over(earlier))
        .select(RUN, "product_id", "_base", "_base_low")
    )

    start = F.coalesce("_opening", F.lit(0))
    level = start + F.col("_base") + F.col("_sum")
    lowest = start + F.least(F.col("_base") + F.col("_low"), F.col("_base_low"))
    after = level - F.least(F.lit(0), lowest)
    # The level before a move is the level after the previous one: the same formula, one step back.
    previous_sum = F.col("_sum") - F.col("_step")
    previous_low = F.least(F.col("_base") + F.col("_previous_low"), F.col("_base_low"))
    before = start + F.col("_base") + previous_sum - F.least(F.lit(0), start + previous_low)
    in_order = Window.partitionBy(RUN, "product_id").orderBy(ROW)
    return (
        scanned.withColumn("_previous_low", F.lag("_low").over(in_order))
        .join(carried, [RUN, "product_id"])
        .select(
            "product_id",
            "seq",
            F.when(F.col("seq") == F.col("_first_seq"), F.col("_opening")).otherwise(before).alias("stock_before"),
            "quantity",
            after.alias("stock_after"),
            F.when(F.col("quantity") > 0, ADDITION).otherwise(REDUCTION).alias("operation"),
        )
    )


def stock_status(products: DataFrame) -> DataFrame:
    """Closing stock report: reorder flag and stock value."""
    return products.select(
        "product_id",
        "product_name",
        F.col("units_in_stock").alias("final_stock"),
        "reorder_level",
        F.when(F.col("units_in_stock") <= F.col("reorder_level"), "REORDER NEEDED").otherwise("STOCK OK").alias("stock_status"),
        "unit_price",
        (F.col("units_in_stock") * F.col("unit_price")).cast("decimal(15,2)").alias("stock_value"),
    )
