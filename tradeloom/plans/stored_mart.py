"""The data mart's facts in a folder, filled load by load, and its reports read from there.

A load brings whole orders. Its order lines get keys that go on where the other loads end; its sums per
product and day and per customer and day are added to the kept ones, of which only the periods that the
load touches are rewritten. A large load goes in slices of whole orders, so that what Spark shuffles for it
lies on disk one slice at a time; every slice reads the source files again. `StoredMart` is a `DataMart` whose sales facts come from the folder, so
every report takes either.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property, partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.functions.calendar import MART_DAYS
from tradeloom.plans.mart import (
    CUSTOMER_DAY,
    PRODUCT_DAY,
    DataMart,
    customer_day_parts,
    customer_sales_of,
    merged_parts,
    product_day_parts,
    product_sales_of,
    supplier_purchases_of,
)
from tradeloom.sources.staging import Staging
from tradeloom.sources.stored import LOAD, load_fact, merge_parts, read_fact, read_kept

SALES_KEY = "fact_sales_id"
PERIOD = "period"
SLICE_BYTES = 1024 * 1024 * 1024  # of the source files of orders and lines
UNITS = ("month", "day")  # what a load rewrites as a whole: months, or days where one day is large


class StoredMart(DataMart):
    """Facts in a folder. The unit of its periods, "month" or "day", stays the same for all loads."""

    def __init__(
        self, staging: Staging, as_of: date, folder: str, days: tuple[date, date] = MART_DAYS, unit: str = "month"
    ):
        super().__init__(staging, as_of, days)
        if unit not in UNITS:
            raise ValueError(f"no such unit of periods: {unit}")
        self.spark, self.folder, self.unit = staging.spark, folder, unit

    def _by_period(self, df: DataFrame) -> DataFrame:
        month = (F.col("year") * 100 + F.col("month")).cast("int")
        period = month if self.unit == "month" else F.col("date_id")
        return df.join(F.broadcast(self.calendar.select("date_id", period.alias(PERIOD))), "date_id")

    def load(self, load: DataMart, run: str) -> dict[str, list[int]]:
        """Store the facts of a load; the same run again replaces what it stored. Returns the periods
        that were rewritten."""
        slices = load.slices(SLICE_BYTES)
        load_fact([self._by_period(part.sales) for part in slices], f"{self.folder}/sales", run, SALES_KEY, PERIOD)
        touched = {}
        for name, grain, parts in (
            ("product_days", PRODUCT_DAY, [product_day_parts(part.lines) for part in slices]),
            (
                "customer_days",
                [*CUSTOMER_DAY, "order_date"],
                [customer_day_parts(part.order_details, part.dated_orders) for part in slices],
            ),
        ):
            merge = partial(merged_parts, grain=[*grain, PERIOD])
            by_period = [self._by_period(part) for part in parts]
            touched[name] = merge_parts(by_period, f"{self.folder}/{name}", run, PERIOD, merge, grain)
        return touched

    def _kept(self, name: str, parts: DataFrame) -> DataFrame:
        """Kept sums; `parts`, which is not run, states their columns."""
        schema = T.StructType([*parts.schema.fields, T.StructField(PERIOD, T.IntegerType())])
        return read_kept(self.spark, f"{self.folder}/{name}", schema).drop(PERIOD)

    @cached_property
    def product_days(self) -> DataFrame:
        return self._kept("product_days", product_day_parts(self.lines))

    @cached_property
    def customer_days(self) -> DataFrame:
        return self._kept("customer_days", customer_day_parts(self.staging.order_details, self.dated_orders))

    @cached_property
    def stored_sales(self) -> DataFrame:
        """The stored fact with its key, the load and the period of each row."""
        return read_fact(self.spark, f"{self.folder}/sales")

    @cached_property
    def sales(self) -> DataFrame:
        return self.stored_sales.drop(LOAD, PERIOD, SALES_KEY)

    @cached_property
    def named_sales(self) -> DataFrame:
        return self.sales.join(self._named_products.select("product_id", "supplier", "category_name"), "product_id")

    @cached_property
    def supplier_purchases(self) -> DataFrame:
        return supplier_purchases_of(self.product_days)

    @cached_property
    def product_sales(self) -> DataFrame:
        return product_sales_of(self.product_days)

    @cached_property
    def customer_sales(self) -> DataFrame:
        return customer_sales_of(self.customer_days)
