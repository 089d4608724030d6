"""The warehouse loaded once into a folder, and its reports read from there.

`load_warehouse` fills dimensions and fact; `StoredWarehouse` offers the same tables as `SalesWarehouse`,
so every report takes either. The fact lies by year: reports of a period name its years, and reports of
some days of the calendar have Spark prune the years at run time (dynamic partition pruning).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.functions.calendar import WAREHOUSE_DAYS
from tradeloom.plans.warehouse import SalesWarehouse
from tradeloom.sources.raw import file_bytes
from tradeloom.sources.sinks import read_table, write_table
from tradeloom.sources.staging import BROADCAST_SOURCE_BYTES
from tradeloom.sources.stored import LOAD, exists, load_fact, read_dimension, read_fact, save_dimension

SALES_KEY = "sales_id"
LOOKUPS, FEW_BUCKETS, BUCKETS = ("categories", "shippers"), 1, 8
DIMENSIONS = {
    "customers": "customer_id",
    "employees": "employee_id",
    "categories": "category_id",
    "shippers": "shipper_id",
    "suppliers": "supplier_id",
    "products": "product_id",
}


def load_warehouse(warehouse: SalesWarehouse, folder: str, run: str, period: tuple[date, date] | None = None) -> None:
    """Dimensions, unless they are there, and the fact rows of the period as one load."""
    if not exists(warehouse.staging.spark, f"{folder}/calendar"):
        for name, key in DIMENSIONS.items():
            save_dimension(getattr(warehouse, name), f"{folder}/{name}", [key], FEW_BUCKETS if name in LOOKUPS else BUCKETS)
        write_table(warehouse.calendar, f"{folder}/calendar")
    load_fact(warehouse.sales(period), f"{folder}/sales", run, SALES_KEY, "order_year")


class StoredWarehouse:
    """The tables of a loaded folder, with the sizes their files show."""

    def __init__(self, spark: SparkSession, folder: str, days: tuple[date, date] = WAREHOUSE_DAYS):
        self.spark, self.folder, self.days = spark, folder, days

    @cached_property
    def calendar(self) -> DataFrame:
        return F.broadcast(read_table(self.spark, f"{self.folder}/calendar"))

    def _dimension(self, name: str) -> DataFrame:
        df = read_dimension(self.spark, f"{self.folder}/{name}")
        return F.broadcast(df) if file_bytes(df) <= BROADCAST_SOURCE_BYTES else df

    def __getattr__(self, name: str) -> DataFrame:
        if name not in DIMENSIONS:
            raise AttributeError(name)
        df = self._dimension(name)
        setattr(self, name, df)
        return df

    @cached_property
    def _sales(self) -> DataFrame:
        return read_fact(self.spark, f"{self.folder}/sales").drop(LOAD)

    def sales(
        self, period: tuple[date, date] | None = None, days: DataFrame | None = None, about: Sequence[str] = ()
    ) -> DataFrame:
        """The stored fact; a period or some days of the calendar prune its years."""
        fact = self._sales
        if period is not None:
            first, last = period
            fact = fact.where(F.col("order_year").between(first.year, last.year))
            days = (self.calendar if days is None else days).where(F.col("date").between(F.lit(first), F.lit(last)))
        if days is not None:
            wanted = days.select("date_id", F.col("year").alias("order_year"))
            fact = fact.join(F.broadcast(wanted), ["date_id", "order_year"], "left_semi")
        if about:
            fact = fact.join(self.customers.select("customer_id", *about), "customer_id")
        return fact
