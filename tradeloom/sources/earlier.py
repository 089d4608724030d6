"""Mart dimensions as an earlier load left them, for the upsert and version jobs.

Each is derived from the staging tables: some keys were not known yet, stored attributes were
different, and columns that an upsert must not touch carry values of their own.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.plans.mart import first_load
from tradeloom.sources.staging import Staging

EARLIER_LOAD = date(1996, 1, 1)


class EarlierMart:
    def __init__(self, staging: Staging):
        self.staging = staging

    def _known(self, kind: str, staged: DataFrame, **stored) -> DataFrame:
        return first_load(kind, staged, EARLIER_LOAD).withColumns(stored)

    @cached_property
    def suppliers(self) -> DataFrame:
        """Suppliers with a balance, listed under an old city, country and phone."""
        funded = self.staging.raw("supplier").filter(F.col("s_acctbal") >= 0).select(F.col("s_suppkey").alias("supplier_id"))
        known = self.staging.suppliers.join(funded, "supplier_id", "left_semi")
        return self._known("supplier", known, city=F.lit("Old Town"), country=F.lit("Elsewhere"), phone=F.lit("000"))

    @cached_property
    def categories(self) -> DataFrame:
        known = self.staging.categories.filter(F.col("category_name") < "S")
        return self._known("category", known, description=F.lit("first catalogue"))

    @cached_property
    def products(self) -> DataFrame:
        """Small pack sizes, cheaper and out of stock, with another reorder level."""
        small = self.staging.raw("part").filter(F.col("p_size") <= 40).select(F.col("p_partkey").alias("product_id"))
        known = self.staging.products.join(small, "product_id", "left_semi")
        return self._known(
            "product",
            known,
            unit_price=(F.col("unit_price") - 1).cast("decimal(10,2)"),
            units_in_stock=F.lit(0),
            reorder_level=F.lit(5),
        )

    @cached_property
    def customers(self) -> DataFrame:
        """Customers with a balance, under an old name and phone and a segment of their own."""
        funded = self.staging.raw("customer").filter(F.col("c_acctbal") >= 0).select(F.col("c_custkey").alias("customer_id"))
        known = self.staging.customers.join(funded, "customer_id", "left_semi")
        return self._known(
            "customer",
            known,
            company_name=F.concat(F.lit("Old "), F.col("company_name")),
            phone=F.lit("000"),
            customer_segment=F.lit("Preferred"),
        )

    @cached_property
    def employees(self) -> DataFrame:
        """Employees with a title, under an old last name and home phone."""
        known = self.staging.employees.filter(F.col("title").isNotNull())
        return self._known(
            "employee",
            known,
            last_name=F.lit("Former"),
            full_name=F.concat("first_name", F.lit(" Former")),
            home_phone=F.lit("000"),
        )

    @cached_property
    def shippers(self) -> DataFrame:
        known = self.staging.shippers.filter(F.col("company_name") != "MEDIUM")
        return self._known("shipper", known, phone=F.lit("000"), is_active=F.lit(False))
