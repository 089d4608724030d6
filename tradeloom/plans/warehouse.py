"""The sales warehouse: staging counts, dimensions and the order-line fact.

Functions take and return DataFrames. `SalesWarehouse` wires them over one staging area, lazily, so a
report only runs what it needs. The calendar is always broadcast: its size is fixed by the date range.
Customers, products and suppliers grow with the company, so they are broadcast only while their
source files are small (`Staging.sized`); beyond that joins shuffle and split hot keys at run time.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.calendar import WAREHOUSE_DAYS, warehouse_calendar
from tradeloom.functions.money import AMOUNT, line_amount, rate
from tradeloom.sources.staging import Staging

# Placeholder of a missing name, tax rate.
UNKNOWN = "Unknown"
TAX_RATE = "0.1"


def _or_unknown(name: str) -> Column:
    return F.coalesce(name, F.lit(UNKNOWN)).alias(name)


def row_counts(tables: dict[str, DataFrame], label: str = "table_name") -> DataFrame:
    """One labelled row count per table."""
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias(label), "row_count") for name, df in tables.items()]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result


def dim_customer(customers: DataFrame) -> DataFrame:
    return customers.filter(F.col("customer_id").isNotNull()).select(
        "customer_id", _or_unknown("company_name"), "contact_name", "contact_title", "address",
        _or_unknown("city"), "region", "postal_code", _or_unknown("country"), "phone",
    )


def dim_employee(employees: DataFrame) -> DataFrame:
    return employees.filter(F.col("employee_id").isNotNull()).select(
        "employee_id", _or_unknown("last_name"), _or_unknown("first_name"), "title", "birth_date", "hire_date",
        "address", "city", "region", "postal_code", "country", "home_phone", "extension",
    )


def dim_category(categories: DataFrame) -> DataFrame:
    return categories.filter(F.col("category_id").isNotNull()).select(
        "category_id", _or_unknown("category_name"), "description"
    )


def dim_shipper(shippers: DataFrame) -> DataFrame:
    return shippers.filter(F.col("shipper_id").isNotNull()).select("shipper_id", _or_unknown("company_name"), "phone")


def dim_supplier(suppliers: DataFrame) -> DataFrame:
    return suppliers.filter(F.col("supplier_id").isNotNull()).select(
        "supplier_id", _or_unknown("company_name"), "contact_name", "contact_title", "address",
        _or_unknown("city"), "region", "postal_code", _or_unknown("country"), "phone",
    )


def dim_product(products: DataFrame, suppliers: DataFrame, categories: DataFrame) -> DataFrame:
    """Products whose supplier and category are both known; a null reference drops the product."""
    return (
        products.filter(F.col("product_id").isNotNull())
        .join(suppliers.select("supplier_id"), "supplier_id", "left_semi")
        .join(categories.select("category_id"), "category_id", "left_semi")
        .select(
            "product_id",
            _or_unknown("product_name"),
            "supplier_id",
            "category_id",
            "quantity_per_unit",
            F.coalesce("unit_price", F.lit(0).cast("decimal(10,2)")).alias("unit_price"),
            F.coalesce("units_in_stock", F.lit(0)).alias("units_in_stock"),
            F.coalesce("discontinued", F.lit(False)).alias("discontinued"),
        )
    )


def dated_orders(orders: DataFrame, customers: DataFrame, calendar: DataFrame, about: Sequence[str] = ()) -> DataFrame:
    """Orders of known customers on a calendar day, with the day's id and year, and columns `about` the
    customer: looked up per order, they cost the lines no shuffle."""
    days = F.broadcast(calendar.select(F.col("date").alias("order_date"), "date_id", F.col("year").alias("order_year")))
    return (
        orders.join(days, "order_date")
        .join(customers.select("customer_id", *about), "customer_id", "inner" if about else "left_semi")
        .select("order_id", "date_id", "order_year", "customer_id", "employee_id", F.col("ship_via").alias("shipper_id"), *about)
    )


def fact_sales(
    order_details: DataFrame,
    dated: DataFrame,
    products: DataFrame,
    tax_rate: str = TAX_RATE,
    about: Sequence[str] = (),
) -> DataFrame:
    """One row per valid order line of a known product and a dated order.

    `products` is the dimension. Everything about an order is joined to it beforehand, so lines are
    shuffled at most twice: by product and by order. `order_year` is carried as the partition column
    of the stored fact.
    """
    discount = F.coalesce("discount", F.lit(0).cast("decimal(3,2)"))
    lines = order_details.withColumn("discount", discount).filter(
        (F.col("quantity") > 0) & (F.col("unit_price") >= 0) & F.col("discount").between(0, 1)
    )
    amount = line_amount(F.col("quantity"), F.col("unit_price"), F.col("discount"))
    return (
        lines.join(products.select("product_id", "category_id", "supplier_id"), "product_id")
        .join(dated, "order_id")
        .select(
            "date_id",
            "customer_id",
            "product_id",
            "employee_id",
            "category_id",
            "shipper_id",
            "supplier_id",
            F.col("quantity").alias("quantity_sold"),
            "unit_price",
            "discount",
            amount.cast(AMOUNT).alias("total_amount"),
            (amount * rate(tax_rate)).cast(AMOUNT).alias("tax_amount"),
            "order_year",
            *about,
        )
    )


class SalesWarehouse:
    """Dimensions and fact over one staging area; nothing runs until a report is collected."""

    def __init__(self, staging: Staging, days: tuple[date, date] = WAREHOUSE_DAYS):
        self.staging = staging
        self.days = days

    @cached_property
    def calendar(self) -> DataFrame:
        return warehouse_calendar(self.staging.spark, self.days)

    @cached_property
    def customers(self) -> DataFrame:
        return self.staging.sized(dim_customer(self.staging.customers), "customer", "nation")

    @cached_property
    def employees(self) -> DataFrame:
        return self.staging.lookup(dim_employee(self.staging.employees), "employees")

    @cached_property
    def categories(self) -> DataFrame:
        return self.staging.lookup(dim_category(self.staging.categories), "categories")

    @cached_property
    def shippers(self) -> DataFrame:
        return self.staging.lookup(dim_shipper(self.staging.shippers), "shippers")

    @cached_property
    def suppliers(self) -> DataFrame:
        return self.staging.sized(dim_supplier(self.staging.suppliers), "supplier", "nation")

    @cached_property
    def products(self) -> DataFrame:
        products = dim_product(self.staging.products, self.suppliers, self.categories)
        return self.staging.sized(products, "part", "supplier")

    def sales(
        self, period: tuple[date, date] | None = None, days: DataFrame | None = None, about: Sequence[str] = ()
    ) -> DataFrame:
        """The fact. The period, by default the calendar's, also prunes the scan of the orders; `days` are
        the calendar's days that count, so that no line of another day is joined; `about` are columns
        of the customer."""
        orders = self.staging.orders_between(period or self.days)
        dated = dated_orders(orders, self.customers, self.calendar if days is None else days, about)
        return fact_sales(self.staging.order_details, self.staging.sized(dated, "orders"), self.products, about=about)

    def staging_tables(self) -> dict[str, DataFrame]:
        names = ["customers", "employees", "categories", "suppliers", "shippers", "products", "orders", "order_details"]
        return {f"staging_{name}": getattr(self.staging, name) for name in names}


def calendar_load(calendar: DataFrame, orders: DataFrame) -> DataFrame:
    """The calendar with the number of staged orders on each day, to see how it covers the orders."""
    per_day = orders.groupBy(F.col("order_date").alias("date")).agg(F.count("*").alias("order_count"))
    return calendar.join(per_day, "date", "left").withColumn("order_count", F.coalesce("order_count", F.lit(0)))
