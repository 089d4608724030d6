"""The data mart: upserted dimensions, versioned products and five facts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions.calendar import MART_DAYS, OPEN_END, mart_calendar
from tradeloom.functions.money import AMOUNT, average, exact_sum, line_amount, money_sum, rate, whole_ratio
from tradeloom.operators.upsert import upsert
from tradeloom.plans.warehouse import TAX_RATE
from tradeloom.sources.staging import Staging

# What an upsert overwrites per dimension, the default segment, the product attributes
# that open a new version.
UPDATED = {
    "supplier": ["company_name", "contact_name", "contact_title", "address", "city"],
    "category": ["category_name", "description"],
    "product": ["product_name", "unit_price", "units_in_stock"],
    "customer": ["company_name", "contact_name", "city", "country"],
    "employee": ["last_name", "first_name", "title"],
    "shipper": ["company_name", "phone"],
}
DEFAULT_SEGMENT = "Standard"
TRACKED_PRODUCT_COLUMNS = [
    "product_name", "supplier_id", "category_id", "quantity_per_unit", "unit_price",
    "units_in_stock", "units_on_order", "reorder_level", "discontinued",
]

CONTACT = ["company_name", "contact_name", "contact_title", "address", "city", "region", "postal_code", "country", "phone", "fax"]
COLUMNS = {
    "supplier": ["supplier_id", *CONTACT, "is_active"],
    "category": ["category_id", "category_name", "description"],
    "product": ["product_id", *TRACKED_PRODUCT_COLUMNS, "is_current"],
    "customer": ["customer_id", *CONTACT, "customer_segment", "is_active"],
    "employee": [
        "employee_id", "last_name", "first_name", "full_name", "title", "title_of_courtesy", "birth_date", "hire_date",
        "address", "city", "region", "postal_code", "country", "home_phone", "reports_to", "is_active",
    ],
    "shipper": ["shipper_id", "company_name", "phone", "is_active"],
}


def full_name() -> Column:
    return F.concat("first_name", F.lit(" "), "last_name")


def _defaults(as_of: date) -> dict[str, Column]:
    return {
        "is_active": F.lit(True),
        "is_current": F.lit(True),
        "customer_segment": F.lit(DEFAULT_SEGMENT),
        "valid_from": F.lit(as_of),
        "valid_to": F.lit(OPEN_END),
    }


def first_load(kind: str, staged: DataFrame, as_of: date) -> DataFrame:
    """A dimension loaded into an empty mart: staged rows plus the declared defaults."""
    defaults = _defaults(as_of)
    if kind == "employee":
        defaults["full_name"] = full_name()
    columns = [*COLUMNS[kind], "valid_from", "valid_to"]
    return staged.select(*[F.col(c) if c in staged.columns else defaults[c].alias(c) for c in columns])


def upsert_dimension(kind: str, stored: DataFrame, staged: DataFrame, as_of: date) -> DataFrame:
    """Merge staged rows into a stored dimension, overwriting only the columns listed for it."""
    key = f"{kind}_id"
    generated = {"full_name": full_name()} if kind == "employee" else None
    wanted = [name for name in stored.columns if name in staged.columns]
    return upsert(stored, staged.select(*wanted), [key], UPDATED[kind], _defaults(as_of), generated)


def dated_orders(orders: DataFrame, calendar: DataFrame) -> DataFrame:
    days = F.broadcast(calendar.select(F.col("date").alias("order_date"), "date_id"))
    return orders.join(days, "order_date")


def priced_lines(order_details: DataFrame, dated: DataFrame, products: DataFrame, about: Sequence[str] = ()) -> DataFrame:
    """Order lines with their product's category and supplier, their order and its calendar day, and
    columns `about` the product."""
    amount = line_amount(F.col("quantity"), F.col("unit_price"), F.col("discount"))
    return (
        order_details.withColumn("amount", amount)
        .join(products.select("product_id", "category_id", "supplier_id", *about), "product_id")
        .join(dated, "order_id")
    )


def line_counts(order_details: DataFrame) -> DataFrame:
    return order_details.groupBy("order_id").agg(F.count("*").alias("line_count"))


def with_freight_share(dated: DataFrame, counts: DataFrame) -> DataFrame:
    """Orders with the freight of one line. Worked out per order, so lines need no second pass."""
    share = average(F.col("freight"), F.col("line_count")).cast("decimal(10,2)")
    return dated.join(counts, "order_id").select(*dated.columns, share.alias("freight_cost"))


def fact_sales(counted_lines: DataFrame, tax_rate: str = TAX_RATE, about: Sequence[str] = ()) -> DataFrame:
    """Every order line with tax and its share of the order's freight, before the row checks.

    `counted_lines` are priced lines whose orders went through `with_freight_share`.
    """
    amount = F.col("amount")
    return counted_lines.select(
        "date_id",
        "customer_id",
        "product_id",
        "employee_id",
        "category_id",
        F.col("ship_via").alias("shipper_id"),
        "supplier_id",
        "order_id",
        F.col("quantity").alias("quantity_sold"),
        "unit_price",
        "discount",
        amount.cast(AMOUNT).alias("line_total"),
        (amount * rate(tax_rate)).cast(AMOUNT).alias("tax_amount"),
        "freight_cost",
        *about,
    )


SALES_KEYS = ["date_id", "customer_id", "product_id", "employee_id", "category_id", "shipper_id", "supplier_id", "order_id"]
SALES_MEASURES = ["quantity_sold", "unit_price", "discount", "line_total", "tax_amount", "freight_cost"]
# The declared checks, as SQL conditions. Line total and tax follow from the factors.
SALES_CHECKS = {
    "quantity_sold is positive": "quantity_sold > 0",
    "unit_price is not negative": "unit_price >= 0",
    "discount is in 0..1": "discount between 0 and 1",
    "freight_cost is not negative": "freight_cost >= 0",
}


def accepted_sales(sales: DataFrame) -> DataFrame:
    """Rows that keep every declared rule, as plain conjuncts that Spark can push to the scans."""
    accepted = sales.dropna(subset=SALES_KEYS)
    for condition in SALES_CHECKS.values():
        accepted = accepted.filter(condition)
    return accepted


def sales_row_problem() -> Column:
    """First declared rule a sales row breaks, or null."""
    rules = [(F.col(name).isNotNull(), f"{name} is null") for name in [*SALES_KEYS, *SALES_MEASURES]]
    rules += [(F.expr(condition), f"violated: {rule}") for rule, condition in SALES_CHECKS.items()]
    problem = F.lit(None).cast("string")
    for holds, reason in reversed(rules):
        problem = F.when(~holds, reason).otherwise(problem)
    return problem


def rejected_sales(sales: DataFrame) -> DataFrame:
    return sales.withColumn("reason", sales_row_problem()).filter(F.col("reason").isNotNull())


def fact_supplier_purchases(lines: DataFrame) -> DataFrame:
    """Per supplier and day. The grain itself makes the surrogate key, without a counter."""
    grouped = lines.groupBy("supplier_id", "date_id").agg(
        exact_sum("amount", 4).cast(AMOUNT).alias("total_purchase_amount"),
        F.countDistinct("product_id").alias("number_of_products"),
        average(money_sum("unit_price"), F.count("unit_price")).cast("decimal(10,2)").alias("average_unit_price"),
        F.sum("quantity").alias("total_quantity"),
    )
    return _with_purchase_id(grouped)


def _with_purchase_id(grouped: DataFrame) -> DataFrame:
    return grouped.filter(F.col("total_purchase_amount").isNotNull()).select(
        (F.col("supplier_id") * 1000000 + F.col("date_id")).alias("purchase_id"), *grouped.columns
    )


PRODUCT_DAY = ["date_id", "product_id", "category_id", "supplier_id"]
CUSTOMER_DAY = ["date_id", "customer_id"]


def product_day_parts(lines: DataFrame) -> DataFrame:
    """Sums per product and day, which add up over loads of whole orders.

    Lines are grouped per order first: they come partitioned by order out of their join, so that step
    needs no shuffle, and counting orders is then counting rows.
    """
    per_order = lines.groupBy("order_id", *PRODUCT_DAY).agg(
        F.sum("quantity").alias("units"),
        exact_sum("amount", 4).alias("amount"),
        money_sum("unit_price").alias("price_sum"),
        F.count("unit_price").alias("prices"),
    )
    return merged_parts(per_order.withColumn("orders", F.lit(1).cast("bigint")), PRODUCT_DAY)


def customer_day_parts(order_details: DataFrame, dated: DataFrame) -> DataFrame:
    """Sums per customer and day, which add up over loads of whole orders.

    Lines are summed per order before they meet the orders, which are far fewer rows to join.
    """
    amount = line_amount(F.col("quantity"), F.col("unit_price"), F.col("discount"))
    per_order = order_details.groupBy("order_id").agg(
        F.sum("quantity").alias("units"), exact_sum(amount, 4).alias("amount"), F.count(amount).alias("amounts")
    )
    ordered = per_order.join(dated.select("order_id", *CUSTOMER_DAY, "order_date"), "order_id")
    return merged_parts(ordered.withColumn("orders", F.lit(1).cast("bigint")), [*CUSTOMER_DAY, "order_date"])


def merged_parts(parts: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Parts of one grain added up. Money stays exact, so any split into parts gives the same sums."""
    sums = {"amount": exact_sum("amount", 4), "price_sum": money_sum("price_sum")}
    measures = [name for name in ("units", "amount", "price_sum", "prices", "amounts", "orders") if name in parts.columns]
    return parts.groupBy(*grain).agg(*[sums.get(name, F.sum(name)).alias(name) for name in measures])


def product_sales_of(parts: DataFrame) -> DataFrame:
    """The fact of merged parts per product and day."""
    return parts.filter(F.col("amount").isNotNull()).select(
        *PRODUCT_DAY,
        F.col("units").alias("quantity_sold"),
        F.col("amount").cast(AMOUNT).alias("total_sales"),
        average(F.col("price_sum"), F.col("prices")).cast("decimal(10,2)").alias("average_unit_price"),
        F.col("orders").alias("number_of_orders"),
    )


def supplier_purchases_of(parts: DataFrame) -> DataFrame:
    """The purchases per supplier and day of merged parts per product and day, which are far fewer than lines."""
    grouped = parts.groupBy("supplier_id", "date_id").agg(
        exact_sum("amount", 4).cast(AMOUNT).alias("total_purchase_amount"),
        F.countDistinct("product_id").alias("number_of_products"),
        average(money_sum("price_sum"), F.sum("prices")).cast("decimal(10,2)").alias("average_unit_price"),
        F.sum("units").alias("total_quantity"),
    )
    return _with_purchase_id(grouped)


def customer_sales_of(parts: DataFrame) -> DataFrame:
    """The fact of merged parts per customer and day, with the days since the customer's first order with a line."""
    # At most one row per customer and calendar day: no customer can fill a window partition.
    first_day = F.min("order_date").over(Window.partitionBy("customer_id"))
    sales = parts.select(
        *CUSTOMER_DAY,
        F.col("amount").cast(AMOUNT).alias("total_amount"),
        F.col("units").alias("total_quantity"),
        F.col("orders").alias("number_of_transactions"),
        average(F.col("amount"), F.col("amounts")).cast(AMOUNT).alias("average_transaction_value"),
        F.datediff("order_date", first_day).alias("days_since_first_purchase"),
    )
    return sales.filter(F.col("total_amount").isNotNull())


def fact_product_sales(lines: DataFrame) -> DataFrame:
    """Per day and product."""
    return product_sales_of(product_day_parts(lines))


def fact_customer_sales(order_details: DataFrame, dated: DataFrame) -> DataFrame:
    """Per customer and day, with the days since the customer's first order with a line."""
    return customer_sales_of(customer_day_parts(order_details, dated))


def fact_inventory(products: DataFrame, order_details: DataFrame, calendar: DataFrame, as_of: date) -> DataFrame:
    """Stock snapshot per product on the day `as_of`, which the calendar must contain."""
    message = F.lit(f"{as_of} is outside the calendar")
    day_id = calendar.filter(F.col("date") == F.lit(as_of)).agg(F.first("date_id")).scalar()
    sold = order_details.groupBy("product_id").agg(F.sum("quantity").alias("units"), F.count("quantity").alias("lines"))
    supply = F.when(F.col("units") > 0, whole_ratio(F.col("units_in_stock") * F.col("lines"), F.col("units")))
    return (
        products.filter(F.col("units_in_stock").isNotNull())
        .join(sold, "product_id", "left")
        .select(
            F.coalesce(day_id, F.raise_error(message).cast("int")).alias("date_id"),
            "product_id",
            "units_in_stock",
            "units_on_order",
            "reorder_level",
            (F.col("units_in_stock") * F.col("unit_price")).cast(AMOUNT).alias("stock_value"),
            (F.col("units_in_stock") <= F.col("reorder_level")).alias("is_below_reorder_level"),
            supply.alias("days_of_supply"),
        )
    )


class DataMart:
    """Dimensions and facts of the mart over one staging area, all lazy."""

    def __init__(
        self,
        staging: Staging,
        as_of: date,
        days: tuple[date, date] = MART_DAYS,
        arrived: Column | None = None,
        whole: Column | None = None,
    ):
        """`arrived`, a condition on orders, limits the facts to the orders of one load; `whole`, a condition
        on order_id, to a slice of whole orders."""
        self.staging = staging
        self.as_of = as_of
        self.days = days
        self.arrived = F.lit(True) if arrived is None else arrived
        self.whole = F.lit(True) if whole is None else whole

    def slices(self, most_bytes: int) -> list[DataMart]:
        """The same facts in slices of whole orders, each of at most about so many bytes of source files."""
        number = self.staging.pieces(most_bytes, "orders", "lineitem")
        piece = F.pmod(F.xxhash64("order_id"), F.lit(number))
        return [DataMart(self.staging, self.as_of, self.days, self.arrived, self.whole & (piece == n)) for n in range(number)]

    @cached_property
    def calendar(self) -> DataFrame:
        return mart_calendar(self.staging.spark, self.days)

    def _first_load(self, kind: str, staged: DataFrame, *sources: str) -> DataFrame:
        return self.staging.sized(first_load(kind, staged, self.as_of), *sources)

    def _first_lookup(self, kind: str, name: str) -> DataFrame:
        return self.staging.lookup(first_load(kind, getattr(self.staging, name), self.as_of), name)

    @cached_property
    def suppliers(self) -> DataFrame:
        return self._first_load("supplier", self.staging.suppliers, "supplier", "nation")

    @cached_property
    def categories(self) -> DataFrame:
        return self._first_lookup("category", "categories")

    @cached_property
    def products(self) -> DataFrame:
        """Current versions only, so that a join on product_id cannot fan out over old versions."""
        return self._first_load("product", self.staging.products, "part").filter("is_current")

    @cached_property
    def customers(self) -> DataFrame:
        return self._first_load("customer", self.staging.customers, "customer", "nation")

    @cached_property
    def employees(self) -> DataFrame:
        return self._first_lookup("employee", "employees")

    @cached_property
    def shippers(self) -> DataFrame:
        return self._first_lookup("shipper", "shippers")

    @cached_property
    def order_details(self) -> DataFrame:
        return self.staging.order_details.where(self.whole)

    @cached_property
    def dated_orders(self) -> DataFrame:
        dated = dated_orders(self.staging.orders_between(self.days).where(self.arrived & self.whole), self.calendar)
        return self.staging.sized(dated, "orders")

    @cached_property
    def _products(self) -> DataFrame:
        return self.staging.sized(self.staging.products, "part")

    @cached_property
    def _named_products(self) -> DataFrame:
        """Products with the names of supplier and category, for reports that group lines by names."""
        suppliers = self.suppliers.select("supplier_id", F.col("company_name").alias("supplier"))
        named = self.staging.products.join(suppliers, "supplier_id").join(
            self.categories.select("category_id", "category_name"), "category_id"
        )
        return self.staging.sized(named, "part", "supplier", "nation")

    @cached_property
    def all_sales(self) -> DataFrame:
        return self._all_sales(self._products)

    @cached_property
    def named_sales(self) -> DataFrame:
        return accepted_sales(self._all_sales(self._named_products, ("supplier", "category_name")))

    def _all_sales(self, products: DataFrame, about: Sequence[str] = ()) -> DataFrame:
        details = self.order_details
        counts = self.staging.sized(line_counts(details), "orders", "lineitem")
        orders = self.staging.sized(with_freight_share(self.dated_orders, counts), "orders")
        return fact_sales(priced_lines(details, orders, products, about), about=about)

    @cached_property
    def sales(self) -> DataFrame:
        return accepted_sales(self.all_sales)

    @cached_property
    def lines(self) -> DataFrame:
        return priced_lines(self.order_details, self.dated_orders, self._products)

    @cached_property
    def supplier_purchases(self) -> DataFrame:
        return fact_supplier_purchases(self.lines)

    @cached_property
    def product_sales(self) -> DataFrame:
        return fact_product_sales(self.lines)

    @cached_property
    def customer_sales(self) -> DataFrame:
        return fact_customer_sales(self.order_details, self.dated_orders)

    @cached_property
    def inventory(self) -> DataFrame:
        return fact_inventory(self.staging.products, self.staging.order_details, self.calendar, self.as_of)

    def tables(self) -> dict[str, DataFrame]:
        return {
            "dim_date": self.calendar,
            "dim_supplier": self.suppliers,
            "dim_category": self.categories,
            "dim_product": self.products,
            "dim_customer": self.customers,
            "dim_employee": self.employees,
            "dim_shipper": self.shippers,
            "fact_sales": self.sales,
            "fact_supplier_purchases": self.supplier_purchases,
            "fact_product_sales": self.product_sales,
            "fact_customer_sales": self.customer_sales,
            "fact_inventory": self.inventory,
        }
