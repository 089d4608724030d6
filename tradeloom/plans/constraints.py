"""The declared constraints of staging, warehouse and mart, as rules of the quality gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.plans.mart import SALES_KEYS, SALES_MEASURES, DataMart
from tradeloom.plans.quality import ReferenceRule, RowRule, Rule, UniqueRule, at_most, required, within
from tradeloom.plans.warehouse import SalesWarehouse
from tradeloom.sources.staging import Staging

# Declared text lengths and number ranges.
NAME_LENGTH, PLACE_LENGTH, POSTAL_LENGTH, PHONE_LENGTH = 40, 15, 10, 24
PART_RANGES = {"day": (1, 31), "month": (1, 12), "quarter": (1, 4), "week_of_year": (1, 53)}


def _lengths(*names: str) -> list[RowRule]:
    limits = {"city": PLACE_LENGTH, "country": PLACE_LENGTH, "region": PLACE_LENGTH, "postal_code": POSTAL_LENGTH, "phone": PHONE_LENGTH}
    return [at_most(name, limits.get(name, NAME_LENGTH)) for name in names]


def _calendar_rules(first_weekday: int) -> list[Rule]:
    rules: list[Rule] = [within(name, low, high) for name, (low, high) in PART_RANGES.items()]
    return [*rules, within("day_of_week", first_weekday, first_weekday + 6), UniqueRule("date is unique", ("date",))]


def line_rules() -> list[RowRule]:
    """Row rules of an order line."""
    return [
        *required("unit_price", "quantity", "discount"),
        RowRule("quantity is positive", F.coalesce(F.col("quantity") > 0, F.lit(True))),
        within("unit_price", low=0),
        within("discount", 0, 1),
    ]


def sales_rules() -> list[RowRule]:
    """Row rules of the mart's sales fact."""
    return [
        *required(*SALES_KEYS, *SALES_MEASURES),
        RowRule("quantity_sold is positive", F.coalesce(F.col("quantity_sold") > 0, F.lit(True))),
        within("unit_price", low=0),
        within("discount", 0, 1),
        *[within(name, low=0) for name in ("line_total", "tax_amount", "freight_cost")],
    ]


def warehouse_rules(staging: Staging, warehouse: SalesWarehouse, mart: DataMart) -> dict[str, tuple[DataFrame, Sequence[Rule]]]:
    """Rules per table. Orders outside the warehouse calendar break its rule: the load drops them."""
    s, w, m = staging, warehouse, mart

    def reference(column: str, parent: DataFrame, parent_column: str, name: str) -> ReferenceRule:
        return ReferenceRule(f"{column} exists in {name}", column, parent, parent_column)

    in_mart_calendar = F.col("order_date").between(*[F.lit(day) for day in m.days])
    in_warehouse_calendar = F.col("order_date").between(*[F.lit(day) for day in w.days])
    return {
        "staging_customers": (
            s.customers,
            [*required("customer_id", "company_name"), *_lengths("company_name", "city", "region", "postal_code", "country", "phone"),
             UniqueRule("customer_id is unique", ("customer_id",))],
        ),
        "staging_suppliers": (
            s.suppliers,
            [*required("supplier_id", "company_name"), *_lengths("company_name", "city", "country"),
             UniqueRule("supplier_id is unique", ("supplier_id",))],
        ),
        "staging_categories": (
            s.categories,
            [*required("category_id", "category_name"), at_most("category_name", PLACE_LENGTH),
             UniqueRule("category_id is unique", ("category_id",))],
        ),
        "staging_employees": (
            s.employees,
            [*required("employee_id", "last_name", "first_name", "title"),
             UniqueRule("employee_id is unique", ("employee_id",))],
        ),
        "staging_products": (
            s.products,
            [*required("product_id", "product_name", "discontinued"), at_most("product_name", NAME_LENGTH),
             within("unit_price", low=0), within("units_in_stock", low=0),
             UniqueRule("product_id is unique", ("product_id",)),
             reference("supplier_id", s.suppliers, "supplier_id", "staging_suppliers"),
             reference("category_id", s.categories, "category_id", "staging_categories")],
        ),
        "staging_orders": (
            s.orders,
            [*required("order_id", "order_date"),
             RowRule("order_date is in the mart calendar", in_mart_calendar),
             RowRule("order_date is in the warehouse calendar", in_warehouse_calendar),
             UniqueRule("order_id is unique", ("order_id",)),
             reference("customer_id", s.customers, "customer_id", "staging_customers"),
             reference("employee_id", s.employees, "employee_id", "staging_employees"),
             reference("ship_via", s.shippers, "shipper_id", "staging_shippers")],
        ),
        "staging_order_details": (
            s.order_details,
            [*line_rules(), UniqueRule("order_id, product_id are unique", ("order_id", "product_id")),
             reference("order_id", s.orders, "order_id", "staging_orders"),
             reference("product_id", s.products, "product_id", "staging_products")],
        ),
        "dw_dim_date": (w.calendar, _calendar_rules(1)),
        "mart_dim_date": (m.calendar, [*_calendar_rules(0), within("year", 1900, 2100)]),
        "mart_fact_sales": (m.all_sales, sales_rules()),
    }
