"""Business questions on the data mart.

Sorted results that grow with the data end their order with a key, so that the range partitioning of
the sort can also split a value that many rows share.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions.money import RATIO, average, exact_sum, grand_total, growth_percent, money_sum, percent, rate, ratio
from tradeloom.operators.ordering import add_ranks
from tradeloom.plans.sales_reports import on_days

# Bands as (lowest value, label), highest first. The first bound is exclusive, the others
# are inclusive; the last label takes the rest.
SUPPLIER_TIERS = [(100000, "Strategic Partner"), (50000, "Key Supplier"), (10000, "Preferred Supplier"), (None, "Standard Supplier")]
DEMAND_BANDS = [(1000, "High Demand"), (500, "Medium Demand"), (None, "Low Demand")]
SUPPLY_BANDS = [(60, "Overstocked"), (30, "Adequate Stock"), (15, "Low Stock"), (None, "Critical Stock")]
VALUE_TIERS = [(50000, "Platinum"), (20000, "Gold"), (10000, "Silver"), (None, "Bronze")]
PERFORMANCE_BANDS = [(100000, "Top Performer"), (50000, "Strong Performer"), (25000, "Solid Performer"), (None, "Developing")]
COMMISSION = "0.05"
TOP_PRODUCTS = 15
TOP_LINKS = 20
MIN_SHARED_ORDERS = 5

Bands = Sequence[tuple[int | None, str]]


def band(value: Column, bands: Bands) -> Column:
    (top, top_label), *rest = bands
    result = F.when(value > top, top_label)
    for bound, label in rest:
        result = result.otherwise(label) if bound is None else result.when(value >= bound, label)
    return result


def supplier_scorecard(
    purchases: DataFrame,
    suppliers: DataFrame,
    products: DataFrame,
    corrected: bool = False,
    tiers: Bands = SUPPLIER_TIERS,
) -> DataFrame:
    """Spend per supplier, with rank and tier.

    Literally, each purchase day is joined to each product of the supplier, so spend and units are
    counted once per product. Multiplying by the product count gives the same sums without building
    the pairs. `corrected` counts each purchase day once.
    """
    per_supplier = purchases.groupBy("supplier_id").agg(
        money_sum("total_purchase_amount").alias("spend"),
        F.sum("total_quantity").alias("units"),
        money_sum("average_unit_price").alias("price_sum"),
        F.count("*").alias("days"),
    )
    product_counts = products.groupBy("supplier_id").agg(F.count("*").alias("product_rows"))
    copies = F.lit(1) if corrected else F.col("product_rows")
    by_name = (
        per_supplier.join(product_counts, "supplier_id")
        .join(suppliers.select("supplier_id", "company_name", "country"), "supplier_id")
        .groupBy(F.col("company_name").alias("supplier"), "country")
        .agg(
            money_sum(F.col("spend") * copies).alias("total_spend"),
            F.sum(F.col("units") * copies).alias("total_units"),
            ratio(F.sum(F.col("price_sum") * copies), F.sum(F.col("days") * copies)).alias("avg_price"),
            F.sum("product_rows").alias("product_count"),
        )
    )
    ranked = add_ranks(by_name, {"spend_rank": "total_spend"}, ["supplier", "country"])
    return ranked.select(
        "supplier", "country", "total_spend", "spend_rank", "total_units", "avg_price", "product_count",
        band(F.col("total_spend"), tiers).alias("supplier_tier"),
    ).orderBy(F.desc("total_spend"), "supplier", "country")


def supplier_monthly_trend(purchases: DataFrame, suppliers: DataFrame, calendar: DataFrame) -> DataFrame:
    """Monthly spend per supplier and its growth."""
    monthly = (
        on_days(purchases, calendar, "year", "month")
        .groupBy("supplier_id", "year", "month")
        .agg(money_sum("total_purchase_amount").alias("spend"))
        .join(suppliers.select("supplier_id", F.col("company_name").alias("supplier")), "supplier_id")
        .groupBy("year", "month", "supplier")
        .agg(money_sum("spend").alias("monthly_spend"))
    )
    in_time = Window.partitionBy("supplier").orderBy("year", "month")
    return (
        monthly.withColumn("previous_month_spend", F.lag("monthly_spend").over(in_time))
        .withColumn("monthly_growth_percent", growth_percent(F.col("monthly_spend"), F.col("previous_month_spend")))
        .orderBy("year", "month", F.desc("monthly_spend"), "supplier")
    )


def product_dashboard(
    product_sales: DataFrame,
    products: DataFrame,
    categories: DataFrame,
    suppliers: DataFrame,
    limit: int = TOP_PRODUCTS,
    bands: Bands = DEMAND_BANDS,
) -> DataFrame:
    """Top products by revenue, grouped by the names of product, category and supplier."""
    per_product = product_sales.groupBy("product_id", "category_id", "supplier_id").agg(
        F.sum("quantity_sold").alias("units"),
        money_sum("total_sales").alias("revenue"),
        money_sum("average_unit_price").alias("price_sum"),
        F.count("*").alias("days"),
        F.sum("number_of_orders").alias("orders"),
    )
    names = ["product_name", "category_name", "supplier"]
    by_name = (
        per_product.join(products.select("product_id", "product_name"), "product_id")
        .join(categories.select("category_id", "category_name"), "category_id")
        .join(suppliers.select("supplier_id", F.col("company_name").alias("supplier")), "supplier_id")
        .groupBy(*names)
        .agg(
            F.sum("units").alias("total_units_sold"),
            money_sum("revenue").alias("total_revenue"),
            ratio(F.sum("price_sum"), F.sum("days")).alias("avg_selling_price"),
            F.sum("orders").alias("order_count"),
        )
    )
    # A row's rank counts rows with more revenue, and those are all among the first rows as well.
    best = by_name.orderBy(F.desc("total_revenue"), *names).limit(limit)
    return best.withColumn("revenue_rank", F.rank().over(Window.orderBy(F.desc("total_revenue")))).select(
        *names, "total_units_sold", "total_revenue", "avg_selling_price", "order_count", "revenue_rank",
        band(F.col("total_units_sold"), bands).alias("demand_category"),
    ).orderBy(F.desc("total_revenue"), *names)


def inventory_health(
    inventory: DataFrame, products: DataFrame, categories: DataFrame, bands: Bands = SUPPLY_BANDS
) -> DataFrame:
    """Stock status per product; a product that never sold has no supply figure and counts as critical."""
    return (
        inventory.join(products.select("product_id", "product_name", "category_id"), "product_id")
        .join(categories.select("category_id", "category_name"), "category_id")
        .select(
            "product_name", "category_name", "units_in_stock", "units_on_order", "reorder_level", "stock_value",
            "is_below_reorder_level", "days_of_supply",
            band(F.col("days_of_supply"), bands).alias("stock_status"),
            F.when(F.col("is_below_reorder_level"), "REORDER NEEDED").otherwise("Stock OK").alias("action_required"),
        )
        .orderBy(F.desc_nulls_first("stock_value"), F.desc("is_below_reorder_level"), "product_id")
    )


def _per_customer(customer_sales: DataFrame) -> DataFrame:
    """Customer totals; everything the customer reports need is additive from here."""
    return customer_sales.groupBy("customer_id").agg(
        money_sum("total_amount").alias("amount"),
        F.sum("total_quantity").alias("items"),
        F.sum("number_of_transactions").alias("orders"),
        money_sum("average_transaction_value").alias("value_sum"),
        F.count("*").alias("days"),
        F.max("days_since_first_purchase").alias("tenure"),
    )


def customer_lifetime_value(customer_sales: DataFrame, customers: DataFrame, tiers: Bands = VALUE_TIERS) -> DataFrame:
    """Lifetime value per customer name, country and segment, with rank and tier."""
    names = ["customer", "country", "segment"]
    by_name = (
        _per_customer(customer_sales)
        .join(
            customers.select(
                "customer_id", F.col("company_name").alias("customer"), "country",
                F.col("customer_segment").alias("segment"),
            ),
            "customer_id",
        )
        .groupBy(*names)
        .agg(
            money_sum("amount").alias("ltv"),
            F.sum("orders").alias("transactions"),
            ratio(F.sum("value_sum"), F.sum("days")).alias("avg_order_value"),
            F.max("tenure").alias("tenure_days"),
        )
    )
    ranked = add_ranks(by_name, {"ltv_rank": "ltv"}, names)
    return ranked.select(
        *names, "ltv", "ltv_rank", "transactions", "avg_order_value", "tenure_days",
        band(F.col("ltv"), tiers).alias("value_tier"),
    ).orderBy(F.desc("ltv"), *names)


def customer_geography(customer_sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers and revenue per country and per country and region.

    `grouping_id` tells a country total (1) from a region that is null in the data (0). Each customer
    is one row by then, so counting rows counts distinct customers.
    """
    located = _per_customer(customer_sales).join(customers.select("customer_id", "country", "region"), "customer_id")
    country, region = F.col("country"), F.col("region")
    return (
        located.groupingSets([[country], [country, region]], country, region)
        .agg(
            F.count("*").alias("customer_count"),
            grand_total("amount").alias("total_revenue"),
            F.sum("items").alias("total_units_sold"),
            ratio(F.sum("value_sum"), F.sum("days")).alias("avg_order_value"),
            ratio(F.sum("amount"), F.count("*")).alias("revenue_per_customer"),
            F.grouping_id().alias("grouping_id"),
        )
        .orderBy(F.desc("total_revenue"))
    )


def sales_dashboard(
    sales: DataFrame, calendar: DataFrame, categories: DataFrame, employees: DataFrame, shippers: DataFrame
) -> DataFrame:
    """Monthly sales by category, employee and shipper.

    Lines are grouped per order and category first, which needs no shuffle after their join by order.
    An order has one employee and one shipper, so orders counted per id add up when ids share a name,
    and these names are joined to the groups. Categories are joined before, as an order can hold several.
    """
    month = ["year", "month", "category_name"]
    discounts = F.col("discount") * F.col("unit_price") * F.col("quantity_sold")
    per_order = (
        on_days(sales, calendar, "year", "month")
        .join(categories.select("category_id", "category_name"), "category_id")
        .groupBy("order_id", *month, "employee_id", "shipper_id")
        .agg(
            F.count("line_total").alias("lines"),
            F.sum("quantity_sold").alias("units"),
            money_sum("line_total").alias("gross"),
            money_sum("tax_amount").alias("tax"),
            money_sum("freight_cost").alias("freight"),
            exact_sum(discounts, 4).alias("discounts"),
        )
    )

    def sums() -> list[Column]:
        amounts = [money_sum(name).alias(name) for name in ("gross", "tax", "freight")]
        counts = [F.sum(name).alias(name) for name in ("lines", "units")]
        return [*counts, *amounts, exact_sum("discounts", 4).alias("discounts")]

    per_id = per_order.groupBy(*month, "employee_id", "shipper_id").agg(F.count("*").alias("orders"), *sums())
    grouped = (
        per_id.join(employees.select("employee_id", F.col("full_name").alias("employee")), "employee_id")
        .join(shippers.select("shipper_id", F.col("company_name").alias("shipper")), "shipper_id")
        .groupBy(*month, "employee", "shipper")
        .agg(F.sum("orders").alias("order_count"), *sums())
    )
    gross, tax, freight = (F.col(name) for name in ("gross", "tax", "freight"))
    return grouped.select(
        *month,
        "employee",
        "shipper",
        "order_count",
        F.col("units").alias("total_units_sold"),
        gross.alias("gross_sales"),
        tax.alias("total_tax"),
        freight.alias("total_freight"),
        (gross + tax + freight).alias("total_revenue"),
        average(gross, F.col("lines")).alias("avg_order_value"),
        F.col("discounts").cast(RATIO).alias("total_discounts"),
    ).orderBy("year", "month", F.desc("total_revenue"), "category_name", "employee", "shipper")


def sales_trend(sales: DataFrame, calendar: DataFrame) -> DataFrame:
    """Monthly sales with the previous month, a three-month moving average and the year to date."""
    monthly = (
        on_days(sales, calendar, "year", "month")
        .groupBy("year", "month")
        .agg(grand_total("line_total").alias("monthly_sales"))
    )
    # One row per calendar month: a few hundred rows in the largest calendar.
    in_time = Window.orderBy("year", "month")
    last_three = in_time.rowsBetween(-2, 0)
    this_year = Window.partitionBy("year").orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    moving_sum, months = F.sum("monthly_sales").over(last_three), F.count("*").over(last_three)
    # The unrounded average decides the status: compare sales * months with the sum.
    gap = F.col("monthly_sales") * F.col("months") - F.col("moving_sum")
    return (
        monthly.withColumn("previous_month_sales", F.lag("monthly_sales").over(in_time))
        .withColumn("moving_sum", moving_sum)
        .withColumn("months", months)
        .withColumn("ytd_sales", F.sum("monthly_sales").over(this_year).cast(RATIO))
        .select(
            "year",
            "month",
            "monthly_sales",
            "previous_month_sales",
            growth_percent(F.col("monthly_sales"), F.col("previous_month_sales")).alias("monthly_growth_percent"),
            ratio(F.col("moving_sum"), F.col("months")).alias("three_month_moving_avg"),
            "ytd_sales",
            F.when(gap > 0, "Above Trend").when(gap < 0, "Below Trend").otherwise("On Trend").alias("trend_status"),
        )
        .orderBy("year", "month")
    )


def employee_performance(
    sales: DataFrame, employees: DataFrame, commission: str = COMMISSION, bands: Bands = PERFORMANCE_BANDS
) -> DataFrame:
    """Orders, sales, commission, rank and band per employee."""
    per_order = sales.groupBy("order_id", "employee_id").agg(
        F.sum("quantity_sold").alias("units"), money_sum("line_total").alias("amount"), F.count("line_total").alias("n")
    )
    per_employee = (
        per_order.groupBy("employee_id")
        .agg(
            F.count("*").alias("total_orders"),
            F.sum("units").alias("total_units_sold"),
            money_sum("amount").alias("total_sales"),
            F.sum("n").alias("lines"),
        )
        .join(employees.select("employee_id", "full_name", "title", "hire_date"), "employee_id")
    )
    ranked = add_ranks(per_employee, {"sales_rank": "total_sales"}, ["employee_id"])
    return ranked.select(
        "full_name", "title", "hire_date", "total_orders", "total_units_sold", "total_sales",
        ratio(F.col("total_sales"), F.col("lines")).alias("avg_order_value"),
        (F.col("total_sales") * rate(commission)).cast(RATIO).alias("estimated_commission"),
        "sales_rank",
        band(F.col("total_sales"), bands).alias("performance_category"),
    ).orderBy(F.desc("total_sales"), "employee_id")


def category_deep_dive(sales: DataFrame, categories: DataFrame, products: DataFrame) -> DataFrame:
    """Category totals, prices and shares. Units per product is an integer division."""
    per_product = sales.groupBy("category_id", "product_id").agg(
        F.sum("quantity_sold").alias("units"), money_sum("line_total").alias("revenue")
    )
    everything = per_product.agg(grand_total("revenue")).scalar()
    per_category = (
        per_product.join(products.select("product_id"), "product_id", "left_semi")
        .join(categories.select("category_id", "category_name"), "category_id")
        .groupBy("category_name")
        .agg(
            F.countDistinct("product_id").alias("product_count"),
            F.sum("units").alias("total_units_sold"),
            grand_total("revenue").alias("total_revenue"),
        )
    )
    units, count, revenue = F.col("total_units_sold"), F.col("product_count"), F.col("total_revenue")
    return per_category.select(
        "category_name",
        "product_count",
        "total_units_sold",
        "total_revenue",
        ratio(revenue, units).alias("avg_price_per_unit"),
        F.call_function("div", units, count).alias("avg_units_per_product"),
        ratio(revenue, count).alias("avg_revenue_per_product"),
        F.rank().over(Window.orderBy(F.desc("total_revenue"))).alias("revenue_rank"),
        percent(revenue, everything).alias("market_share_percent"),
    ).orderBy(F.desc("total_revenue"))


def supplier_customer_links(
    named_sales: DataFrame,
    customers: DataFrame,
    min_orders: int = MIN_SHARED_ORDERS,
    limit: int = TOP_LINKS,
) -> DataFrame:
    """Supplier, category and customer names that share at least five orders, by revenue.

    An order has one customer, so orders counted per customer id add up when ids share a name, and
    customer names can be joined after the aggregation. Supplier and category names cannot: the sales
    have them from their products (`DataMart.named_sales`), not by another join of the lines.
    """
    per_customer = (
        named_sales.groupBy("supplier", "category_name", "customer_id")
        .agg(
            F.countDistinct("order_id").alias("orders"),
            F.sum("quantity_sold").alias("units"),
            money_sum("line_total").alias("revenue"),
            money_sum("unit_price").alias("price_sum"),
            F.count("unit_price").alias("lines"),
        )
    )
    names = ["supplier", "category_name", "customer"]
    return (
        per_customer.join(customers.select("customer_id", F.col("company_name").alias("customer")), "customer_id")
        .groupBy(*names)
        .agg(
            F.sum("orders").alias("shared_transactions"),
            F.sum("units").alias("total_units"),
            money_sum("revenue").alias("total_revenue"),
            ratio(F.sum("price_sum"), F.sum("lines")).alias("avg_unit_price"),
        )
        .filter(F.col("shared_transactions") >= min_orders)
        .orderBy(F.desc("total_revenue"), *names)
        .limit(limit)
    )
