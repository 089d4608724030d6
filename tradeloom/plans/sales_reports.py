"""Reports on the sales warehouse.

Each report joins the broadcast calendar, aggregates on keys, and only then joins names, so that text
is looked up for groups and not for order lines. The product of a fact row is always a known one, so
the fact's own category_id is the category of its product.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions.money import RATIO, grand_total, growth_percent, money_sum, percent, rate, ratio
from tradeloom.operators.cut_points import add_tiles
from tradeloom.operators.ordering import checkpointed
from tradeloom.operators.top_ranks import top_of_groups, top_overall

# Report constants.
FIRST_QUARTER = (1, 2, 3)
WEEKLY_YEAR = 1997
TOP_RANK = 5
TOP_CUSTOMERS = 10
MIN_PERIODS = 3


def on_days(fact: DataFrame, calendar: DataFrame, *columns: str) -> DataFrame:
    return fact.join(F.broadcast(calendar.select("date_id", *columns)), "date_id")


def _average(total: str, count: str) -> Column:
    return ratio(F.col(total), F.col(count))


def monthly_category_trend(
    fact: DataFrame, calendar: DataFrame, categories: DataFrame, months: Sequence[int] = FIRST_QUARTER
) -> DataFrame:
    """Sales per month and category for the given months, with growth over the previous listed month."""
    days = days_of_months(calendar, months)
    monthly = (
        on_days(fact, days, "year", "month", "month_name")
        .groupBy("year", "month", "month_name", "category_id")
        .agg(F.count("*").alias("n"), F.sum("quantity_sold").alias("units"), money_sum("total_amount").alias("amount"))
        .join(categories.select("category_id", "category_name"), "category_id")
        .groupBy("year", "month", "month_name", "category_name")
        .agg(
            F.sum("n").alias("transaction_count"),
            F.sum("units").alias("total_quantity_sold"),
            grand_total("amount").alias("total_sales_amount"),
        )
    )
    in_time = Window.partitionBy("category_name").orderBy("year", "month")
    return (
        monthly.withColumn("previous_month_sales", F.lag("total_sales_amount").over(in_time))
        .select(
            "year",
            "month",
            "month_name",
            "category_name",
            "transaction_count",
            "total_quantity_sold",
            _average("total_sales_amount", "transaction_count").alias("avg_sales_amount"),
            "total_sales_amount",
            "previous_month_sales",
            growth_percent(F.col("total_sales_amount"), F.col("previous_month_sales")).alias("sales_growth_percent"),
        )
        .orderBy("year", "month", F.desc("total_sales_amount"))
    )


def top_products_monthly(
    fact: DataFrame, calendar: DataFrame, products: DataFrame, categories: DataFrame, top: int = TOP_RANK
) -> DataFrame:
    """Products that rank in a month's top five by number of sales or by value."""
    monthly = (
        on_days(fact, calendar, "year", "month")
        .groupBy("year", "month", "product_id")
        .agg(
            F.count("*").alias("transaction_count"),
            money_sum("total_amount").alias("total_sales"),
            money_sum("tax_amount").alias("total_tax"),
        )
    )
    values = {"transaction_rank": "transaction_count", "sales_rank": "total_sales"}
    often, much = F.col("transaction_rank") <= top, F.col("sales_rank") <= top
    return (
        top_of_groups(checkpointed(monthly), values, top, ["year", "month"])
        .join(products.select("product_id", "product_name", "category_id"), "product_id")
        .join(categories.select("category_id", "category_name"), "category_id")
        .select(
            "year",
            "month",
            "product_name",
            "category_name",
            "transaction_count",
            "total_sales",
            "total_tax",
            _average("total_sales", "transaction_count").alias("avg_transaction_value"),
            "transaction_rank",
            "sales_rank",
            F.when(often & much, "Top in Both")
            .when(often, "Top in Transactions")
            .when(much, "Top in Sales")
            .otherwise("Not in Top 5")
            .alias("performance_category"),
        )
        .orderBy("year", "month", "transaction_rank", "sales_rank", "product_id")
    )


def top_customers(
    fact: DataFrame,
    calendar: DataFrame,
    customers: DataFrame,
    top: int = TOP_RANK,
    limit: int = TOP_CUSTOMERS,
) -> DataFrame:
    """The best customers among those in the top five by number of lines or by value."""
    per_customer = (
        on_days(fact, calendar, "date")
        .groupBy("customer_id")
        .agg(
            F.count("*").alias("transaction_count"),
            money_sum("total_amount").alias("total_purchase_amount"),
            F.countDistinct("category_id").alias("unique_categories_purchased"),
            F.max("date").alias("last_purchase_date"),
        )
    )
    values = {"transaction_rank": "transaction_count", "purchase_rank": "total_purchase_amount"}
    # Weights 0.4 and 0.6 over a hundred, as whole numbers over a thousand.
    score = ratio(F.col("transaction_count") * 4 + F.col("total_purchase_amount") * 6, F.lit(1000))
    best_first = [F.desc("customer_value_score"), F.desc("total_purchase_amount"), F.col("customer_id")]
    stored = checkpointed(per_customer.withColumn("customer_value_score", score))
    best = top_overall(stored, values, top, best_first, limit)
    return (
        customers.join(F.broadcast(best), "customer_id")
        .select(
            "customer_id", "company_name", "country", "city", "transaction_count", "total_purchase_amount",
            _average("total_purchase_amount", "transaction_count").alias("avg_transaction_value"),
            "unique_categories_purchased", "last_purchase_date", "transaction_rank", "purchase_rank",
            "customer_value_score",
        )
        .orderBy(*best_first)
    )


def days_of_months(calendar: DataFrame, months: Sequence[int] = FIRST_QUARTER) -> DataFrame:
    return calendar.filter(F.col("month").isin(*months))


def days_of_first_weeks(calendar: DataFrame) -> DataFrame:
    """Days in the lowest ISO week of their month, with that week."""
    lowest = calendar.groupBy("year", "month").agg(F.min("week_of_year").alias("first_week"))
    return calendar.join(lowest, ["year", "month"]).filter(F.col("week_of_year") == F.col("first_week"))


def first_week_sales(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sales in the lowest ISO week of each calendar month, against the same month a year before.

    The lowest ISO week is taken literally: December may hold week 1, whose days are its last ones.
    """
    days = days_of_first_weeks(calendar)
    monthly = (
        on_days(fact, days, "year", "month", "month_name", "first_week")
        .groupBy("year", "month", "month_name", "first_week")
        .agg(
            F.count("*").alias("transaction_count"),
            F.sum("quantity_sold").alias("total_quantity_sold"),
            money_sum("total_amount").alias("total_sales_amount"),
            money_sum("tax_amount").alias("total_tax_amount"),
        )
    )
    by_month = Window.partitionBy("month").orderBy("year")
    grown = (
        monthly.withColumn("avg_transaction_value", _average("total_sales_amount", "transaction_count"))
        .withColumn("previous_year_same_month_sales", F.lag("total_sales_amount").over(by_month))
        .withColumn(
            "year_over_year_growth",
            growth_percent(F.col("total_sales_amount"), F.col("previous_year_same_month_sales")),
        )
    )
    growth = F.col("year_over_year_growth")
    status = F.when(growth > 0, "Growth").when(growth < 0, "Decline").otherwise("Stable")
    return grown.withColumn("growth_status", status).orderBy("year", "month")


def weekly_category_sales(
    fact: DataFrame, calendar: DataFrame, categories: DataFrame, year: int = WEEKLY_YEAR
) -> DataFrame:
    """Weekly sales per category in one year, with the monthly total, the share of it and a running sum."""
    days = calendar.filter(F.col("year") == year)
    keys = ["year", "month", "month_name", "week_of_year"]
    weekly = (
        on_days(fact.filter(F.col("order_year") == year), days, *keys)
        .groupBy(*keys, "category_id")
        .agg(
            F.count("*").alias("n"),
            F.sum("quantity_sold").alias("units"),
            money_sum("total_amount").alias("amount"),
            money_sum("tax_amount").alias("tax"),
        )
        .join(categories.select("category_id", "category_name"), "category_id")
        .groupBy(*keys, "category_name")
        .agg(
            F.sum("n").alias("weekly_transactions"),
            F.sum("units").alias("weekly_quantity"),
            money_sum("amount").alias("weekly_sales"),
            money_sum("tax").alias("weekly_tax"),
        )
    )
    # A month has at most six weeks, so both windows see tiny groups and share one shuffle.
    month = Window.partitionBy("year", "month", "category_name")
    running = month.orderBy("week_of_year").rowsBetween(Window.unboundedPreceding, 0)
    return (
        weekly.withColumn("monthly_transactions", F.sum("weekly_transactions").over(month))
        .withColumn("monthly_quantity", F.sum("weekly_quantity").over(month))
        .withColumn("monthly_sales", F.sum("weekly_sales").over(month).cast(RATIO))
        .withColumn("monthly_tax", F.sum("weekly_tax").over(month).cast(RATIO))
        .withColumn("weekly_contribution_percent", percent(F.col("weekly_sales"), F.col("monthly_sales")))
        .withColumn("running_monthly_sales", F.sum("weekly_sales").over(running).cast(RATIO))
        .orderBy("year", "month", "week_of_year", F.desc("weekly_sales"))
    )


def median_sales(
    fact: DataFrame,
    calendar: DataFrame,
    customers: DataFrame,
    categories: DataFrame,
    min_periods: int = MIN_PERIODS,
) -> DataFrame:
    """Distribution of monthly sales per category and country: exact quartiles, range and skew.

    A fact that has the country already, looked up per order, needs no join of its lines for it.
    """
    if "country" not in fact.columns:
        fact = fact.join(customers.select("customer_id", "country"), "customer_id")
    monthly = (
        on_days(fact, calendar, "year", "month")
        .groupBy("category_id", "country", "year", "month")
        .agg(money_sum("total_amount").alias("amount"))
        .join(categories.select("category_id", "category_name"), "category_id")
        .groupBy("category_name", "country", "year", "month")
        .agg(money_sum("amount").alias("monthly_sales"))
        .filter(F.col("monthly_sales") > 0)
    )
    # Quartiles of whole cents are multiples of a quarter cent, which a double holds exactly. A group
    # has one value per month of the calendar, so the exact percentile buffers little.
    cents = (F.col("monthly_sales") * 100).cast("double")
    grouped = monthly.groupBy("category_name", "country").agg(
        F.count("*").alias("monthly_periods"),
        F.min("monthly_sales").alias("min_monthly_sales"),
        F.max("monthly_sales").alias("max_monthly_sales"),
        money_sum("monthly_sales").alias("total"),
        F.percentile(cents, [0.25, 0.5, 0.75]).alias("quartiles"),
    )

    def quartile(index: int) -> Column:
        rounded = F.floor(F.element_at("quartiles", index) + 0.5)
        return (rounded.cast("decimal(23,0)") * rate("0.01")).cast(RATIO)

    described = (
        grouped.filter(F.col("monthly_periods") >= min_periods)
        .withColumn("avg_monthly_sales", _average("total", "monthly_periods"))
        .withColumn("first_quartile", quartile(1))
        .withColumn("median_sales", quartile(2))
        .withColumn("third_quartile", quartile(3))
    )
    skewed = F.abs(F.col("avg_monthly_sales") - F.col("median_sales")) > F.col("median_sales") * rate("0.1")
    return described.select(
        "category_name",
        "country",
        "monthly_periods",
        "min_monthly_sales",
        "max_monthly_sales",
        "avg_monthly_sales",
        "median_sales",
        "first_quartile",
        "third_quartile",
        (F.col("third_quartile") - F.col("first_quartile")).alias("inter_quartile_range"),
        F.when(skewed, "Skewed").otherwise("Symmetric").alias("distribution_type"),
    ).orderBy("category_name", F.desc("median_sales"))


def category_ranking(fact: DataFrame, categories: DataFrame) -> DataFrame:
    """Categories ranked by value, lines and customers, with a score and the market share."""
    per_category = (
        fact.groupBy("category_id")
        .agg(
            F.count("*").alias("total_transactions"),
            F.sum("quantity_sold").alias("total_quantity_sold"),
            grand_total("total_amount").alias("total_sales_amount"),
            grand_total("tax_amount").alias("total_tax_amount"),
            F.countDistinct("customer_id").alias("unique_customers"),
            F.countDistinct("product_id").alias("unique_products"),
        )
        .join(categories.select("category_id", "category_name"), "category_id")
    )
    # One row per category from here on, so windows over all of them are small.
    everything = Window.partitionBy()

    def rank_by(name: str) -> Column:
        return F.rank().over(Window.orderBy(F.desc(name)))

    ranked = (
        per_category.withColumn("sales_rank", rank_by("total_sales_amount"))
        .withColumn("transaction_rank", rank_by("total_transactions"))
        .withColumn("customer_rank", rank_by("unique_customers"))
        .withColumn("all_sales", F.sum("total_sales_amount").over(everything))
    )
    # Weights 0.5, 0.3 and 0.2 over three, as whole numbers over thirty.
    weighted = F.col("sales_rank") * 5 + F.col("transaction_rank") * 3 + F.col("customer_rank") * 2
    sales_rank = F.col("sales_rank")
    return ranked.select(
        "category_name",
        "total_transactions",
        "total_quantity_sold",
        "total_sales_amount",
        "total_tax_amount",
        "unique_customers",
        "unique_products",
        _average("total_sales_amount", "total_transactions").alias("avg_transaction_value"),
        "sales_rank",
        "transaction_rank",
        "customer_rank",
        ratio(weighted.cast("decimal(10,0)"), F.lit(30)).alias("performance_score"),
        F.when(sales_rank == 1, "Top Seller")
        .when(sales_rank <= 3, "High Performer")
        .when(sales_rank <= 5, "Medium Performer")
        .otherwise("Low Performer")
        .alias("performance_category"),
        percent(F.col("total_sales_amount"), F.col("all_sales")).alias("market_share_percent"),
    ).orderBy("sales_rank")


def rfm_segments(fact: DataFrame, calendar: DataFrame, customers: DataFrame, as_of: date) -> DataFrame:
    """Recency, frequency and value scores of one to five per customer, and a segment."""
    per_customer = (
        on_days(fact, calendar, "date")
        .groupBy("customer_id")
        .agg(
            F.datediff(F.lit(as_of), F.max("date")).alias("recency"),
            F.count("*").alias("frequency"),
            money_sum("total_amount").alias("monetary"),
        )
    )
    # One stored row per customer; the longest time since the last purchase scores lowest.
    stored = checkpointed(per_customer.withColumn("recent", -F.col("recency")))
    scored = add_tiles(stored, {"r_score": "recent", "f_score": "frequency", "m_score": "monetary"}, "customer_id", 5)
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    segment = (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
        .when((r >= 3) & (f >= 3) & (m >= 3), "Loyal Customers")
        .when((r >= 2) & (f >= 2), "Potential Loyalists")
        .when((r >= 3) & (f <= 2), "New Customers")
        .when((r <= 2) & (f >= 3), "At Risk")
        .otherwise("Lost Customers")
    )
    return (
        scored.join(customers.select("customer_id", "company_name", "country"), "customer_id")
        .select(
            "customer_id", "company_name", "country", "recency", "frequency", "monetary",
            "r_score", "f_score", "m_score", (r + f + m).alias("rfm_total"), segment.alias("customer_segment"),
        )
        .orderBy(F.desc("rfm_total"), "customer_id")
    )
