"""Data-quality checks of the warehouse. The checks of one table share one pass over it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.money import grand_total, percent, ratio
from tradeloom.plans.sales_reports import on_days

# Weights of the quality score and its ratings, highest first.
WEIGHTS = {"completeness": 40, "validity": 30, "consistency": 30}
RATINGS = [(95, "Excellent"), (85, "Good"), (75, "Fair")]
LOWEST_RATING = "Poor"


def _count_where(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("bigint")


def record_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row with a count per table, named by the mapping's keys."""
    spark = next(iter(tables.values())).sparkSession
    counts = [df.agg(F.count("*")).scalar().alias(name) for name, df in tables.items()]
    return spark.range(1).select(*counts)


def fact_integrity(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count("*").alias("total_fact_records"),
        _count_where(F.col("customer_id").isNull()).alias("missing_customer_id"),
        _count_where(F.col("product_id").isNull()).alias("missing_product_id"),
        _count_where(F.col("date_id").isNull()).alias("missing_date_id"),
        _count_where(F.col("total_amount") < 0).alias("negative_total_amount"),
        _count_where(F.col("quantity_sold") <= 0).alias("invalid_quantity"),
    )


def with_parent_flags(rows: DataFrame, parents: Mapping[str, tuple[str, DataFrame, str]]) -> DataFrame:
    """The rows with one flag per parent (flag: child column, parent, parent column), true where there
    is none. One left join each, so the rows are read once; Spark splits hot keys."""
    for flag, (column, parent, parent_column) in parents.items():
        known = parent.select(F.col(parent_column).alias("_parent")).distinct()
        rows = rows.join(known, F.col(column) == F.col("_parent"), "left")
        rows = rows.withColumn(flag, F.col("_parent").isNull()).drop("_parent")
    return rows


def orphans(fact: DataFrame, customers: DataFrame, products: DataFrame, calendar: DataFrame) -> DataFrame:
    """Rows without a known customer, product or day; a null key counts as missing."""
    parents = {
        "orphaned_customer_records": ("customer_id", customers, "customer_id"),
        "orphaned_product_records": ("product_id", products, "product_id"),
        "orphaned_date_records": ("date_id", calendar, "date_id"),
    }
    keys = fact.select("customer_id", "product_id", "date_id")
    return with_parent_flags(keys, parents).agg(*[_count_where(F.col(flag)).alias(flag) for flag in parents])


def business_ranges(fact: DataFrame) -> DataFrame:
    measures = ["unit_price", "discount", "total_amount"]
    bounds = [f(name).alias(f"{label}_{name}") for name in measures for label, f in (("min", F.min), ("max", F.max))]
    return fact.agg(*bounds, F.count("*").alias("total_records_validated"))


def amount_ranges(fact: DataFrame) -> DataFrame:
    """Ranges and average of the amounts that are not negative."""
    total = F.col("total_amount")
    return fact.filter((total >= 0) & (F.col("tax_amount") >= 0)).agg(
        F.min(total).alias("min_total_amount"),
        F.max(total).alias("max_total_amount"),
        ratio(grand_total(total), F.count(total)).alias("avg_total_amount"),
        F.min("tax_amount").alias("min_tax_amount"),
        F.max("tax_amount").alias("max_tax_amount"),
        F.count("*").alias("total_records_validated"),
    )


def completeness(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Rows, nulls and null share per table and column: one pass per table, then unpivoted."""
    parts = []
    for table, (df, columns) in tables.items():
        nulls = [_count_where(F.col(name).isNull()).alias(name) for name in columns]
        counted = df.agg(F.count("*").alias("total_rows"), *nulls)
        parts.append(
            counted.unpivot(["total_rows"], list(columns), "column_name", "null_count").withColumn(
                "table_name", F.lit(table)
            )
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.select(
        "table_name",
        "column_name",
        "total_rows",
        "null_count",
        percent(F.col("null_count"), F.col("total_rows")).alias("null_percentage"),
    )


def temporal(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    return (
        on_days(fact, calendar, "year", "month")
        .groupBy("year", "month")
        .agg(
            F.count("*").alias("sales_count"),
            grand_total("total_amount").alias("total_sales"),
            ratio(grand_total("total_amount"), F.count("*")).alias("avg_sale_amount"),
        )
        .orderBy("year", "month")
    )


def kpis(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Headline figures in one row. Sums collapse on the map side; only distinct ids are shuffled."""
    total, customers = grand_total("total_amount"), F.countDistinct("customer_id")
    return on_days(fact, calendar, "date").agg(
        customers.alias("total_customers"),
        F.countDistinct("product_id").alias("total_products"),
        F.countDistinct("employee_id").alias("total_employees"),
        F.count("*").alias("total_transactions"),
        total.alias("total_sales_revenue"),
        grand_total("tax_amount").alias("total_tax_collected"),
        ratio(total, F.count("*")).alias("avg_transaction_value"),
        F.min("date").alias("first_sale_date"),
        F.max("date").alias("last_sale_date"),
        ratio(total, customers).alias("avg_revenue_per_customer"),
    )


def monthly_summary(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    return (
        on_days(fact, calendar, "year", "month", "month_name")
        .groupBy("year", "month", "month_name")
        .agg(
            F.count("*").alias("monthly_transactions"),
            grand_total("total_amount").alias("monthly_sales"),
            grand_total("tax_amount").alias("monthly_tax"),
            F.countDistinct("customer_id").alias("active_customers"),
            F.countDistinct("product_id").alias("products_sold"),
        )
        .orderBy("year", "month")
    )


def quality_score(
    fact: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    calendar: DataFrame,
    corrected: bool = False,
) -> DataFrame:
    """Weighted score of completeness, validity and consistency, with a rating.

    Consistency compares the stored total, which has two decimals, with the product of its factors.
    Literally that product is unrounded, so most discounted lines differ; `corrected` rounds it.
    """
    found = F.lit(True).alias
    expected = F.col("quantity_sold") * F.col("unit_price") * (1 - F.col("discount"))
    if corrected:
        expected = expected.cast("decimal(15,2)")
    incomplete = F.col("_customer").isNull() | F.col("_product").isNull() | F.col("_day").isNull()
    invalid = (
        (F.col("quantity_sold") <= 0) | (F.col("unit_price") < 0) | (F.col("discount") < 0) | (F.col("discount") > 1)
    )
    counts = (
        fact.join(customers.select("customer_id", found("_customer")), "customer_id", "left")
        .join(products.select("product_id", found("_product")), "product_id", "left")
        .join(F.broadcast(calendar.select("date_id", found("_day"))), "date_id", "left")
        .agg(
            F.count("*").alias("n"),
            _count_where(incomplete).alias("completeness"),
            _count_where(invalid).alias("validity"),
            _count_where(F.col("total_amount") != expected).alias("consistency"),
        )
    )

    def weighted(name: str) -> Column:
        return (F.col("n") - F.col(name)) * WEIGHTS[name]

    points = weighted("completeness") + weighted("validity") + weighted("consistency")
    rating = F.when(F.lit(False), LOWEST_RATING)
    for bound, label in RATINGS:
        rating = rating.when(points >= F.col("n") * bound, label)
    return counts.select(
        ratio(points, F.col("n")).alias("total_quality_score"),
        *[ratio(weighted(name), F.col("n")).alias(name) for name in WEIGHTS],
        rating.otherwise(LOWEST_RATING).alias("quality_rating"),
    )


@dataclass(frozen=True)
class RowRule:
    """A rule on one row; it is broken where the condition is not true, a null included."""

    name: str
    holds: Column


@dataclass(frozen=True)
class UniqueRule:
    name: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class ReferenceRule:
    """A key that must exist in the parent; a null key is allowed unless a row rule forbids it."""

    name: str
    column: str
    parent: DataFrame
    parent_column: str


Rule = RowRule | UniqueRule | ReferenceRule


def required(*columns: str) -> list[RowRule]:
    return [RowRule(f"{name} is required", F.col(name).isNotNull()) for name in columns]


def within(column: str, low: object = None, high: object = None) -> RowRule:
    """A bound that nulls pass, as in a declared check."""
    value = F.col(column)
    holds = F.lit(True)
    if low is not None:
        holds = holds & (value >= low)
    if high is not None:
        holds = holds & (value <= high)
    bounds = f"{'' if low is None else low}..{'' if high is None else high}"
    return RowRule(f"{column} in {bounds}", F.coalesce(holds, F.lit(True)))


def at_most(column: str, length: int) -> RowRule:
    holds = F.coalesce(F.length(column) <= length, F.lit(True))
    return RowRule(f"{column} has at most {length} characters", holds)


def violations(table: str, df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Violations per rule of one table; a unique rule counts surplus rows.

    Row rules, references and the first unique rule share one pass: broken rules are added up per
    unique key, then over all keys. Further unique rules take a pass each.
    """
    parents = {
        f"_broken{i}": (rule.column, rule.parent, rule.parent_column)
        for i, rule in enumerate(rules)
        if isinstance(rule, ReferenceRule)
    }
    broken: dict[str, Column] = {}
    for i, rule in enumerate(rules):
        if isinstance(rule, RowRule):
            broken[rule.name] = ~F.coalesce(rule.holds, F.lit(False))
        elif isinstance(rule, ReferenceRule):
            broken[rule.name] = F.col(rule.column).isNotNull() & F.col(f"_broken{i}")
    unique = [rule for rule in rules if isinstance(rule, UniqueRule)]
    marked = with_parent_flags(df, parents)
    counts = [_count_where(condition).alias(name) for name, condition in broken.items()]
    if unique:
        surplus = (F.count("*") - 1).alias(unique[0].name)
        names = [*broken, unique[0].name]
        per_key = marked.groupBy(*[F.col(name).alias(f"_key{i}") for i, name in enumerate(unique[0].columns)])
        totals = per_key.agg(*counts, surplus).agg(
            *[F.coalesce(F.sum(f"`{name}`"), F.lit(0)).cast("bigint").alias(name) for name in names]
        )
    else:
        names, totals = list(broken), marked.agg(*counts)
    result = totals.unpivot([], [f"`{name}`" for name in names], "rule", "violations")
    for rule in unique[1:]:
        copies = df.groupBy(*rule.columns).agg((F.count("*") - 1).alias("surplus"))
        count = copies.agg(F.coalesce(F.sum("surplus"), F.lit(0)).cast("bigint").alias("violations"))
        result = result.unionByName(count.select(F.lit(rule.name).alias("rule"), "violations"))
    return result.select(F.lit(table).alias("table_name"), "rule", "violations")


def constraint_gate(tables: Mapping[str, tuple[DataFrame, Sequence[Rule]]]) -> DataFrame:
    """Violations per table and rule over all tables."""
    parts = [violations(table, df, rules) for table, (df, rules) in tables.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def split_rows(df: DataFrame, rules: Sequence[RowRule]) -> tuple[DataFrame, DataFrame]:
    """Rows that keep every row rule, and the others with the first rule they break."""
    reason = F.lit(None).cast("string")
    for rule in reversed(rules):
        reason = F.when(~F.coalesce(rule.holds, F.lit(False)), rule.name).otherwise(reason)
    marked = df.withColumn("reason", reason)
    return marked.filter(F.col("reason").isNull()).drop("reason"), marked.filter(F.col("reason").isNotNull())
