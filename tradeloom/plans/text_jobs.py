"""Text quality jobs on suppliers, customers, products and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.money import grand_total, money_sum
from tradeloom.functions.text import (
    drop_all_separators,
    drop_first_separator,
    has_odd_character,
    name_rejection,
    postal_class,
    us_phone,
)


def homepage_audit(suppliers: DataFrame) -> DataFrame:
    """Suppliers whose home page holds an unusual character; a missing home page is not reported."""
    return suppliers.filter(has_odd_character(F.col("homepage"))).select("supplier_id", "company_name", "homepage")


def page_url_audit(pages: DataFrame) -> DataFrame:
    return pages.filter(has_odd_character(F.col("url"))).select("page_id", "url")


def phone_standardize(customers: DataFrame, corrected: bool = False, limit: int | None = None) -> DataFrame:
    """Phones as (XXX) XXX-XXXX. Literally only the first separator is removed; `corrected` removes all."""
    clean = drop_all_separators if corrected else drop_first_separator
    phones = customers.filter(F.col("phone").isNotNull()).select(
        "customer_id",
        "company_name",
        F.col("phone").alias("original_phone"),
        us_phone(clean(F.col("phone"))).alias("formatted_phone"),
    )
    return phones if limit is None else phones.orderBy("customer_id").limit(limit)


def postal_classes(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", "postal_code", postal_class(F.col("postal_code")).alias("postal_class"))


def postal_segments(customers: DataFrame, fact: DataFrame) -> DataFrame:
    """Customers and revenue per postal class; customers without sales count with none."""
    revenue = fact.groupBy("customer_id").agg(money_sum("total_amount").alias("revenue"))
    zero = F.lit(0).cast("decimal(25,2)")
    return (
        customers.join(revenue, "customer_id", "left")
        .groupBy(postal_class(F.col("postal_code")).alias("postal_class"))
        .agg(F.count("*").alias("customer_count"), grand_total(F.coalesce("revenue", zero)).alias("total_revenue"))
    )


def accepted_names(products: DataFrame) -> DataFrame:
    """Products whose name passes, with the trimmed name."""
    passed = products.filter(name_rejection(F.col("product_name")).isNull())
    return passed.withColumn("product_name", F.trim("product_name"))


def rejected_names(products: DataFrame) -> DataFrame:
    """Products whose name fails, with the name as typed and the first reason."""
    judged = products.withColumn("reason", name_rejection(F.col("product_name")))
    return judged.filter(F.col("reason").isNotNull())


def product_name_gate(products: DataFrame) -> DataFrame:
    """Every product with its verdict: the trimmed name, or the typed name and a reason."""
    reason = name_rejection(F.col("product_name"))
    judged = products.withColumn("reason", reason)
    name = F.when(F.col("reason").isNull(), F.trim("product_name")).otherwise(F.col("product_name"))
    return judged.withColumn("product_name", name)
