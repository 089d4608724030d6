"""Every job by name, wired to the raw tables of a directory."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.functions.calendar import add_missing_days
from tradeloom.operators import price_audit, stock
from tradeloom.operators.versions import add_versions
from tradeloom.plans import mart as mart_plans
from tradeloom.plans import mart_reports, order_jobs, quality, sales_reports, text_jobs
from tradeloom.plans.constraints import warehouse_rules
from tradeloom.plans.mart import DataMart
from tradeloom.plans.routing import rejects_by_rule, route_rows
from tradeloom.plans.stored import SALES_KEY, StoredWarehouse, load_warehouse
from tradeloom.plans.stored_mart import SALES_KEY as MART_SALES_KEY
from tradeloom.plans.stored_mart import StoredMart
from tradeloom.plans.warehouse import SalesWarehouse, calendar_load, row_counts
from tradeloom.session import tune
from tradeloom.sources.earlier import EarlierMart
from tradeloom.sources.staging import Staging
from tradeloom.sources.stored import LOAD, new_folder, read_dimension, read_fact, save_dimension
from tradeloom.sources.stored import upsert_dimension as upsert_stored

Query = Callable[[SparkSession, str], DataFrame]

# Values that stand for clocks, sessions and generated ids, so that results can be repeated.
AS_OF = date(2001, 12, 31)
RUN_AT = datetime(2001, 12, 31, 8, 30, 0)
LATER_RUN_AT = datetime(2002, 1, 1, 9, 15, 0)
RUN_USER = "etl"
FIRST_LOAD_END = date(1996, 12, 31)
# Some orders of the last month of a first load arrive with the second one.
LATE_FROM, LATE_ORDERS = date(1996, 12, 1), 7
BATCH_ID = "batch-orders"
BULK_ID = "bulk-orders"
# A second set of bands, for data whose sums are far above the default ones.
WIDE_SUPPLIER_TIERS = [(60000000, "Strategic Partner"), (30000000, "Key Supplier"), (15000000, "Preferred Supplier"), (None, "Standard Supplier")]
WIDE_VALUE_TIERS = [(1500000, "Platinum"), (1200000, "Gold"), (800000, "Silver"), (None, "Bronze")]
WIDE_PERFORMANCE_BANDS = [(13000000, "Top Performer"), (12000000, "Strong Performer"), (11000000, "Solid Performer"), (None, "Developing")]

_JOBS: dict[str, Callable[[Company], DataFrame]] = {}


class Company:
    """One directory of raw tables, seen as staging, warehouse and mart."""

    def __init__(self, spark: SparkSession, directory: str):
        self.staging = Staging(tune(spark), directory)
        self.warehouse = SalesWarehouse(self.staging)
        self.mart = DataMart(self.staging, AS_OF)
        self.earlier = EarlierMart(self.staging)

    def stored_warehouse(self) -> StoredWarehouse:
        folder = new_folder(self.staging.spark, "warehouse")
        load_warehouse(self.warehouse, folder, "first")
        return StoredWarehouse(self.staging.spark, folder, self.warehouse.days)

    @cached_property
    def stored_mart(self) -> StoredMart:
        """The mart's facts in a folder, loaded in two runs that share a month; the second one is run twice."""
        mart = StoredMart(self.staging, AS_OF, new_folder(self.staging.spark, "mart"))
        day, order = F.col("order_date"), F.col("order_id")
        late = (day > F.lit(FIRST_LOAD_END)) | ((day >= F.lit(LATE_FROM)) & (order % LATE_ORDERS == 0))
        mart.load(DataMart(self.staging, AS_OF, arrived=~late), "1-early")
        for _ in range(2):
            mart.load(DataMart(self.staging, AS_OF, arrived=late), "2-late")
        return mart

    @property
    def price_log(self) -> DataFrame:
        s = self.staging
        return price_audit.price_changes(s.products, s.products_after, RUN_USER, RUN_AT)

    @property
    def numbered_price_log(self) -> DataFrame:
        return price_audit.with_log_id(self.price_log)

    def batch(self, limit: int | None = None) -> DataFrame:
        s, period = self.staging, order_jobs.BATCH_PERIOD
        return order_jobs.order_batch(
            s.orders_between(period), s.customers, s.order_details, BATCH_ID, RUN_AT, period, limit
        )

    def bulk(self, limit: int | None = None, stored: DataFrame | None = None, at: datetime = RUN_AT) -> DataFrame:
        s, period = self.staging, order_jobs.BULK_PERIOD
        return order_jobs.order_bulk(s.orders_between(period), s.order_details, BULK_ID, at, period, limit, stored)

    @property
    def analytics(self) -> DataFrame:
        return self.batch().unionByName(self.bulk(at=LATER_RUN_AT))


def job(function: Callable[[Company], DataFrame]) -> Callable[[Company], DataFrame]:
    _JOBS[function.__name__] = function
    return function


def queries() -> dict[str, Query]:
    """Every job by name. Jobs of one dictionary share the lazy tables of a directory, whose files they
    take as they were at first use; call again to see new files."""
    companies: dict[tuple[str, str], Company] = {}

    def company(spark: SparkSession, directory: str) -> Company:
        key = (spark.sparkContext.applicationId, directory)
        if key not in companies:
            companies[key] = Company(spark, directory)
        return companies[key]

    def query(build: Callable[[Company], DataFrame]) -> Query:
        return lambda spark, directory: build(company(spark, directory))

    return {name: query(build) for name, build in _JOBS.items()}


# Warehouse load


@job
def stage_tables(c: Company) -> DataFrame:
    return row_counts(c.warehouse.staging_tables())


@job
def dw_dim_date(c: Company) -> DataFrame:
    return calendar_load(c.warehouse.calendar, c.staging.orders)


@job
def mart_dim_date(c: Company) -> DataFrame:
    """Days with orders are stored already, marked as holidays; the load must leave them alone."""
    orders = c.staging.orders_between(c.mart.days)  # no more days than the calendar has
    sold_on = F.broadcast(orders.select(F.col("order_date").alias("date")).distinct())
    stored = c.mart.calendar.join(sold_on, "date", "left_semi").withColumn("is_holiday", F.lit(True))
    return add_missing_days(stored, c.mart.calendar)


@job
def dw_dim_customer(c: Company) -> DataFrame:
    return c.warehouse.customers


@job
def dw_dim_employee(c: Company) -> DataFrame:
    return c.warehouse.employees


@job
def dw_dim_category(c: Company) -> DataFrame:
    return c.warehouse.categories


@job
def dw_dim_shipper(c: Company) -> DataFrame:
    return c.warehouse.shippers


@job
def dw_dim_supplier(c: Company) -> DataFrame:
    return c.warehouse.suppliers


@job
def dw_dim_product(c: Company) -> DataFrame:
    return c.warehouse.products


@job
def dw_fact_sales(c: Company) -> DataFrame:
    return c.warehouse.sales().drop("order_year")


@job
def dw_stored_weekly_category_sales(c: Company) -> DataFrame:
    """The warehouse loaded into a folder, and the weekly report read from its files of one year."""
    year = sales_reports.WEEKLY_YEAR
    w = c.stored_warehouse()
    fact = w.sales((date(year, 1, 1), date(year, 12, 31)))
    return sales_reports.weekly_category_sales(fact, w.calendar, w.categories, year)


@job
def dw_stored_fact_keys(c: Company) -> DataFrame:
    """The fact loaded in two runs, the second of them twice: rows and keys of each run."""
    folder = new_folder(c.staging.spark, "warehouse")
    later = (date.fromordinal(FIRST_LOAD_END.toordinal() + 1), c.warehouse.days[1])
    load_warehouse(c.warehouse, folder, "1-early", (c.warehouse.days[0], FIRST_LOAD_END))
    for _ in range(2):
        load_warehouse(c.warehouse, folder, "2-late", later)
    return read_fact(c.staging.spark, f"{folder}/sales").groupBy(F.col(LOAD).cast("string").alias(LOAD)).agg(
        F.count("*").alias("n_rows"),
        F.countDistinct(SALES_KEY).alias("n_keys"),
        F.min(SALES_KEY).alias("lowest_key"),
        F.max(SALES_KEY).alias("highest_key"),
    )


# Mart load


@job
def mart_upsert_supplier(c: Company) -> DataFrame:
    return mart_plans.upsert_dimension("supplier", c.earlier.suppliers, c.staging.suppliers, AS_OF)


@job
def mart_upsert_category(c: Company) -> DataFrame:
    return mart_plans.upsert_dimension("category", c.earlier.categories, c.staging.categories, AS_OF)


@job
def mart_upsert_product(c: Company) -> DataFrame:
    return mart_plans.upsert_dimension("product", c.earlier.products, c.staging.products, AS_OF)


@job
def mart_upsert_customer(c: Company) -> DataFrame:
    return mart_plans.upsert_dimension("customer", c.earlier.customers, c.staging.customers, AS_OF)


@job
def mart_upsert_employee(c: Company) -> DataFrame:
    return mart_plans.upsert_dimension("employee", c.earlier.employees, c.staging.employees, AS_OF)


@job
def mart_upsert_shipper(c: Company) -> DataFrame:
    return mart_plans.upsert_dimension("shipper", c.earlier.shippers, c.staging.shippers, AS_OF)


@job
def mart_stored_upsert_customer(c: Company) -> DataFrame:
    """The customer upsert against a stored dimension, in place."""
    spark, folder = c.staging.spark, new_folder(c.staging.spark, "customers")
    save_dimension(c.earlier.customers, folder, ["customer_id"])

    def merge(stored: DataFrame, staged: DataFrame) -> DataFrame:
        return mart_plans.upsert_dimension("customer", stored, staged, AS_OF)

    upsert_stored(spark, folder, c.staging.customers, ["customer_id"], merge)
    return read_dimension(spark, folder)


@job
def mart_scd2_product(c: Company) -> DataFrame:
    return add_versions(
        c.earlier.products, c.staging.products, "product_id", mart_plans.TRACKED_PRODUCT_COLUMNS, AS_OF
    )


@job
def mart_fact_sales(c: Company) -> DataFrame:
    return c.mart.sales


@job
def mart_fact_sales_rejected(c: Company) -> DataFrame:
    """Lines that the fact leaves out, with the first rule each breaks."""
    return mart_plans.rejected_sales(c.mart.all_sales)


@job
def mart_fact_supplier_purchases(c: Company) -> DataFrame:
    return c.mart.supplier_purchases


@job
def mart_fact_product_sales(c: Company) -> DataFrame:
    return c.mart.product_sales


@job
def mart_fact_customer_sales(c: Company) -> DataFrame:
    return c.mart.customer_sales


@job
def mart_fact_inventory(c: Company) -> DataFrame:
    return c.mart.inventory


@job
def mart_stored_fact_sales(c: Company) -> DataFrame:
    """The stored fact, without its key, which depends on the order of rows within a load."""
    return c.stored_mart.sales


@job
def mart_stored_fact_keys(c: Company) -> DataFrame:
    """Rows and keys of each load of the stored fact."""
    return c.stored_mart.stored_sales.groupBy(F.col(LOAD).cast("string").alias(LOAD)).agg(
        F.count("*").alias("n_rows"),
        F.countDistinct(MART_SALES_KEY).alias("n_keys"),
        F.min(MART_SALES_KEY).alias("lowest_key"),
        F.max(MART_SALES_KEY).alias("highest_key"),
    )


@job
def mart_stored_supplier_purchases(c: Company) -> DataFrame:
    """From sums per product and day kept over the loads; the next two as well."""
    return c.stored_mart.supplier_purchases


@job
def mart_stored_product_sales(c: Company) -> DataFrame:
    return c.stored_mart.product_sales


@job
def mart_stored_customer_sales(c: Company) -> DataFrame:
    return c.stored_mart.customer_sales


@job
def mart_row_counts(c: Company) -> DataFrame:
    return row_counts(c.mart.tables())


# Warehouse reports


@job
def dw_monthly_category_trend(c: Company) -> DataFrame:
    w = c.warehouse
    fact = w.sales(days=sales_reports.days_of_months(w.calendar))
    return sales_reports.monthly_category_trend(fact, w.calendar, w.categories)


@job
def dw_top_products_monthly(c: Company) -> DataFrame:
    w = c.warehouse
    return sales_reports.top_products_monthly(w.sales(), w.calendar, w.products, w.categories)


@job
def dw_top_customers(c: Company) -> DataFrame:
    w = c.warehouse
    return sales_reports.top_customers(w.sales(), w.calendar, w.customers)


@job
def dw_first_week_sales(c: Company) -> DataFrame:
    w = c.warehouse
    fact = w.sales(days=sales_reports.days_of_first_weeks(w.calendar))
    return sales_reports.first_week_sales(fact, w.calendar)


@job
def dw_weekly_category_sales(c: Company) -> DataFrame:
    w, year = c.warehouse, sales_reports.WEEKLY_YEAR
    fact = w.sales((date(year, 1, 1), date(year, 12, 31)))
    return sales_reports.weekly_category_sales(fact, w.calendar, w.categories, year)


@job
def dw_median_sales(c: Company) -> DataFrame:
    w = c.warehouse
    return sales_reports.median_sales(w.sales(about=("country",)), w.calendar, w.customers, w.categories)


@job
def dw_category_ranking(c: Company) -> DataFrame:
    return sales_reports.category_ranking(c.warehouse.sales(), c.warehouse.categories)


@job
def dw_rfm_segments(c: Company) -> DataFrame:
    w = c.warehouse
    return sales_reports.rfm_segments(w.sales(), w.calendar, w.customers, AS_OF)


# Mart reports


@job
def mart_supplier_scorecard(c: Company) -> DataFrame:
    m = c.mart
    return mart_reports.supplier_scorecard(m.supplier_purchases, m.suppliers, m.products)


@job
def mart_supplier_scorecard_corrected(c: Company) -> DataFrame:
    m = c.mart
    return mart_reports.supplier_scorecard(
        m.supplier_purchases, m.suppliers, m.products, corrected=True, tiers=WIDE_SUPPLIER_TIERS
    )


@job
def mart_supplier_monthly_trend(c: Company) -> DataFrame:
    m = c.mart
    return mart_reports.supplier_monthly_trend(m.supplier_purchases, m.suppliers, m.calendar)


@job
def mart_product_dashboard(c: Company) -> DataFrame:
    m = c.mart
    return mart_reports.product_dashboard(m.product_sales, m.products, m.categories, m.suppliers)


@job
def mart_inventory_health(c: Company) -> DataFrame:
    m = c.mart
    return mart_reports.inventory_health(m.inventory, m.products, m.categories)


@job
def mart_customer_ltv(c: Company) -> DataFrame:
    return mart_reports.customer_lifetime_value(c.mart.customer_sales, c.mart.customers)


@job
def mart_customer_ltv_wide_tiers(c: Company) -> DataFrame:
    return mart_reports.customer_lifetime_value(c.mart.customer_sales, c.mart.customers, WIDE_VALUE_TIERS)


@job
def mart_customer_geography(c: Company) -> DataFrame:
    return mart_reports.customer_geography(c.mart.customer_sales, c.mart.customers)


@job
def mart_sales_dashboard(c: Company) -> DataFrame:
    m = c.mart
    return mart_reports.sales_dashboard(m.sales, m.calendar, m.categories, m.employees, m.shippers)


@job
def mart_sales_trend(c: Company) -> DataFrame:
    return mart_reports.sales_trend(c.mart.sales, c.mart.calendar)


@job
def mart_employee_performance(c: Company) -> DataFrame:
    return mart_reports.employee_performance(c.mart.sales, c.mart.employees)


@job
def mart_employee_performance_wide_bands(c: Company) -> DataFrame:
    return mart_reports.employee_performance(c.mart.sales, c.mart.employees, bands=WIDE_PERFORMANCE_BANDS)


@job
def mart_category_deep_dive(c: Company) -> DataFrame:
    m = c.mart
    return mart_reports.category_deep_dive(m.sales, m.categories, m.products)


@job
def mart_supplier_customer_links(c: Company) -> DataFrame:
    m = c.mart
    return mart_reports.supplier_customer_links(m.named_sales, m.customers)


@job
def mart_supplier_customer_links_two_orders(c: Company) -> DataFrame:
    m = c.mart
    return mart_reports.supplier_customer_links(m.named_sales, m.customers, min_orders=2)


# Operational jobs


@job
def order_totals(c: Company) -> DataFrame:
    """Every order id, and as many ids above the highest one, which no order has."""
    ids = c.staging.orders.select("order_id")
    highest = ids.agg(F.max("order_id")).scalar()
    requested = ids.unionByName(ids.select((F.col("order_id") + highest + 1).alias("order_id")))
    return order_jobs.order_totals(requested, c.staging.orders, c.staging.order_details)


@job
def order_total_check(c: Company) -> DataFrame:
    return order_jobs.order_total_check(c.staging.orders, c.staging.customers, c.staging.order_details)


@job
def stock_movements_apply(c: Company) -> DataFrame:
    return stock.apply_moves(c.staging.stock_moves, c.staging.products)


@job
def stock_movements_rejected(c: Company) -> DataFrame:
    return stock.rejected_moves(c.staging.stock_moves, c.staging.products)


@job
def stock_status_report(c: Company) -> DataFrame:
    return stock.stock_status(c.staging.products)


@job
def price_audit_log(c: Company) -> DataFrame:
    return c.price_log


@job
def price_audit_listing(c: Company) -> DataFrame:
    return price_audit.audit_listing(c.numbered_price_log)


@job
def price_change_summary(c: Company) -> DataFrame:
    return price_audit.change_summary(c.price_log)


@job
def price_feed_log(c: Company) -> DataFrame:
    """The event log read as an ordered feed of price changes, each logged against the state before it."""
    log = price_audit.price_steps(c.staging.products, c.staging.price_feed, RUN_USER)
    return log.withColumn("updated_at", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss"))


@job
def order_analytics_batch(c: Company) -> DataFrame:
    return c.batch(order_jobs.BATCH_SIZE)


@job
def order_analytics_batch_whole_period(c: Company) -> DataFrame:
    return c.batch()


@job
def order_analytics_batch_progress(c: Company) -> DataFrame:
    return order_jobs.batch_progress(c.batch())


@job
def order_analytics_bulk(c: Company) -> DataFrame:
    return c.bulk(order_jobs.BULK_SIZE)


@job
def order_analytics_bulk_rerun(c: Company) -> DataFrame:
    """The whole period again, over rows the first 20 orders left: only their timestamp changes."""
    return c.bulk(stored=c.bulk(order_jobs.BULK_SIZE), at=LATER_RUN_AT)


@job
def analytics_batch_summary(c: Company) -> DataFrame:
    return order_jobs.batch_summary(c.analytics)


@job
def analytics_customer_summary(c: Company) -> DataFrame:
    return order_jobs.customer_summary(c.analytics)


@job
def analytics_overall(c: Company) -> DataFrame:
    return order_jobs.overall(c.analytics)


# Data quality


@job
def dq_record_counts(c: Company) -> DataFrame:
    s, w = c.staging, c.warehouse
    return quality.record_counts(
        {
            "staging_customers": s.customers,
            "dim_customers": w.customers,
            "staging_products": s.products,
            "dim_products": w.products,
            "staging_orders": s.orders,
            "staging_order_details": s.order_details,
            "fact_sales": w.sales(),
        }
    )


@job
def dq_fact_integrity(c: Company) -> DataFrame:
    return quality.fact_integrity(c.warehouse.sales())


@job
def dq_orphans(c: Company) -> DataFrame:
    w = c.warehouse
    return quality.orphans(w.sales(), w.customers, w.products, w.calendar)


@job
def dq_business_ranges(c: Company) -> DataFrame:
    return quality.business_ranges(c.warehouse.sales())


@job
def dq_amount_ranges(c: Company) -> DataFrame:
    return quality.amount_ranges(c.warehouse.sales())


@job
def dq_completeness(c: Company) -> DataFrame:
    s, w = c.staging, c.warehouse
    return quality.completeness(
        {
            "dim_customer": (w.customers, ["customer_id", "company_name", "region", "postal_code", "phone"]),
            "dim_product": (w.products, ["product_name"]),
            "dim_employee": (w.employees, ["title"]),
            "fact_sales": (w.sales(), ["customer_id", "product_id"]),
            "staging_suppliers": (s.suppliers, ["homepage"]),
        }
    )


@job
def dq_temporal(c: Company) -> DataFrame:
    return quality.temporal(c.warehouse.sales(), c.warehouse.calendar)


@job
def dw_kpis(c: Company) -> DataFrame:
    return quality.kpis(c.warehouse.sales(), c.warehouse.calendar)


@job
def dw_monthly_summary(c: Company) -> DataFrame:
    return quality.monthly_summary(c.warehouse.sales(), c.warehouse.calendar)


@job
def dq_score(c: Company) -> DataFrame:
    w = c.warehouse
    return quality.quality_score(w.sales(), w.customers, w.products, w.calendar)


@job
def dq_score_corrected(c: Company) -> DataFrame:
    w = c.warehouse
    return quality.quality_score(w.sales(), w.customers, w.products, w.calendar, corrected=True)


@job
def dq_constraint_gate(c: Company) -> DataFrame:
    return quality.constraint_gate(warehouse_rules(c.staging, c.warehouse, c.mart))


@job
def dq_routed_order_details(c: Company) -> DataFrame:
    """Order lines written as clean and rejected rows, and the rejects of each rule."""
    lines, rules = warehouse_rules(c.staging, c.warehouse, c.mart)["staging_order_details"]
    folder = new_folder(c.staging.spark, "lines")
    return rejects_by_rule(c.staging.spark, folder, route_rows(lines, rules, folder))


# Text quality


@job
def homepage_audit(c: Company) -> DataFrame:
    return text_jobs.homepage_audit(c.staging.suppliers)


@job
def page_url_audit(c: Company) -> DataFrame:
    return text_jobs.page_url_audit(c.staging.raw("pages"))


@job
def phone_standardize(c: Company) -> DataFrame:
    return text_jobs.phone_standardize(c.staging.customers)


@job
def phone_standardize_corrected(c: Company) -> DataFrame:
    return text_jobs.phone_standardize(c.staging.customers, corrected=True)


@job
def postal_classes(c: Company) -> DataFrame:
    return text_jobs.postal_classes(c.staging.customers)


@job
def postal_segments(c: Company) -> DataFrame:
    return text_jobs.postal_segments(c.staging.customers, c.warehouse.sales())


@job
def product_name_gate(c: Company) -> DataFrame:
    return text_jobs.product_name_gate(c.staging.incoming_product_names)
