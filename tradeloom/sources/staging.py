"""Staging tables of the trading company, derived from the raw tables by column expressions.

The raw tables have no employees, shippers, stock, freight, phones, postal codes or home pages. Those
columns are computed from keys, so they are the same on every run, and columns nobody fills are null
literals of their declared type. Every table here grows with the raw table it reads.
"""

from __future__ import annotations

from datetime import date
from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.sources.raw import file_bytes, read_table

CENT = Decimal("0.01")
# A table is broadcast when the Parquet files it comes from are no larger than this, and a lookup also
# when it has no more rows than this.
BROADCAST_SOURCE_BYTES = 32 * 1024 * 1024
BROADCAST_LOOKUP_ROWS = 100_000

# One order line in so many is spoilt, in each of five ways.
SPOILT_EVERY = 997

# Lookup tables and the raw table each is drawn from.
LOOKUP_SOURCES = {"categories": "part", "shippers": "orders", "employees": "events"}


def _missing(name: str, kind: str = "string") -> Column:
    return F.lit(None).cast(kind).alias(name)


def _key_text(key: str) -> Column:
    return F.col(key).cast("string")


class Staging:
    """Lazy staging tables over one directory of raw Parquet tables."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory
        self._raw: dict[str, DataFrame] = {}
        self._bytes: dict[str, int] = {}
        self._few_rows: dict[str, bool] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = read_table(self.spark, self.directory, name)
        return self._raw[name]

    def _size(self, name: str) -> int:
        if name not in self._bytes:
            self._bytes[name] = file_bytes(self.raw(name))
        return self._bytes[name]

    def sized(self, df: DataFrame, *sources: str) -> DataFrame:
        """`df` marked for broadcast if the raw tables it is made of are small, else `df` as it is.

        The check matters because Spark multiplies the sizes of joined tables in its estimates, and so
        takes a dimension built by a join for the larger side. Beyond the limit Spark shuffles both
        sides and splits hot keys at run time.
        """
        return F.broadcast(df) if self._from_small_files(*sources) else df

    def _from_small_files(self, *sources: str) -> bool:
        return sum(self._size(source) for source in sources) <= BROADCAST_SOURCE_BYTES

    def pieces(self, most_bytes: int, *sources: str) -> int:
        """The number of pieces of at most so many bytes that the files of the raw tables make."""
        return max(1, -(-sum(self._size(source) for source in sources) // most_bytes))

    def lookup(self, df: DataFrame, name: str) -> DataFrame:
        """`df` marked for broadcast if the lookup table it extends is small.

        Categories, shippers and employees are few rows drawn from large tables, so when the files are
        large the rows are counted, up to the limit and once per staging area. Joining lines to a few
        categories by shuffle would put every line of a category in one place.
        """
        if name not in self._few_rows:
            self._few_rows[name] = self._from_small_files(LOOKUP_SOURCES[name]) or (
                getattr(self, f"_{name}").limit(BROADCAST_LOOKUP_ROWS + 1).count() <= BROADCAST_LOOKUP_ROWS
            )
        return F.broadcast(df) if self._few_rows[name] else df

    @cached_property
    def customers(self) -> DataFrame:
        key, text = F.col("c_custkey"), _key_text("c_custkey")
        five_digits = F.lpad(text, 5, "0")
        # Every eleventh region is null, postal codes and phones cover each recognised shape.
        region = F.when(key % 11 == 0, None).otherwise(F.concat(F.lit("R"), (key % 3).cast("string")))
        postal = (
            F.when(key % 7 == 0, five_digits)
            .when(key % 7 == 1, F.concat(five_digits, F.lit("-1234")))
            .when(key % 7 == 2, "123-456")
            .when(key % 7 == 3, "k1a 0b1")
            .when(key % 7 == 4, "SW1A 1AA")
            .when(key % 7 == 5, "   ")
        )
        phone = (
            F.when(
                key % 4 == 0,
                F.concat(
                    F.lit("("), F.lpad(((key * 37) % 1000).cast("string"), 3, "0"), F.lit(") 555-"),
                    F.lpad((key % 10000).cast("string"), 4, "0"),
                ),
            )
            .when(key % 4 == 1, F.concat(F.lit("+49 30 "), F.lpad(text, 9, "1")))
            .when(key % 4 == 2, F.concat(F.lit("0921-12 "), (key % 10).cast("string")))
        )
        customer = self.raw("customer")
        nation = self.sized(self.raw("nation"), "nation")
        return customer.join(nation, customer.c_nationkey == F.col("n_nationkey")).select(
            key.alias("customer_id"),
            F.col("c_name").alias("company_name"),
            F.concat(F.lit("Contact "), text).alias("contact_name"),
            _missing("contact_title"),
            _missing("address"),
            F.concat(F.lit("City_"), (key % 40).cast("string")).alias("city"),
            region.alias("region"),
            postal.alias("postal_code"),
            F.col("n_name").alias("country"),
            phone.alias("phone"),
            _missing("fax"),
        )

    @cached_property
    def suppliers(self) -> DataFrame:
        key, text = F.col("s_suppkey"), _key_text("s_suppkey")
        site = F.concat(F.lit("http://www.s"), text, F.lit(".example/"))
        homepage = F.when(key % 4 == 0, None).when(key % 4 == 1, F.concat(site, F.lit("(shop)"))).otherwise(site)
        supplier = self.raw("supplier")
        nation = self.sized(self.raw("nation"), "nation")
        return supplier.join(nation, supplier.s_nationkey == F.col("n_nationkey")).select(
            key.alias("supplier_id"),
            F.col("s_name").alias("company_name"),
            F.concat(F.lit("Agent "), text).alias("contact_name"),
            _missing("contact_title"),
            _missing("address"),
            F.concat(F.lit("City_"), (key % 40).cast("string")).alias("city"),
            _missing("region"),
            _missing("postal_code"),
            F.col("n_name").alias("country"),
            _missing("phone"),
            _missing("fax"),
            homepage.alias("homepage"),
        )

    @cached_property
    def categories(self) -> DataFrame:
        return self.lookup(self._categories, "categories")

    @cached_property
    def _categories(self) -> DataFrame:
        """Part types numbered by name. The window sees distinct types only, a handful of rows."""
        types = self.raw("part").select("p_type").distinct()
        return types.selectExpr(
            "cast(row_number() over (order by p_type) as int) as category_id",
            "p_type as category_name",
            "cast(null as string) as description",
        )

    @cached_property
    def products(self) -> DataFrame:
        key = F.col("p_partkey")
        supplier_count = self.raw("supplier").agg(F.count("*")).scalar()
        return (
            self.raw("part")
            .join(self.categories, F.col("p_type") == F.col("category_name"))
            .select(
                key.alias("product_id"),
                F.col("p_name").alias("product_name"),
                (key % supplier_count).alias("supplier_id"),
                F.col("category_id"),
                F.concat(F.col("p_size").cast("string"), F.lit(" units")).alias("quantity_per_unit"),
                F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"),
                ((key * 37) % 2000).cast("int").alias("units_in_stock"),
                ((key * 3) % 40).cast("int").alias("units_on_order"),
                ((key % 6) * 100).cast("int").alias("reorder_level"),
                (key % 10 == 0).alias("discontinued"),
            )
        )

    @cached_property
    def employees(self) -> DataFrame:
        return self.lookup(self._employees, "employees")

    @cached_property
    def _employees(self) -> DataFrame:
        """One employee per user of the event log; the first event stands for the hire date."""
        user, text = F.col("user_id"), _key_text("user_id")
        return (
            self.raw("events")
            .groupBy("user_id")
            .agg(F.min("ts").cast("date").alias("hire_date"))
            .select(
                user.alias("employee_id"),
                F.concat(F.lit("Last_"), text).alias("last_name"),
                F.concat(F.lit("First_"), (user % 20).cast("string")).alias("first_name"),
                F.when(user % 13 == 0, None).otherwise("Sales Representative").alias("title"),
                _missing("title_of_courtesy"),
                _missing("birth_date", "date"),
                "hire_date",
                _missing("address"),
                _missing("city"),
                _missing("region"),
                _missing("postal_code"),
                _missing("country"),
                _missing("home_phone"),
                _missing("extension"),
                _missing("reports_to", "bigint"),
            )
        )

    @cached_property
    def shippers(self) -> DataFrame:
        return self.lookup(self._shippers, "shippers")

    @cached_property
    def _shippers(self) -> DataFrame:
        """One shipper per order priority, such as `5-LOW`."""
        return (
            self.raw("orders")
            .select("o_orderpriority")
            .distinct()
            .select(
                F.substring("o_orderpriority", 1, 1).cast("int").alias("shipper_id"),
                F.substring("o_orderpriority", 3, 40).alias("company_name"),
                F.concat(F.lit("555-000"), F.substring("o_orderpriority", 1, 1)).alias("phone"),
            )
        )

    def orders_between(self, period: tuple[date, date] | None = None) -> DataFrame:
        """Orders; a period filters the raw timestamp, so it reaches the Parquet scan."""
        raw = self.raw("orders")
        if period is not None:
            first, last = period
            end = date.fromordinal(last.toordinal() + 1)
            raw = raw.filter((F.col("o_orderdate") >= F.lit(first)) & (F.col("o_orderdate") < F.lit(end)))
        key = F.col("o_orderkey")
        employee_count = self.raw("events").agg(F.countDistinct("user_id")).scalar()
        return raw.select(
            key.alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            (key % employee_count).alias("employee_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            _missing("required_date", "date"),
            _missing("shipped_date", "date"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("ship_via"),
            (key % 500 + 5).cast("decimal(10,2)").alias("freight"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        return self.orders_between()

    @cached_property
    def order_details(self) -> DataFrame:
        """Order lines; the unit price is the line's value over its quantity, in whole cents.

        A few lines are spoilt, chosen by their keys: no quantity, no discount, a discount above one, an
        unknown product, an unknown order. Loads must reject them and checks must count them.
        """
        cents = F.rint(F.col("l_extendedprice") * 100).cast("bigint")
        quantity = F.col("l_quantity").cast("int")
        unit_cents = F.call_function("div", 2 * cents + quantity, F.nullif(2 * quantity, F.lit(0)))
        order, product = F.col("l_orderkey"), F.col("l_partkey")
        kind = (order * 7 + product * 3 + F.col("l_linenumber")) % SPOILT_EVERY
        percent = F.when(kind == 3, 110).when(kind != 2, F.rint(F.col("l_discount") * 100).cast("int"))
        return self.raw("lineitem").select(
            F.when(kind == 5, -1 - order).otherwise(order).alias("order_id"),
            F.when(kind == 4, -1 - product).otherwise(product).alias("product_id"),
            (unit_cents * F.lit(CENT)).cast("decimal(10,2)").alias("unit_price"),
            F.when(kind == 1, 0).otherwise(quantity).alias("quantity"),
            (percent * F.lit(CENT)).cast("decimal(3,2)").alias("discount"),
        )

    # Feeds of the operational jobs.

    @cached_property
    def stock_moves(self) -> DataFrame:
        """Ordered stock moves from the event log, over all products and a few unknown ones."""
        key = F.col("event_id")
        moved = F.when(key % 211 != 7, F.floor("value").cast("int") % 41 - 20)
        return self.raw("events").select(key.alias("seq"), self._moved_product.alias("product_id"), moved.alias("quantity"))

    @property
    def _moved_product(self) -> Column:
        """Every third event is about one of ten products, the others are spread over all of them."""
        key = F.col("event_id")
        known = self.raw("part").agg(F.count("*")).scalar()
        return F.when(key % 3 == 0, key % 10).otherwise(key % (known + 3))

    @cached_property
    def price_feed(self) -> DataFrame:
        """Ordered price changes from the event log; an error event removes the product."""
        price = (F.rint(F.col("value") * 100).cast("bigint") * F.lit(CENT)).cast("decimal(10,2)")
        return self.raw("events").select(
            self._moved_product.alias("product_id"),
            F.col("event_id").alias("seq"),
            F.concat(F.lit("after "), F.col("event_type")).alias("product_name"),
            F.lit(None).cast("int").alias("category_id"),
            price.alias("unit_price"),
            (F.col("event_type") == "error").alias("removed"),
            F.col("ts").alias("changed_at"),
        )

    @cached_property
    def products_after(self) -> DataFrame:
        """A later product snapshot: raised prices, removed products and new ones."""
        key, price = F.col("product_id"), F.col("unit_price")
        changed = F.when(key % 10 == 3, price * F.lit(1.15).cast("decimal(3,2)")).when(
            key % 10 == 4, price + F.lit(0.5).cast("decimal(3,2)")
        ).otherwise(price)
        kept = self.products.filter(key % 50 != 7).withColumn("unit_price", changed.cast("decimal(10,2)"))
        added = (
            self.products.filter(key % 100 == 9)
            .withColumn("product_name", F.concat("product_name", F.lit(" new")))
            .withColumn("product_id", key + 1 + self.raw("part").agg(F.max("p_partkey")).scalar())
        )
        return kept.unionByName(added)

    @cached_property
    def incoming_product_names(self) -> DataFrame:
        """Product names as typed: capitalised, padded, cut short or missing, by part size."""
        name, size = F.col("p_name"), F.col("p_size")
        capital = F.concat(F.upper(F.substring(name, 1, 1)), F.expr("substring(p_name, 2)"))
        typed = (
            F.when(size == 50, None)
            .when(size % 4 == 0, capital)
            .when(size % 4 == 1, name)
            .when(size % 4 == 2, F.concat(F.lit("   "), capital, F.lit("  ")))
            .otherwise(F.substring(capital, 1, 6))
        )
        return self.raw("part").select(F.col("p_partkey").alias("product_id"), typed.alias("product_name"))
