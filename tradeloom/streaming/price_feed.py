"""Price audit on a stream of product changes.

Each micro-batch is compared with the products as the previous batch left them, logged, and merged
into them. Products lie by hash bucket of their id. A batch reads the buckets of its changes only, and
writes these as a version of its own; a table of one row per bucket says which version of it counts, and
names the next state once everything else is written. Nothing is replaced in place, so a batch that is
replayed after a failure finds the state before it and replaces its own output only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tradeloom.operators.price_audit import latest_products, price_steps

CHANGE_SCHEMA = (
    "product_id bigint, seq bigint, product_name string, category_id int, unit_price decimal(10,2), "
    "removed boolean, changed_at timestamp_ntz"
)


PRODUCT_SCHEMA = "product_id bigint, product_name string, category_id int, unit_price decimal(10,2)"
BUCKET, VERSION = "key_bucket", "version"
BUCKETS = 256


class PriceFeed:
    def __init__(self, spark: SparkSession, folder: str, user: str, buckets: int = BUCKETS):
        """`folder` is storage that all executors share; `buckets` stays the same for a folder."""
        self.spark = spark
        self.folder = folder
        self.user = user
        self.buckets = buckets

    def start_from(self, products: DataFrame) -> None:
        """State 0. Fails if the folder has one."""
        columns = T.StructType.fromDDL(PRODUCT_SCHEMA).fields
        typed = products.select(*[F.col(column.name).cast(column.dataType).alias(column.name) for column in columns])
        self._write(typed, 0, "errorifexists")
        self._name({bucket: 0 for bucket in range(self.buckets)}, 0)

    def process(self, changes: DataFrame, batch_id: int) -> None:
        versions = self._versions(batch_id)
        hashed = changes.select(self._bucket().alias(BUCKET)).distinct()
        touched = [row[0] for row in hashed.collect()]  # at most one row per bucket
        before = self._read({bucket: versions[bucket] for bucket in touched})
        log = price_steps(before, changes, self.user)
        log.write.mode("overwrite").parquet(f"{self.folder}/log/batch={batch_id}")
        self._write(latest_products(before, changes), batch_id + 1, "overwrite")
        self._name(versions | {bucket: batch_id + 1 for bucket in touched}, batch_id + 1)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col("product_id").cast("bigint")), F.lit(self.buckets)).cast("int")

    def _write(self, products: DataFrame, version: int, mode: str) -> None:
        bucketed = products.withColumn(BUCKET, self._bucket()).repartition(F.col(BUCKET))
        bucketed.write.mode(mode).partitionBy(BUCKET).parquet(f"{self.folder}/products/{VERSION}={version}")

    def _name(self, versions: dict[int, int], state: int) -> None:
        rows = self.spark.createDataFrame(sorted(versions.items()), f"{BUCKET} int, {VERSION} bigint")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/states/state={state}")

    def _versions(self, state: int) -> dict[int, int]:
        """The version of each bucket that counts before batch `state`."""
        return {row[BUCKET]: row[VERSION] for row in self.spark.read.parquet(f"{self.folder}/states/state={state}").collect()}

    def _read(self, versions: dict[int, int]) -> DataFrame:
        """The products of some buckets. A bucket without products has no files."""
        if not versions:
            return self.spark.createDataFrame([], PRODUCT_SCHEMA)
        by_version: dict[int, list[int]] = {}
        for bucket, version in versions.items():
            by_version.setdefault(version, []).append(bucket)
        wanted = F.lit(False)
        for version, buckets in sorted(by_version.items()):
            wanted = wanted | ((F.col(VERSION) == version) & F.col(BUCKET).isin(buckets))
        # Both are partition columns: only files of the wanted buckets are opened.
        schema = f"{PRODUCT_SCHEMA}, {VERSION} bigint, {BUCKET} int"
        paths = [f"{self.folder}/products/{VERSION}={version}" for version in by_version]
        stored = self.spark.read.schema(schema).option("basePath", f"{self.folder}/products").parquet(*paths)
        return stored.where(wanted).drop(VERSION, BUCKET)

    def run(self, changes: DataFrame, checkpoint: str) -> StreamingQuery:
        """Process what is available of a streaming source, then stop."""
        return (
            changes.writeStream.foreachBatch(self.process)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )

    def log(self) -> DataFrame:
        """All log rows so far; `batch` tells which micro-batch wrote them."""
        return self.spark.read.parquet(f"{self.folder}/log")

    def products(self, batches: int) -> DataFrame:
        """Products after the first `batches` micro-batches."""
        return self._read(self._versions(batches))


def read_changes(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """A feed of JSON files as a stream."""
    return spark.readStream.schema(CHANGE_SCHEMA).option("maxFilesPerTrigger", files_per_batch).json(folder)


