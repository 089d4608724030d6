"""Tables that outlive a job: facts stored by load and year, dimensions stored by key bucket.

*Facts.* Each load is a folder of its own, named by its run, with one folder per year below it. A run that
is repeated replaces its own folder and nothing else. Surrogate keys are dense and go on where the other
loads end: the rows to load are staged once as Parquet, so their places are fixed; the number of rows of
each file, one small number each, gives it a range of keys, and a row's key is its range's start plus its
place in the file. Nothing is sorted and nothing is numbered by one task. A large load comes in slices,
one after the other: only one slice at a time has shuffle files and a staged copy on disk.

*Dimensions.* A row lies in the folder of its key's hash bucket. An upsert finds the buckets of the new
rows, reads only these, and replaces only these; files of the other buckets stay as they are.

*Kept aggregates.* Sums that add up over loads are stored twice: each load's parts by run, and the sums of
all parts by period. A load stores its parts, then adds up the parts of the periods it touches and
replaces only these, some of them at a time. The parts are the truth, so a load that is repeated, with the
same rows or others, gives what one load would have given, also after a failure between two steps.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.session import ensure_checkpoint_dir, release_shuffles

LOAD, BUCKET = "load_run", "key_bucket"
BUCKETS = 64
MERGE_ROWS = 32_000_000  # parts that are added up at once, unless one period has more
_COMPACT = {"compression": "zstd"}  # two thirds of the space of the default


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own in the shared folder that the cluster names for checkpoints."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def numbered(df: DataFrame, name: str, after: int = 0) -> DataFrame:
    """The rows with a dense key from `after` + 1 on as first column."""
    return _numbered(df, name, after, new_folder(df.sparkSession, "staged"))[0]


def _numbered(df: DataFrame, name: str, after: int, folder: str, partition_by: str | None = None) -> tuple[DataFrame, int]:
    """The same, staged in a folder, and the highest key."""
    spark = df.sparkSession
    _write(df, folder, "errorifexists", partition_by)
    staged = spark.read.schema(df.schema).parquet(folder)
    file, place = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    start, starts = after, []
    for path, count in sorted(map(tuple, staged.groupBy(file).agg(F.count("*")).collect())):  # one row per file
        starts.append((path, start))
        start += count
    ranges = F.broadcast(spark.createDataFrame(starts, "_file string, _start bigint"))
    placed = staged.select(*df.columns, file.alias("_path"), place.alias("_place"))
    key = (F.col("_start") + F.col("_place") + 1).alias(name)
    return placed.join(ranges, F.col("_path") == F.col("_file")).select(key, *df.columns), start


def highest_key(spark: SparkSession, folder: str, key: str, but_run: str) -> int:
    """The highest key of the other loads; Parquet footers answer it."""
    if not exists(spark, folder):
        return 0
    others = read_fact(spark, folder).where(F.col(LOAD) != but_run)
    return others.agg(F.max(key)).first()[0] or 0


def exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def load_fact(
    rows: DataFrame | Sequence[DataFrame], folder: str, run: str, key: str, partition_by: str | None = None
) -> None:
    """Store the rows of one load, or its slices one after the other, with surrogate keys. The same run
    again replaces what it stored, also after a failure between two slices."""
    slices = [rows] if isinstance(rows, DataFrame) else rows
    spark = slices[0].sparkSession
    last = highest_key(spark, folder, key, run)
    for number, part in enumerate(slices):
        staged = new_folder(spark, "staged")
        try:
            keyed, last = _numbered(part, key, last, staged, partition_by)
            release_shuffles(spark)
            writer = keyed.write.mode("append" if number else "overwrite").options(**_COMPACT)
            (writer.partitionBy(partition_by) if partition_by else writer).parquet(f"{folder}/{LOAD}={run}")
        finally:
            _delete(spark, staged)


def _write(rows: DataFrame, folder: str, mode: str, partition_by: str | None, order: Sequence[str] = ()) -> None:
    """Write rows by period, or as they are. Spark splits large periods and merges small files by size, so
    no period is one task; rows that are sorted on the way take less space."""
    if partition_by:
        rows = rows.hint("rebalance", partition_by)
        rows = rows.sortWithinPartitions(partition_by, *order) if order else rows
    writer = rows.write.mode(mode).options(**_COMPACT)
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(folder)


def read_fact(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.option("basePath", folder).parquet(folder)


def write_run(rows: DataFrame, folder: str, run: str) -> None:
    """An append-only log: what a run found is one folder, and the same run again replaces it."""
    rows.write.mode("overwrite").parquet(f"{folder}/{LOAD}={run}")


def _periods(spark: SparkSession, folder: str, period: str) -> set[int]:
    """The distinct periods of a stored folder; only file footers are read."""
    if not exists(spark, folder):
        return set()
    return {row[0] for row in spark.read.schema(f"{period} int").parquet(folder).select(period).distinct().collect()}


def merge_parts(
    parts: DataFrame | Sequence[DataFrame],
    folder: str,
    run: str,
    period: str,
    merge: Callable[[DataFrame], DataFrame],
    order: Sequence[str] = (),
) -> list[int]:
    """Add a load's parts, or those of its slices, to a kept aggregate; returns the periods that it rewrote.

    `period` is an int column of the parts, one folder each; `merge` adds up parts of one grain, the period
    included; `order` is how rows lie in a file. The number of periods is bounded by the calendar; only they
    cross the driver. Loads of one folder must not run at the same time.
    """
    slices = [parts] if isinstance(parts, DataFrame) else parts
    spark, schema = slices[0].sparkSession, slices[0].schema
    mine, journal, kept = f"{folder}/parts/{LOAD}={run}", f"{folder}/touched/{LOAD}={run}", f"{folder}/kept"
    # Noted before the parts are replaced: a failure must not hide periods that an earlier try had filled.
    before = _periods(spark, journal, period) | _periods(spark, mine, period)
    spark.createDataFrame([(p,) for p in sorted(before)], f"{period} int").coalesce(1).write.mode("overwrite").parquet(journal)
    for number, part in enumerate(slices):
        _write(part, mine, "append" if number else "overwrite", period, order)
        release_shuffles(spark)
    touched = sorted(before | _periods(spark, mine, period))
    everything = spark.read.schema(schema).option("basePath", f"{folder}/parts").parquet(f"{folder}/parts")
    sizes = dict(map(tuple, everything.groupBy(period).agg(F.count("*")).collect()))
    for some in _packs(touched, sizes, MERGE_ROWS):
        sums = merge(everything.where(F.col(period).isin(some))).hint("rebalance", period)
        sums = sums.sortWithinPartitions(period, *order) if order else sums
        writer = sums.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**_COMPACT)
        writer.partitionBy(period).parquet(kept)
        release_shuffles(spark)
    # A period that has lost all its rows is not written, so its old folder would stay.
    for gone in before - _periods(spark, f"{folder}/parts", period):
        _delete(spark, f"{kept}/{period}={gone}")
    return touched


def _packs(periods: Sequence[int], sizes: dict[int, int], most: int) -> list[list[int]]:
    """The periods in packs of at most `most` rows, or of one period; one empty pack if there are none."""
    packs: list[list[int]] = [[]]
    rows = 0
    for period in periods:
        rows += sizes.get(period, 0)
        if packs[-1] and rows > most:
            packs.append([])
            rows = sizes.get(period, 0)
        packs[-1].append(period)
    return packs


def read_kept(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The sums over all loads; the schema is stated, as there may be no rows yet."""
    return spark.read.schema(schema).parquet(f"{folder}/kept")


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _bucketed(df: DataFrame, key: Sequence[str], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))


def save_dimension(df: DataFrame, folder: str, key: Sequence[str], buckets: int = BUCKETS) -> None:
    """Store a dimension by bucket of its key, one file per bucket."""
    _write_buckets(_bucketed(df, key, buckets), folder, "errorifexists")


def _write_buckets(bucketed: DataFrame, folder: str, mode: str) -> None:
    # Keys are spread by hash, so buckets are of one size.
    dealt = bucketed.repartition(F.col(BUCKET))
    dealt.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(folder)


def read_dimension(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder).drop(BUCKET)


def upsert_dimension(
    spark: SparkSession,
    folder: str,
    updates: DataFrame,
    key: Sequence[str],
    merge: Callable[[DataFrame, DataFrame], DataFrame],
    buckets: int = BUCKETS,
) -> list[int]:
    """Merge new rows into a stored dimension, `merge(stored, updates)`; returns the buckets it rewrote.

    `buckets` must be the number that the dimension was saved with. At most that many numbers cross the
    driver.
    """
    fresh = _bucketed(updates, key, buckets)
    touched = sorted(row[0] for row in fresh.select(BUCKET).distinct().collect())
    if touched:
        stored = spark.read.parquet(folder).where(F.col(BUCKET).isin(touched)).drop(BUCKET)
        merged = _bucketed(merge(stored, updates), key, buckets)
        # Read before anything is replaced: the new files take the old ones' place when the job commits.
        _write_buckets(merged.select(*stored.columns, BUCKET), folder, "overwrite")
    return touched
