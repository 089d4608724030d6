"""Writing and reading the stored warehouse. A version is written once, to a new folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, folder: str, partition_by: str | None = None) -> str:
    """Write Parquet to a folder that must not exist, so no job overwrites what it reads."""
    if partition_by is None:
        df.write.mode("errorifexists").parquet(folder)
        return folder
    # One task per partition value would be a hot task; let AQE split and merge by size instead.
    df.hint("rebalance", partition_by).write.mode("errorifexists").partitionBy(partition_by).parquet(folder)
    return folder


def write_fact(fact: DataFrame, folder: str) -> str:
    """Store the sales fact by order year, with a surrogate key that is unique but not dense."""
    keyed = fact.withColumn("sales_id", F.monotonically_increasing_id())
    return write_table(keyed, folder, "order_year")


def append_log(log: DataFrame, folder: str) -> None:
    """Append audit rows, partitioned by day."""
    day = log.withColumn("log_day", F.col("updated_at").cast("date"))
    day.write.mode("append").partitionBy("log_day").parquet(folder)


def read_table(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder)
