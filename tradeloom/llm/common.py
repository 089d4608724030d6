"""What several operators share: fixed text rules, packed rows, shared storage, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.session import ensure_checkpoint_dir

# The white space that ends a word, and the letters that count as upper case.
SPACES = "\t\n\x0b\x0c\r "
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = "[^\x20\x09-\x0d]+"
LOWER_BYTES = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())
ROW = "_row"
BATCH_ROWS = 1000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage in the folder that spark.checkpoint.dir names."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def small_batches(spark: SparkSession) -> None:
    """Hand at most BATCH_ROWS rows to Python at once; Spark's default of 10,000 long texts, held by the
    JVM and by each worker, fills an executor. A session that has set fewer keeps its setting."""
    if int(spark.conf.get(_BATCH_SETTING)) > BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))


class SharedFolder:
    """A new folder below the checkpoint folder, for tables that several steps read."""

    def __init__(self, spark: SparkSession, name: str):
        ensure_checkpoint_dir(spark)
        self.spark = spark
        self.path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"

    def delete(self, part: str = "") -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{part}" if part else self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """Each row as one struct beside the columns an operator works on, so that no name can clash."""
    small_batches(df.sparkSession)
    return df.select(F.struct(*[F.col(f"`{name}`") for name in df.columns]).alias(ROW), *[
        column.alias(name) for name, column in columns.items()
    ])


def unpacked(df: DataFrame, columns: list[str], results: Mapping[str, Column]) -> DataFrame:
    """The packed columns with the results, which replace input columns of the same name."""
    kept = [F.col(ROW).getField(name).alias(name) for name in columns if name not in results]
    new = [column.alias(name) for name, column in results.items()]
    return df.select(*kept, *new)


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(a, b) links of long ids to (node, component): the smallest id that a node reaches.

    Alternates between two steps until nothing changes: every larger neighbour of a node is tied to
    the smallest one, then every smaller neighbour is. Both are an aggregate and a join, so that a
    node with very many links is split like any hot join key. Links with a null end are ignored.
    """
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = checkpointed(links.where(F.col("a") > F.col("b")).distinct())
    state = _fingerprint(links)
    for _ in range(rounds):
        if state[0] == 0:
            break
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        tied = both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = checkpointed(tied.where("a > b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        tied = small.select("a", F.col("m").alias("b")).union(
            small.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        links = checkpointed(tied.distinct())
        before, state = state, _fingerprint(links)
        if before == state:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _fingerprint(links: DataFrame) -> tuple[int, int]:
    """Number and hash of the links, to see that a round changed nothing."""
    spread = F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31))
    found = links.agg(F.count("*"), F.coalesce(F.sum(spread.cast("decimal(38,0)")), F.lit(0))).first()
    return found[0], int(found[1])
