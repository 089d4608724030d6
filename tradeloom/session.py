"""Session helpers: runtime settings the jobs rely on and the checkpoint folder."""

from __future__ import annotations

import gc
import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    # An overflow fails the job instead of changing a sum.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split hot join keys at run time, also where the split costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app_name: str = "tradeloom", cores: str | int | None = None) -> SparkSession:
    """Local session for tests and the benchmark; a cluster brings its own."""
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "12g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once, for functions that run there in Python."""
    context = spark.sparkContext
    if getattr(context, "_tradeloom_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    # The driver serves the file; executors do not look for this path.
    archive = os.path.join(tempfile.mkdtemp(prefix="tradeloom-"), "tradeloom.zip")
    with zipfile.ZipFile(archive, "w") as file:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    file.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    context._tradeloom_shipped = True


def release_shuffles(spark: SparkSession) -> None:
    """Have Spark remove the shuffle files of jobs that are done. It does so for those that the driver's
    garbage collector finds unused, which may not run for as long as the driver has memory left."""
    gc.collect()
    spark._jvm.System.gc()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; a local folder only in local mode."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="tradeloom-checkpoint-")
    context.setCheckpointDir(named)
