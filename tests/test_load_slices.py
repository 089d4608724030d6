"""Loads in slices: the same facts as in one piece, and nothing but the facts left on disk."""

import os
import time
from datetime import date

from pyspark.sql import functions as F

from tradeloom.plans import stored_mart
from tradeloom.plans.catalog import AS_OF, Company
from tradeloom.plans.mart import DataMart
from tradeloom.plans.stored_mart import SALES_KEY, StoredMart
from tradeloom.session import ensure_checkpoint_dir
from tradeloom.sources import stored
from tradeloom.sources.stored import LOAD, load_fact, read_fact

DIRECTORY = "/root/testdata/sf0.001"
DAYS = (date(1996, 1, 1), date(1996, 3, 31))


def _shuffled_bytes(spark) -> int:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return sum(os.path.getsize(path) for path in files.split("\n") if "shuffle_" in path and os.path.exists(path))


def test_a_load_leaves_only_its_rows_on_disk(spark, tmp_path):
    ensure_checkpoint_dir(spark)
    shared = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    folder, there, before = str(tmp_path / "fact"), set(os.listdir(shared)), _shuffled_bytes(spark)
    rows = spark.range(200_000).groupBy(F.xxhash64("id").alias("id")).agg((F.max("id") % 3).cast("int").alias("year"))
    load_fact(rows, folder, "a", "n", "year")
    assert set(os.listdir(shared)) <= there
    load_fact([rows.where("id < -9e17"), rows.where("false"), rows.where("id >= -9e17")], folder, "b", "n", "year")
    found = read_fact(spark, folder).where(F.col(LOAD) == "b")
    assert found.agg(F.min("n"), F.max("n"), F.countDistinct("n"), F.countDistinct("id")).first() == (200_001, 400_000, 200_000, 200_000)
    stored.merge_parts(rows, str(tmp_path / "sums"), "a", "year", lambda parts: parts.groupBy("id", "year").agg(F.count("*").alias("k")))
    until = time.time() + 30  # Spark removes the files in the background
    while _shuffled_bytes(spark) > before + 500_000 and time.time() < until:
        time.sleep(0.2)
    assert _shuffled_bytes(spark) <= before + 500_000


def test_slices_equal_one_load(spark, tmp_path, monkeypatch):
    pieces, staging = 2, Company(spark, DIRECTORY).staging
    size = staging._size("orders") + staging._size("lineitem")
    monkeypatch.setattr(stored_mart, "SLICE_BYTES", -(-size // pieces))
    monkeypatch.setattr(stored, "MERGE_ROWS", 100)  # several packs of periods
    mart = StoredMart(staging, AS_OF, str(tmp_path / "mart"), DAYS)
    late = F.col("order_id") % 3 == 0
    for arrived, run in ((~late, "a"), (late, "b"), (late, "b")):
        load = DataMart(staging, AS_OF, DAYS, arrived)
        assert len(load.slices(stored_mart.SLICE_BYTES)) == pieces
        assert mart.load(load, run) == {"product_days": [199601, 199602, 199603], "customer_days": [199601, 199602, 199603]}
    keys = [row[0] for row in mart.stored_sales.select(SALES_KEY).collect()]
    assert sorted(keys) == list(range(1, len(keys) + 1))
    lazy = DataMart(staging, AS_OF, DAYS)
    for name in ("sales", "product_sales", "customer_sales", "supplier_purchases"):
        expected = sorted(map(str, getattr(lazy, name).collect()))
        assert expected and sorted(map(str, getattr(mart, name).collect())) == expected


def test_packs_hold_every_period_once():
    sizes = {1: 5, 2: 5, 3: 30, 4: 1}
    assert stored._packs([1, 2, 3, 4, 9], sizes, 10) == [[1, 2], [3], [4, 9]]
    assert stored._packs([], sizes, 10) == [[]]
