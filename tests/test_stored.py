"""The stored warehouse: one load for all reports, keys that last, upserts that touch few files, logs by run."""

import glob
import os
from datetime import date

import pytest
from conftest import as_dicts, by
from pyspark.sql import functions as F

from tradeloom.operators.upsert import upsert
from tradeloom.plans import catalog, quality, sales_reports
from tradeloom.plans.catalog import Company
from tradeloom.plans.stored import SALES_KEY, StoredWarehouse, load_warehouse
from tradeloom.sources.stored import LOAD, load_fact, numbered, read_dimension, read_fact, save_dimension, upsert_dimension, write_run

DIRECTORY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("stored") / "warehouse")
    company = Company(spark, DIRECTORY)
    load_warehouse(company.warehouse, folder, "first")
    return StoredWarehouse(spark, folder, company.warehouse.days)


REPORT_NAMES = [name for name in catalog.queries() if name.startswith("dw_") and not name.startswith("dw_stored")]


@pytest.mark.parametrize("name", [*REPORT_NAMES, "dq_score_corrected", "dq_orphans", "postal_segments"])
def test_reports_from_the_folder_equal_queries(spark, stored, name):
    lazy, reading = Company(spark, DIRECTORY), Company(spark, DIRECTORY)
    reading.warehouse = stored
    expected = catalog._JOBS[name](lazy)
    columns = [c for c in expected.columns]
    found = catalog._JOBS[name](reading).select(*columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_years_are_pruned(spark, stored):
    def plan(report):
        return report._jdf.queryExecution().executedPlan().toString()

    year = stored.sales((date(1997, 1, 1), date(1997, 12, 31)))
    weekly = sales_reports.weekly_category_sales(year, stored.calendar, stored.categories)
    assert "PartitionFilters: [isnotnull(order_year" in plan(weekly)
    some_days = stored.calendar.where(F.col("date").between(date(1996, 1, 5), date(1996, 2, 10)))
    assert "dynamicpruning" in plan(quality.temporal(stored.sales(days=some_days), stored.calendar))


def test_keys_go_on_and_stay(spark, tmp_path):
    folder = str(tmp_path / "fact")
    rows = spark.range(1000).withColumn("year", (F.col("id") % 3).cast("int")).repartition(7)
    load_fact(rows, folder, "a", SALES_KEY, "year")
    before = by(read_fact(spark, folder), "id")
    assert sorted(row[SALES_KEY] for row in before.values()) == list(range(1, 1001))
    assert spark.read.parquet(f"{folder}/{LOAD}=a").columns[0] == SALES_KEY
    later = spark.range(1000, 1500).withColumn("year", F.lit(5))
    for _ in range(2):  # the run again replaces what it stored
        load_fact(later, folder, "b", SALES_KEY, "year")
        after = by(read_fact(spark, folder), "id")
        assert len(after) == 1500 and all(after[i][SALES_KEY] == row[SALES_KEY] for i, row in before.items())
        assert sorted(row[SALES_KEY] for i, row in after.items() if i >= 1000) == list(range(1001, 1501))
    load_fact(rows.limit(0), folder, "c", SALES_KEY, "year")
    assert read_fact(spark, folder).count() == 1500


def test_numbers_without_rows(spark):
    assert numbered(spark.range(0), "n", 5).columns == ["n", "id"]
    assert as_dicts(numbered(spark.range(1), "n", 5)) == [{"n": 6, "id": 0}]


def files(folder):
    return {path: (os.path.getmtime(path), os.path.getsize(path)) for path in glob.glob(f"{folder}/*/*.parquet")}


def test_upsert_leaves_other_buckets_alone(spark, frame, tmp_path):
    folder = str(tmp_path / "dimension")
    save_dimension(spark.range(500).select("id", F.lit("old").alias("name"), F.lit(1).alias("kept")), folder, ["id"], 16)
    before = files(folder)
    updates = frame("id bigint, name string", (3, "new"), (900, "new"))

    def merge(stored, fresh):
        return upsert(stored, fresh, ["id"], ["name"], {"kept": F.lit(0)})

    touched = upsert_dimension(spark, folder, updates, ["id"], merge, 16)
    after = files(folder)
    assert 1 <= len(touched) <= 2
    same = {path for path in before if after.get(path) == before[path]}
    assert len(same) == len(before) - len({path for path in before if any(f"={b}/" in path for b in touched)}) >= 14
    rows = by(read_dimension(spark, folder), "id")
    assert len(rows) == 501 and rows[3] == {"id": 3, "name": "new", "kept": 1} and rows[900]["kept"] == 0
    assert upsert_dimension(spark, folder, updates.limit(0), ["id"], merge, 16) == []
    assert files(folder) == after


def test_a_run_twice_leaves_one_set_of_rows(spark, frame, tmp_path):
    folder = str(tmp_path / "log")
    for run, rows in (("monday", [(1,), (2,)]), ("tuesday", [(3,)]), ("monday", [(1,), (2,)])):
        write_run(frame("a int", *rows), folder, run)
    assert sorted((row["a"], row[LOAD]) for row in as_dicts(read_fact(spark, folder))) == [(1, "monday"), (2, "monday"), (3, "tuesday")]


