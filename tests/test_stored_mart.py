"""The stored mart: loads that add up, periods that stay untouched, repeated loads, reports from the folder."""

import glob
import os
from datetime import date

import pytest
from conftest import by
from pyspark.sql import functions as F

from tradeloom.plans import catalog
from tradeloom.plans.catalog import AS_OF, Company
from tradeloom.plans.mart import DataMart
from tradeloom.plans.stored_mart import PERIOD, SALES_KEY, StoredMart
from tradeloom.sources.stored import LOAD, merge_parts, read_kept

DIRECTORY = "/root/testdata/sf0.001"
REPORTS = [
    "mart_fact_sales", "mart_fact_supplier_purchases", "mart_fact_product_sales", "mart_fact_customer_sales",
    "mart_supplier_scorecard", "mart_supplier_monthly_trend", "mart_product_dashboard", "mart_customer_ltv",
    "mart_customer_geography", "mart_sales_dashboard", "mart_sales_trend", "mart_employee_performance",
    "mart_category_deep_dive", "mart_supplier_customer_links_two_orders", "mart_row_counts",
]


@pytest.fixture(scope="module")
def loaded(spark):
    return Company(spark, DIRECTORY).stored_mart


@pytest.mark.parametrize("name", REPORTS)
def test_two_loads_equal_none(spark, loaded, name):
    lazy, reading = Company(spark, DIRECTORY), Company(spark, DIRECTORY)
    reading.mart = loaded
    expected = catalog._JOBS[name](lazy)
    found = catalog._JOBS[name](reading)
    assert found.columns == expected.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_keys_are_dense(loaded):
    rows = loaded.stored_sales.select(SALES_KEY, LOAD).collect()
    assert sorted(row[0] for row in rows) == list(range(1, len(rows) + 1))
    assert {row[1] for row in rows} == {"1-early", "2-late"}


def _files(folder: str) -> dict[str, float]:
    found = glob.glob(f"{folder}/*_days/kept/**/*.parquet", recursive=True)
    return {path: os.stat(path).st_mtime_ns for path in found}


@pytest.mark.parametrize("unit", ["month", "day"])
def test_only_touched_periods_are_rewritten(spark, tmp_path, unit):
    days = (date(1996, 1, 1), date(1996, 3, 31))
    staging = Company(spark, DIRECTORY).staging
    mart = StoredMart(staging, AS_OF, str(tmp_path / "mart"), days, unit)
    late = F.col("order_date") == F.lit(date(1996, 2, 7))

    def load(arrived, run):
        return mart.load(DataMart(staging, AS_OF, days, arrived), run)

    load(~late, "a")
    before = _files(mart.folder)
    touched = load(late, "b")
    period = 199602 if unit == "month" else 38
    assert touched == {"product_days": [period], "customer_days": [period]}
    after = _files(mart.folder)
    kept = {path: when for path, when in before.items() if f"{PERIOD}={period}/" not in path}
    assert kept and all(after[path] == when for path, when in kept.items())
    expected = DataMart(staging, AS_OF, days)
    for name in ("product_sales", "customer_sales", "supplier_purchases"):
        assert sorted(map(str, getattr(mart, name).collect())) == sorted(map(str, getattr(expected, name).collect()))


COLUMNS = "k int, units bigint, period int"


def _merge(parts):
    return parts.groupBy("k", "period").agg(F.sum("units").alias("units"))


def test_repeated_loads(spark, frame, tmp_path):
    folder = str(tmp_path / "sums")

    def load(run, *rows):
        return merge_parts(frame(COLUMNS, *rows), folder, run, "period", _merge)

    def sums():
        rows = by(read_kept(spark, folder, frame(COLUMNS).schema), "k", "period")
        return {key: row["units"] for key, row in rows.items()}

    assert load("a") == [] and sums() == {}
    assert load("a", (1, 5, 10), (2, 6, 10), (1, 7, 11)) == [10, 11]
    assert load("b", (1, 1, 10), (None, 2, 12)) == [10, 12]
    assert sums() == {(1, 10): 6, (2, 10): 6, (1, 11): 7, (None, 12): 2}
    load("b", (1, 1, 10), (None, 2, 12))
    assert sums() == {(1, 10): 6, (2, 10): 6, (1, 11): 7, (None, 12): 2}
    # Other rows at the repetition: a period of the first try loses them, another is left empty.
    assert load("b", (3, 9, 11)) == [10, 11, 12]
    assert sums() == {(1, 10): 5, (2, 10): 6, (1, 11): 7, (3, 11): 9}
    load("b")
    assert sums() == {(1, 10): 5, (2, 10): 6, (1, 11): 7}


def test_a_failure_between_parts_and_sums(spark, frame, tmp_path):
    folder = str(tmp_path / "sums")
    merge_parts(frame(COLUMNS, (1, 5, 10), (1, 6, 11)), folder, "a", "period", _merge)

    def fail(parts):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        merge_parts(frame(COLUMNS, (1, 8, 12)), folder, "a", "period", fail)
    merge_parts(frame(COLUMNS, (1, 8, 12)), folder, "a", "period", _merge)
    assert {key: row["units"] for key, row in by(read_kept(spark, folder, frame(COLUMNS).schema), "period").items()} == {12: 8}
