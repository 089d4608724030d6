from datetime import date

from conftest import as_dicts, d

from tradeloom.functions.calendar import warehouse_calendar
from tradeloom.operators.price_audit import price_changes
from tradeloom.plans.catalog import RUN_AT, Company
from tradeloom.plans.sales_reports import weekly_category_sales
from tradeloom.sources import staging
from tradeloom.sources.sinks import append_log, read_table, write_fact, write_table

DIRECTORY = "/root/testdata/sf0.001"


def test_stored_fact_gives_the_same_report_and_prunes_years(spark, tmp_path):
    warehouse = Company(spark, DIRECTORY).warehouse
    lazy = warehouse.sales((date(1997, 1, 1), date(1997, 12, 31)))
    stored = read_table(spark, write_fact(warehouse.sales(), str(tmp_path / "fact")))
    assert stored.count() == warehouse.sales().count()
    assert stored.select("sales_id").distinct().count() == stored.count()
    reports = [weekly_category_sales(fact, warehouse_calendar(spark), warehouse.categories) for fact in (lazy, stored)]
    assert as_dicts(reports[0]) == as_dicts(reports[1])
    plan = reports[1]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_year" in plan


def test_log_is_appended(spark, frame, tmp_path):
    schema = "product_id int, product_name string, category_id int, unit_price decimal(10,2)"
    log = price_changes(frame(schema, (1, "a", 1, d("1"))), frame(schema, (1, "a", 1, d("2"))), "me", RUN_AT)
    folder = str(tmp_path / "log")
    append_log(log, folder)
    append_log(log, folder)
    assert read_table(spark, folder).count() == 2


def test_a_table_is_never_overwritten(frame, tmp_path):
    import pytest

    folder = write_table(frame("a int", (1,)), str(tmp_path / "t"))
    with pytest.raises(Exception, match="(?i)already exists"):
        write_table(frame("a int", (1,)), folder)


def test_broadcast_only_small_sources(spark, monkeypatch):
    def joins(limit_bytes, limit_rows):
        monkeypatch.setattr(staging, "BROADCAST_SOURCE_BYTES", limit_bytes)
        monkeypatch.setattr(staging, "BROADCAST_LOOKUP_ROWS", limit_rows)
        area = staging.Staging(spark, DIRECTORY)
        hints = [area.sized(area.raw("part"), "part"), area.categories]
        return ["ResolvedHint" in df._jdf.queryExecution().analyzed().toString() for df in hints]

    assert joins(1 << 20, 0) == [True, True]
    assert joins(1, 1000) == [False, True]
    assert joins(1, 3) == [False, False]


def test_results_do_not_depend_on_broadcasts(spark, monkeypatch):
    names = ["dw_monthly_category_trend", "mart_sales_dashboard", "mart_customer_geography"]
    from tradeloom.plans.catalog import queries

    small = {name: sorted(map(str, as_dicts(queries()[name](spark, DIRECTORY)))) for name in names}
    monkeypatch.setattr(staging, "BROADCAST_SOURCE_BYTES", 0)
    monkeypatch.setattr(staging, "BROADCAST_LOOKUP_ROWS", 0)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        for name in names:
            assert sorted(map(str, as_dicts(queries()[name](spark, DIRECTORY)))) == small[name]
    finally:
        spark.conf.set(threshold, before)
