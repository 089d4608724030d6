"""What the plans of reports read and move, with broadcasts by file size switched off."""

import re

import pytest

from tradeloom.plans.catalog import queries
from tradeloom.sources import staging

DIRECTORY = "/root/testdata/sf0.001"


@pytest.fixture
def plan(spark, monkeypatch):
    """plan(name) as text, as it is before run time, with every sized dimension joined by shuffle."""
    monkeypatch.setattr(staging, "BROADCAST_SOURCE_BYTES", 0)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}

    def make(name):
        df = queries()[name](spark, DIRECTORY)
        for setting, value in settings.items():
            spark.conf.set(setting, value)
        return df._jdf.queryExecution().executedPlan().toString()

    yield make
    for setting, value in before.items():
        spark.conf.set(setting, value)


def scans(text, table):
    return len(re.findall(rf"FileScan parquet .*{table}\.parquet", text))


@pytest.mark.parametrize(("name", "most"), [("dq_orphans", 1), ("dq_score", 1), ("dq_constraint_gate", 3)])
def test_checks_share_a_pass_over_the_lines(plan, name, most):
    assert 1 <= scans(plan(name), "lineitem") <= most


def exchanges_of_lines(text):
    """Keys of the shuffles above the scan of the lines, from the scan upwards."""
    lines = text.split("\n")
    at = next(i for i, line in enumerate(lines) if "FileScan parquet" in line and "lineitem" in line)
    depth, keys = re.search(r"FileScan", lines[at]).start(), []
    for line in reversed(lines[:at]):
        start = re.search(r"[A-Z*(]", line)
        if start and start.start() < depth:
            depth = start.start()
            if found := re.search(r"Exchange hashpartitioning\(([a-z_]+)", line):
                keys.append(found[1])
    return keys


def test_country_and_supplier_cost_the_lines_no_shuffle(plan):
    assert "customer_id" not in exchanges_of_lines(plan("dw_median_sales"))
    assert "supplier_id" not in exchanges_of_lines(plan("mart_supplier_customer_links"))


@pytest.mark.parametrize("name", ["dw_monthly_category_trend", "dw_first_week_sales"])
def test_days_are_chosen_before_lines_are_joined(plan, name):
    sign = r"Filter .*month" if name == "dw_monthly_category_trend" else r"keys=.*functions=\[min\(week_of_year"
    # The calendar is cut once below the lines' join and once where the report looks up its columns.
    assert len(re.findall(sign, plan(name))) >= 2


@pytest.mark.parametrize("name", ["order_analytics_batch_whole_period", "order_analytics_bulk"])
def test_only_lines_of_picked_orders_are_summed(plan, name):
    text = plan(name)
    assert "LeftSemi" in text[: text.index("lineitem.parquet")]


@pytest.mark.parametrize("name", ["dw_top_products_monthly", "dw_top_customers", "dw_rfm_segments"])
def test_ranks_and_tiles_sort_no_rows_across_tasks(spark, monkeypatch, name):
    """The only order across tasks is that of the result."""
    frame = type(spark.range(0))

    def refused(*_, **__):
        raise AssertionError("range-partitioned")

    stored = []
    checkpoint = frame.checkpoint
    monkeypatch.setattr(frame, "repartitionByRange", refused)
    monkeypatch.setattr(frame, "checkpoint", lambda self, *a: stored.append(self) or checkpoint(self, *a))
    text = queries()[name](spark, DIRECTORY)._jdf.queryExecution().executedPlan().toString()
    assert text.count("rangepartitioning") <= 1
    assert len(stored) == 1 and "rangepartitioning" not in stored[0]._jdf.queryExecution().executedPlan().toString()
