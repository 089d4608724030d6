from datetime import date

import pytest
from conftest import as_dicts, by
from pyspark.sql import functions as F

from tradeloom.functions.calendar import OPEN_END
from tradeloom.operators.upsert import upsert
from tradeloom.operators.versions import add_versions
from tradeloom.plans.mart import first_load, upsert_dimension

DAY1, DAY2, DAY3 = date(2001, 1, 1), date(2001, 2, 1), date(2001, 3, 1)


def test_upsert_touches_only_listed_columns(frame):
    target = frame("id int, name string, phone string, segment string", (1, "a", "1", "Gold"), (2, "b", "2", None))
    updates = frame("id int, name string, phone string", (2, "B", "22"), (3, None, "3"))
    merged = upsert(target, updates, ["id"], ["name"], {"segment": F.lit("Standard")})
    assert by(merged, "id") == {
        1: {"id": 1, "name": "a", "phone": "1", "segment": "Gold"},
        2: {"id": 2, "name": "B", "phone": "2", "segment": None},
        3: {"id": 3, "name": None, "phone": "3", "segment": "Standard"},
    }
    assert by(upsert(merged, updates, ["id"], ["name"], {"segment": F.lit("Standard")}), "id") == by(merged, "id")


def test_update_to_null(frame):
    merged = upsert(frame("id int, name string", (1, "a")), frame("id int, name string", (1, None)), ["id"], ["name"])
    assert as_dicts(merged) == [{"id": 1, "name": None}]


def test_duplicate_updates_fail(frame):
    target, updates = frame("id int, name string", (1, "a")), frame("id int, name string", (2, "x"), (2, "y"))
    with pytest.raises(Exception, match="duplicate key"):
        upsert(target, updates, ["id"], ["name"]).collect()


def test_employee_full_name_is_regenerated(frame):
    names = ["employee_id", "last_name", "first_name", "title", "title_of_courtesy", "birth_date", "hire_date", "address",
             "city", "region", "postal_code", "country", "home_phone", "reports_to"]
    schema = ", ".join(f"{name} {'int' if name == 'employee_id' else 'string'}" for name in names)
    filler = (None,) * 10
    stored = first_load("employee", frame(schema, (1, "Old", "Ann", None, *filler)), DAY1)
    staged = frame(schema, (1, "New", "Ann", "Lead", *filler), (2, "Two", "Bob", None, *filler))
    rows = by(upsert_dimension("employee", stored, staged, DAY2), "employee_id")
    assert rows[1]["full_name"] == "Ann New"
    assert rows[1]["valid_from"] == DAY1
    assert rows[2]["full_name"] == "Bob Two"
    assert rows[2]["valid_from"] == DAY2
    assert rows[2]["valid_to"] == OPEN_END


SCHEMA = "id int, price int, note string"


@pytest.fixture
def history(frame):
    loaded = frame(SCHEMA, (1, 10, "x"), (2, None, "x"), (3, 30, "x"))
    empty = loaded.filter("false").select(
        "*", F.lit(True).alias("is_current"), F.lit(DAY1).alias("valid_from"), F.lit(OPEN_END).alias("valid_to")
    )
    return add_versions(empty, loaded, "id", ["price"], DAY1)


def test_versions(frame, history):
    # 1 is unchanged but for an untracked note, 2 goes from null to a value, 3 is missing, 4 is new.
    second = add_versions(history, frame(SCHEMA, (1, 10, "y"), (2, 20, "x"), (4, 40, "x")), "id", ["price"], DAY2)
    rows = by(second, "id", "valid_from")
    assert set(rows) == {(1, DAY1), (2, DAY1), (2, DAY2), (3, DAY1), (4, DAY2)}
    assert rows[(1, DAY1)]["note"] == "x"
    assert rows[(2, DAY1)]["valid_to"] == date(2001, 1, 31)
    assert not rows[(2, DAY1)]["is_current"]
    assert rows[(2, DAY2)]["price"] == 20
    assert rows[(3, DAY1)]["is_current"]
    assert rows[(3, DAY1)]["valid_to"] == OPEN_END


def test_second_change_on_one_day_replaces_the_version(frame, history):
    twice = add_versions(
        add_versions(history, frame(SCHEMA, (1, 11, "x")), "id", ["price"], DAY2), frame(SCHEMA, (1, 12, "x")), "id", ["price"], DAY2
    )
    rows = by(twice.filter("id = 1"), "valid_from")
    assert {day: row["price"] for day, row in rows.items()} == {DAY1: 10, DAY2: 12}


def test_intervals_never_overlap(frame, history):
    result = history
    for day, price in ((DAY2, 11), (DAY3, 12), (date(2001, 3, 2), 12), (date(2001, 3, 3), 10)):
        result = add_versions(result, frame(SCHEMA, (1, price, "x")), "id", ["price"], day)
    rows = sorted(as_dicts(result.filter("id = 1")), key=lambda row: row["valid_from"])
    assert [row["price"] for row in rows] == [10, 11, 12, 10]
    assert sum(row["is_current"] for row in rows) == 1
    for earlier, later in zip(rows, rows[1:], strict=False):
        assert (later["valid_from"] - earlier["valid_to"]).days == 1
