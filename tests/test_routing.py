"""Routing by every kind of rule against loops, with hot keys, nulls and repeated rows."""

import random

from conftest import as_dicts

from tradeloom.plans import quality
from tradeloom.plans.routing import clean_rows, marked_rows, rejected_rows, rejects_by_rule, route_rows

SCHEMA = "id int, ref int, name string, n int"


def rules(parent):
    return [
        *quality.required("id"),
        quality.at_most("name", 3),
        quality.within("n", 0, 5),
        quality.UniqueRule("id is unique", ("id",)),
        quality.UniqueRule("name, n are unique", ("name", "n")),
        quality.ReferenceRule("ref exists", "ref", parent, "id"),
    ]


def random_rows(size):
    dice = random.Random(size)
    hot = [(7, 1, "hot", 1)] * (size // 3)
    return hot + [
        (dice.choice([None, dice.randrange(size)]), dice.choice([None, 1, 2, 3]), dice.choice([None, "a", "abc", "abcd"]), dice.choice([None, -1, 0, 5, 6]))
        for _ in range(size - len(hot))
    ]


def test_routed_rows_equal_the_gate(spark, frame, tmp_path):
    parent = frame("id int", (1,), (2,), (2,))
    rows = frame(SCHEMA, *random_rows(600)).repartition(6)
    folder = str(tmp_path / "routed")
    counted = route_rows(rows, rules(parent), folder)
    gate = {row["rule"]: row["violations"] for row in as_dicts(quality.violations("t", rows, rules(parent)))}
    assert counted == gate and gate["id is unique"] > 150
    assert {r["rule"]: (r["violations"], r["stored_rows"]) for r in as_dicts(rejects_by_rule(spark, folder, counted))} == {
        rule: (count, count) for rule, count in gate.items()
    }
    clean, rejected = clean_rows(spark, folder), rejected_rows(spark, folder)
    assert clean.columns == rows.columns and clean.count() + rejected.count() == 600
    assert sorted(map(str, clean.union(rejected.select(*rows.columns)).collect())) == sorted(map(str, rows.collect()))
    assert all(count == 0 for count in (r["violations"] for r in as_dicts(quality.violations("t", clean, rules(parent)))))


def test_each_row_names_what_it_breaks(frame):
    parent = frame("id int", (1,))
    found = {row["n"]: row["broken_rules"] for row in as_dicts(marked_rows(frame(SCHEMA, (1, 1, "a", 1), (None, 9, "abcd", 7), (2, None, None, 2)), rules(parent)))}
    assert found == {1: [], 7: ["id is required", "name has at most 3 characters", "n in 0..5", "ref exists"], 2: []}


def test_without_rows_or_rules(spark, frame, tmp_path):
    parent, empty = frame("id int", (1,)), frame(SCHEMA, (1, 1, "a", 1)).limit(0)
    counted = route_rows(empty, rules(parent), str(tmp_path / "empty"))
    assert set(counted.values()) == {0}
    assert [row["broken_rules"] for row in as_dicts(marked_rows(frame(SCHEMA, (1, 1, "a", 1)), []))] == [[]]
