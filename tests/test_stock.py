import random
from decimal import Decimal

import pytest
from conftest import by

from tradeloom.operators.stock import apply_moves, rejected_moves, stock_status


def _replay(moves, stock):
    """One move after the other, as a plain loop."""
    result = {}
    level = dict(stock)
    for product, seq, quantity in sorted(moves):
        if not quantity or product not in level:
            continue
        before = level[product]
        level[product] = 0 if before is None else max(0, before + quantity)
        result[(product, seq)] = (before, level[product])
    return result


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_equals_a_loop_with_a_hot_product(spark, frame, coalesce):
    rng = random.Random(11)
    stock = {p: rng.choice([None, 0, 3, 20]) for p in range(8)}
    # Product 0 has most of the moves, so its moves fill several sorted runs.
    moves = [(0 if rng.random() < 0.7 else rng.randrange(8), seq, rng.randint(-9, 9)) for seq in range(900)]
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, coalesce)
    try:
        applied = apply_moves(
            frame("product_id int, seq int, quantity int", *moves),
            frame("product_id int, units_in_stock int", *stock.items()),
        )
        actual = {key: (row["stock_before"], row["stock_after"]) for key, row in by(applied, "product_id", "seq").items()}
    finally:
        spark.conf.set(name, "true")
    assert actual == _replay(moves, stock)


def test_floor_holds_at_every_step(frame):
    moves = frame("product_id int, seq int, quantity int", (1, 1, -10), (1, 2, 4), (1, 3, 0), (1, 4, -1))
    applied = by(apply_moves(moves, frame("product_id int, units_in_stock int", (1, 6))), "seq")
    assert [(s, r["stock_before"], r["stock_after"], r["operation"]) for s, r in sorted(applied.items())] == [
        (1, 6, 0, "STOCK_REDUCTION"),
        (2, 0, 4, "STOCK_ADDITION"),
        (4, 4, 3, "STOCK_REDUCTION"),
    ]


def test_known_example(frame):
    moves = frame("product_id int, seq int, quantity int", (11, 1, 25), (11, 2, -10), (11, 3, 0))
    applied = by(apply_moves(moves, frame("product_id int, units_in_stock int", (11, 22))), "seq")
    assert applied[2]["stock_after"] == 22 + 15
    assert 3 not in applied


def test_rejected_moves(frame):
    moves = frame("product_id int, seq int, quantity int", (1, 1, None), (9, 2, 5), (9, 3, 0), (1, 4, 2), (9, 5, None))
    products = frame("product_id int, units_in_stock int", (1, 6))
    reasons = {key: row["reason"] for key, row in by(rejected_moves(moves, products), "seq").items()}
    assert reasons == {1: "quantity is null", 2: "product not found", 5: "product not found"}
    assert set(by(apply_moves(moves, products), "seq")) == {4}


def test_stock_status(frame):
    schema = "product_id int, product_name string, units_in_stock int, reorder_level int, unit_price decimal(10,2)"
    rows = by(stock_status(frame(schema, (1, "a", 10, 10, Decimal("2.50")), (2, "b", 11, 10, Decimal("1.00")))), "product_id")
    assert rows[1]["stock_status"] == "REORDER NEEDED"
    assert rows[1]["stock_value"] == Decimal("25.00")
    assert rows[2]["stock_status"] == "STOCK OK"
