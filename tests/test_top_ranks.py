"""Top ranks against plain windows, and cut points against a plain n-tile, with ties and small samples."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tradeloom.operators.cut_points import add_tiles, cut_points, tile_ends
from tradeloom.operators.top_ranks import range_of, top_of_groups, top_overall

VALUES = {"a_rank": "a", "b_rank": "b"}


def rows_of(seed, size, spread):
    dice = random.Random(seed)
    return [(i, dice.choice([1, 1, 1, 2, 3]), dice.randrange(spread), Decimal(dice.randrange(spread * 3)) / 100) for i in range(size)]


@pytest.mark.parametrize("length", [0, 1, 2, 3, 7, 8, 100])
def test_bisection(frame, length):
    marks = [3 * i for i in range(length)]
    df = frame("v int, marks array<int>", *[(v, marks) for v in range(-2, 3 * length + 2)])
    for row in df.select("v", range_of(F.col("marks"), F.col("v")).alias("found")).collect():
        assert row["found"] == sum(mark < row["v"] for mark in marks)


@pytest.mark.parametrize(("size", "spread"), [(0, 5), (1, 5), (4, 2), (400, 3), (400, 10_000), (300, 1)])
def test_groups_equal_plain_windows(frame, size, spread):
    df = frame("k int, g int, a int, b decimal(15,2)", *rows_of(size + spread, size, spread))
    in_group = Window.partitionBy("g")
    plain = df.withColumns({name: F.rank().over(in_group.orderBy(F.desc(value))).cast("bigint") for name, value in VALUES.items()})
    plain = plain.where((F.col("a_rank") <= 5) | (F.col("b_rank") <= 5))
    found = top_of_groups(df, VALUES, 5, ["g"])
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))


@pytest.mark.parametrize(("size", "spread"), [(0, 5), (1, 5), (4, 2), (400, 3), (400, 10_000), (300, 1)])
def test_overall_equals_plain_windows(frame, size, spread):
    df = frame("k int, g int, a int, b decimal(15,2)", *rows_of(size + spread, size, spread))
    order = [F.desc("b"), F.col("a"), F.col("k")]
    plain = df.withColumns({name: F.rank().over(Window.orderBy(F.desc(value))).cast("bigint") for name, value in VALUES.items()})
    plain = plain.where((F.col("a_rank") <= 5) | (F.col("b_rank") <= 5)).orderBy(*order).limit(7)
    found = top_overall(df, VALUES, 5, order, 7)
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))


@pytest.mark.parametrize("rows", range(0, 23))
def test_tile_ends(rows):
    ends = tile_ends(rows, 5)
    sizes = [b - a for a, b in zip([0, *ends], [*ends, rows])]
    assert sum(sizes) == rows and max(sizes) - min(sizes) <= 1 and sizes == sorted(sizes, reverse=True)


@pytest.mark.parametrize(
    ("size", "spread", "sample"), [(0, 5, 10), (1, 5, 10), (3, 5, 10), (7, 1, 3), (600, 1, 150), (900, 3, 200), (900, 100_000, 200), (500, 7, 20_000)]
)
def test_tiles_equal_plain_ntile(frame, size, spread, sample):
    df = frame("k int, g int, a int, b decimal(15,2)", *rows_of(size + spread, size, spread))
    found = add_tiles(df, {"a_tile": "a", "b_tile": "b"}, "k", 5, sample)
    plain = df.withColumns({f"{v}_tile": F.ntile(5).over(Window.orderBy(v, "k")) for v in ("a", "b")})
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))


def test_cut_points_of_text_keys(frame):
    df = frame("v int, k string", *[(7, f"key {i:03}") for i in range(200)])
    assert cut_points(df, ["v"], "k", 4, 25) == {"v": [(7, "key 049"), (7, "key 099"), (7, "key 149")]}
