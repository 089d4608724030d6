"""Exact n-tiles by selecting cut points instead of sorting.

A tile is told by the cut points below a row: the keys (value, unique key) at the last position of every
tile but the last. Several orders are cut at once, over one stored copy of the narrow rows:

1. A bounded sample of rows that may still hold a cut point is sorted on the driver. The rows are those
   with the smallest hash of their key, so the sample is uniform and the same on every run.
2. If all such rows fit the sample, the cut points are read off it.
3. Otherwise the sample gives two keys around each open cut point, close enough to leave about one row in
   SAMPLE_ROWS ** 0.5 between them. One pass counts the rows up to each of them exactly, which proves on
   which side the cut point lies, and step 1 repeats with the rows in between.

Values shared by very many rows do no harm: the unique key orders them. A sampled row is never one whose
place is known, so each round narrows a bracket. With
the default sample a billion rows take three counting passes. Only samples, counts and cut points cross
the driver; the tile of a row is a comparison with a handful of literals.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 20_000
# A bracket reaches so many standard deviations of the sample rank to either side.
REACH = 4.0


@dataclass
class _Cut:
    """What is known about one cut point: until its key is found, it lies between `low` and `high`."""

    position: int
    low: tuple | None = None  # keys that are not it; None: no bound
    high: tuple | None = None
    below: int = 0  # rows up to `low`
    before: int = 0  # rows before `high`
    key: tuple | None = None
    tried: list[tuple] = field(default_factory=list)

    def place(self, key: tuple, upto: int) -> None:
        """Take in that `upto` rows are not above `key`."""
        if upto == self.position:
            self.key = key
        elif upto < self.position and upto > self.below:
            self.low, self.below = key, upto
        elif upto > self.position and upto - 1 < self.before:
            self.high, self.before = key, upto - 1


def tile_ends(rows: int, buckets: int) -> list[int]:
    """Last position of every tile but the last; the first rows % buckets tiles have one row more."""
    small, larger = divmod(rows, buckets)
    return [tile * small + min(tile, larger) for tile in range(1, buckets)]


def _row_key(value: str, unique: str) -> Column:
    return F.struct(F.col(value), F.col(unique))


def _literal(df: DataFrame, value: str, unique: str, key: tuple) -> Column:
    kinds = dict(df.dtypes)
    return F.struct(F.lit(key[0]).cast(kinds[value]).alias(value), F.lit(key[1]).cast(kinds[unique]).alias(unique))


def _inside(df: DataFrame, value: str, unique: str, cut: _Cut) -> Column:
    row, inside = _row_key(value, unique), F.lit(True)
    if cut.low is not None:
        inside = inside & (row > _literal(df, value, unique, cut.low))
    if cut.high is not None:
        inside = inside & (row < _literal(df, value, unique, cut.high))
    return inside


def cut_points(df: DataFrame, values: Sequence[str], unique: str, buckets: int, sample_rows: int = SAMPLE_ROWS) -> dict[str, list[tuple]]:
    """Per value column, the (value, key) at the last position of every tile but the last, ascending.

    `df` should be stored: it is read two times per round. Values and keys must not be null. A position
    of zero (fewer rows than tiles) has no cut point and is left out.
    """
    rows = df.count()
    cuts = {value: [_Cut(position, before=rows) for position in tile_ends(rows, buckets) if position] for value in values}
    order = F.xxhash64(unique)
    while any(cut.key is None for open_cuts in cuts.values() for cut in open_cuts):
        unsettled = {value: [cut for cut in found if cut.key is None] for value, found in cuts.items()}
        may_hold = F.lit(False)
        for value, found in unsettled.items():
            for low, high in {(cut.low, cut.high) for cut in found}:
                may_hold = may_hold | _inside(df, value, unique, _Cut(0, low, high))
        sample = df.where(may_hold).orderBy(order, unique).limit(sample_rows).select(*values, unique).collect()
        whole = len(sample) < sample_rows
        marks: list[tuple[str, tuple]] = []
        for value, found in unsettled.items():
            keys = sorted((row[value], row[unique]) for row in sample)
            for cut in found:
                first = bisect_right(keys, cut.low) if cut.low is not None else 0
                last = bisect_left(keys, cut.high) if cut.high is not None else len(keys)
                inside = keys[first:last]
                if whole or len(inside) == cut.before - cut.below:
                    cut.key = inside[cut.position - cut.below - 1]
                    continue
                share = (cut.position - cut.below) / (cut.before - cut.below)
                middle = share * len(inside)
                reach = REACH * sqrt(max(len(inside) * share * (1 - share), 1.0)) + 1
                places = {max(0, int(middle - reach)), min(len(inside) - 1, int(middle + reach))} if inside else set()
                cut.tried = [inside[place] for place in sorted(places)]
                marks.extend((value, key) for key in cut.tried)
        marks = sorted(set(marks), key=str)
        if marks:
            counts = df.agg(*[
                F.count_if(_row_key(value, unique) <= _literal(df, value, unique, key)).alias(f"n{at}") for at, (value, key) in enumerate(marks)
            ]).first()
            upto = dict(zip(marks, counts, strict=True))
            for value, found in unsettled.items():
                for cut in found:
                    for key in cut.tried if cut.key is None else ():
                        cut.place(key, upto[value, key])
    return {value: [cut.key for cut in found] for value, found in cuts.items()}


def add_tiles(
    df: DataFrame, tiles: Mapping[str, str], unique: str, buckets: int, sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """SQL NTILE over the whole frame by each value ascending and then the key; `tiles` names the columns."""
    cuts = cut_points(df, list(tiles.values()), unique, buckets, sample_rows)

    def tile(value: str) -> Column:
        row, found = _row_key(value, unique), F.lit(1)
        for key in cuts[value]:
            found = found + (row > _literal(df, value, unique, key)).cast("int")
        return found

    return df.withColumns({name: tile(value) for name, value in tiles.items()})
