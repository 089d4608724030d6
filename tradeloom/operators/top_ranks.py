"""The rows that rank at the top by any of several values, with their exact rank by every value.

No row is sorted across tasks. A row has a rank of at most k just when its value is at least the k-th
largest one, so the first step finds that one value: each map task hands on its k first rows of a group,
whatever ties there are. Rows that reach one of the values are the result. Their rank by another value can
be anything, so it is counted: the values asked for, called marks, cut the number line into ranges, every
row adds one to its range, and a running sum over the ranges tells how many rows lie above each mark.
Ranges are found by bisection, so many ties make the list of marks longer but not the work per row.

The frame is read several times and should be stored: one narrow copy of an aggregate costs less than
building it anew, or planning it anew, for each reading. Values must not be null.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LEAST, _MARKS, _RANGE, _ABOVE = "_least_{}", "_marks_{}", "_range_{}", "_above_{}"


def range_of(marks: Column, value: Column) -> Column:
    """How many of the sorted `marks` are less than `value`, by bisection."""

    def halve(state: Column, _: Column) -> Column:
        low, high = state["low"], state["high"]
        middle = F.shiftright(low + high, 1)
        below = F.get(marks, middle) < value
        narrowed = F.struct(
            F.when(below, middle + 1).otherwise(low).alias("low"), F.when(below, high).otherwise(middle).alias("high")
        )
        return F.when(low < high, narrowed).otherwise(state)

    # One step more than halvings until one mark is left; a step without a range changes nothing.
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(marks) + 1)).cast("int"))
    start = F.struct(F.lit(0).alias("low"), F.size(marks).alias("high"))
    return F.aggregate(steps, start, halve, lambda state: state["low"])


def _rows_above(ranged: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Per group and range of a value, the number of rows in higher ranges."""
    name = _RANGE.format(value)
    per_range = ranged.groupBy(*group, name).agg(F.count("*").alias("_n"))
    higher = Window.partitionBy(*group).orderBy(F.desc(name)).rowsBetween(Window.unboundedPreceding, -1)
    return per_range.select(*group, name, F.coalesce(F.sum("_n").over(higher), F.lit(0)).alias(_ABOVE.format(value)))


def top_of_groups(df: DataFrame, values: Mapping[str, str], top: int, group: Sequence[str]) -> DataFrame:
    """Rows of a group whose rank by one of the values, largest first, is at most `top`.

    `values` names a rank column for each value column. Groups are few and may be large, like months: there
    is one row of marks per group, and no task has to hold a group.
    """
    keys = list(group)
    reached = reduce(Column.__or__, [F.col(value) >= F.col(_LEAST.format(value)) for value in values.values()])
    least: DataFrame | None = None
    for value in values.values():
        first = Window.partitionBy(*keys).orderBy(F.desc(value))
        leading = df.select(*keys, value).withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= top)
        found = leading.groupBy(*keys).agg(F.min(value).alias(_LEAST.format(value)))
        least = found if least is None else least.join(found, keys)
    kept = df.join(least, keys).where(reached)
    marks = [F.sort_array(F.collect_set(value)).alias(_MARKS.format(value)) for value in values.values()]
    limits = [F.min(_LEAST.format(value)).alias(_LEAST.format(value)) for value in values.values()]
    ranges = {_RANGE.format(value): range_of(F.col(_MARKS.format(value)), F.col(value)) for value in values.values()}
    ranged = df.join(kept.groupBy(*keys).agg(*limits, *marks), keys).withColumns(ranges)
    result = ranged.where(reached)
    for value in values.values():
        result = result.join(_rows_above(ranged, keys, value), [*keys, _RANGE.format(value)])
    ranks = [(F.col(_ABOVE.format(value)) + 1).cast("bigint").alias(name) for name, value in values.items()]
    return result.select(*df.columns, *ranks)


def top_overall(df: DataFrame, values: Mapping[str, str], top: int, best_first: Sequence[Column], limit: int) -> DataFrame:
    """The `limit` best rows, in the order `best_first`, among those that rank at most `top` by a value.

    `top` values and the values of `limit` rows cross the driver, and one count for each of these.
    """
    names = list(values.values())
    leading = {value: df.select(value).orderBy(F.desc(value)).limit(top).collect() for value in names}
    kinds = dict(df.dtypes)

    def literal(value: str, found) -> Column:
        return F.lit(found).cast(kinds[value])

    reached = [F.col(value) >= literal(value, rows[-1][0]) for value, rows in leading.items() if rows]
    best = df.where(reduce(Column.__or__, reached, F.lit(False))).orderBy(*best_first).limit(limit)
    marks = sorted({(value, row[value]) for row in best.select(*names).collect() for value in names})
    counts = [F.count_if(F.col(value) > literal(value, mark)).alias(f"n{at}") for at, (value, mark) in enumerate(marks)]
    above = dict(zip(marks, df.agg(*counts).first() if marks else (), strict=True))

    def rank(value: str) -> Column:
        pairs = [x for (of, mark), rows in above.items() if of == value for x in (literal(value, mark), F.lit(rows + 1))]
        return (F.create_map(*pairs)[F.col(value)] if pairs else F.lit(None)).cast("bigint")

    return best.withColumns({name: rank(value) for name, value in values.items()})
