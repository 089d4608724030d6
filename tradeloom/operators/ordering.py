"""Global ranks, row numbers and n-tiles without moving all rows to one task.

A window without a partition key sorts everything in a single task, and so does a window whose
partition is one huge group. Here the rows are range-partitioned on the full sort order, ties broken
by a unique key, so that no value, however frequent, can fill a partition. Each sorted partition is a
*run*. All that has to cross runs is one row per run: its size and its first and last key. These rows,
no more than there are shuffle partitions, are summed up on the driver and joined back.

The sorted rows are checkpointed, because run numbers must be the same for every later reader. That is
the only pass over the rows that is stored: range partitioning samples its input first, but what the
input has shuffled is there by then, and the number of rows is the sum of the run sizes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tradeloom.session import ensure_checkpoint_dir

RUN, ROW = "_run", "_row"
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number of a partition in its low 33 bits


def sorted_runs(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Rows sorted across partitions, with the run number and the row number inside the run."""
    slot = F.monotonically_increasing_id()
    return (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", slot)
        .withColumns({RUN: F.shiftright("_slot", _ROW_BITS), ROW: F.col("_slot").bitwiseAND((1 << _ROW_BITS) - 1)})
        .drop("_slot")
    )


def checkpointed(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def _with_run_columns(runs: DataFrame, rows: list[tuple], *columns: str) -> DataFrame:
    """Join one small row per run; an empty frame has no runs and stays empty."""
    schema = pa.schema([(name, pa.int64()) for name in (RUN, *columns)])
    table = pa.Table.from_pylist([dict(zip(schema.names, row, strict=True)) for row in rows], schema)
    return runs.join(F.broadcast(runs.sparkSession.createDataFrame(table)), RUN)


def _positions(df: DataFrame, order: Sequence[Column | str]) -> tuple[DataFrame, Column, int]:
    """Sorted rows, the 1-based position of a row, and the number of rows."""
    runs = checkpointed(sorted_runs(df, order))
    offsets, total = [], 0
    for run, size in runs.groupBy(RUN).agg(F.count("*")).orderBy(RUN).collect():  # one row per run
        offsets.append((run, total))
        total += size
    placed = _with_run_columns(runs, offsets, "_offset")
    return placed, F.col("_offset") + F.col(ROW) + 1, total


def add_row_number(df: DataFrame, name: str, order: Sequence[Column | str]) -> DataFrame:
    """SQL ROW_NUMBER over the whole frame; `order` must end with a unique key."""
    placed, position, _ = _positions(df, order)
    return placed.select(*df.columns, position.alias(name))


def add_ntiles(df: DataFrame, orders: Mapping[str, Sequence[Column | str]], buckets: int) -> DataFrame:
    """SQL NTILE over the whole frame, one column per order; each order must end with a unique key."""
    for name, order in orders.items():
        placed, position, rows = _positions(df, order)
        # The first (rows mod buckets) buckets get one row more.
        small, larger = divmod(rows, buckets)
        in_larger = larger * (small + 1)
        first = F.call_function("div", position - 1, F.lit(small + 1)) + 1
        rest = F.call_function("div", position - 1 - in_larger, F.lit(max(small, 1))) + larger + 1
        tile = F.when(position <= in_larger, first).otherwise(rest).cast("int")
        df = placed.select(*df.columns, tile.alias(name))
    return df


def add_ranks(
    df: DataFrame, values: Mapping[str, str], unique_key: Sequence[str], partition_by: Sequence[str] = ()
) -> DataFrame:
    """SQL RANK by each value descending, over everything or inside each `partition_by` group."""
    for name, value in values.items():
        df = _add_rank(df, name, value, unique_key, partition_by)
    return df


def _add_rank(
    df: DataFrame, name: str, value: str, unique_key: Sequence[str], partition_by: Sequence[str]
) -> DataFrame:
    """The rank of a row is the position of the first row with its value, counted from the first row
    of its group. Windows over single runs find both, except for what continues from an earlier run.
    """
    group, tie = list(partition_by), [*partition_by, value]
    in_run = Window.partitionBy(RUN)
    # Both windows use the same shuffle and the same sort.
    ranked = sorted_runs(df, [*group, F.desc(value), *unique_key]).withColumn(
        "_tie", F.rank().over(in_run.orderBy(*group, F.desc(value)))
    )
    ranked = ranked.withColumn("_group", F.rank().over(in_run.orderBy(*group)) if group else F.lit(1))
    runs = checkpointed(ranked)

    last = F.max_by(F.struct(*tie, "_tie", "_group"), ROW)
    ends = runs.groupBy(RUN).agg(F.count("*"), F.min_by(F.struct(*tie), ROW), last).orderBy(RUN).collect()
    placed = _with_run_columns(runs, _run_starts(ends, len(group)), "_offset", "_tie_start", "_group_start")

    def begins(local_rank: str, earlier: str) -> Column:
        """Rank 1 in a run marks the run's first tie or group, which an earlier run may have begun."""
        here = F.col("_offset") + F.col(local_rank)
        return F.when(F.col(local_rank) == 1, F.coalesce(earlier, here)).otherwise(here)

    rank = begins("_tie", "_tie_start") - (begins("_group", "_group_start") if group else F.lit(1)) + 1
    return placed.select(*df.columns, rank.cast("bigint").alias(name))


def _run_starts(ends: list[Row], group_size: int) -> list[tuple]:
    """Per run, in order: its offset, and the position where its first tie and first group began if an
    earlier run began them."""
    starts = []
    offset, open_tie, open_group = 0, (None, None), (None, None)
    for run, size, first, last in ends:
        first_tie, last_tie = tuple(first), tuple(last)[:-2]
        first_group, last_group = first_tie[:group_size], last_tie[:group_size]
        tie_start = open_tie[1] if open_tie[0] == first_tie else None
        group_start = open_group[1] if open_group[0] == first_group else None
        starts.append((run, offset, tie_start, group_start))
        # What the run's last row belongs to stays open for the next run.
        if not (tie_start and last_tie == first_tie):
            open_tie = (last_tie, offset + last["_tie"])
        if not (group_start and last_group == first_group):
            open_group = (last_group, offset + last["_group"])
        offset += size
    return starts
