"""Versioned dimension rows: a new version when a tracked attribute changes."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.calendar import OPEN_END
from tradeloom.operators.upsert import require_unique

VERSION_COLUMNS = ["is_current", "valid_from", "valid_to"]


def add_versions(
    dimension: DataFrame, snapshot: DataFrame, key: str, tracked: Sequence[str], as_of: date
) -> DataFrame:
    """Merge a snapshot into a versioned dimension on the day `as_of`.

    A changed row closes the open version on the day before and opens a new one; a second change on
    the same day replaces the version opened that day. Keys missing from the snapshot stay open.
    Versions are closed intervals, the open one ends 9999-12-31.
    """
    columns = [name for name in dimension.columns if name not in VERSION_COLUMNS]
    closed = dimension.filter(~F.col("is_current"))
    current = dimension.filter("is_current").select(key, F.struct(*dimension.columns).alias("old"))
    incoming = require_unique(snapshot.select(*columns), [key]).select(key, F.struct(*columns).alias("new"))

    same = F.lit(True)
    for name in tracked:
        same = same & F.col(f"old.{name}").eqNullSafe(F.col(f"new.{name}"))
    stays = F.col("new").isNull() | (F.col("old").isNotNull() & same)
    same_day = F.col("old.valid_from") == F.lit(as_of)

    def version(row: str, is_current: bool, valid_from, valid_to):
        return F.struct(
            *[F.col(f"{row}.{name}").alias(name) for name in columns],
            F.lit(is_current).alias("is_current"),
            valid_from.alias("valid_from"),
            valid_to.alias("valid_to"),
        )

    kept = version("old", True, F.col("old.valid_from"), F.col("old.valid_to"))
    ended = version("old", False, F.col("old.valid_from"), F.lit(as_of - timedelta(days=1)))
    opened = version("new", True, F.lit(as_of), F.lit(OPEN_END))
    versions = (
        F.when(stays, F.array(kept))
        .when(F.col("old").isNull() | same_day, F.array(opened))
        .otherwise(F.array(ended, opened))
    )
    merged = current.join(incoming, key, "full_outer").select(F.inline(versions))
    return closed.select(*columns, *VERSION_COLUMNS).unionByName(merged).select(*dimension.columns)
