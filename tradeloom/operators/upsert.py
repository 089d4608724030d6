"""Upsert by key, as one full outer join from DataFrame to DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows; the job fails when two of them share a key. Shuffles on the keys only."""
    columns = [name for name in df.columns if name not in keys]
    message = F.lit(f"duplicate key in {', '.join(keys)}: a row would be written twice")
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("_copies"), F.first(F.struct(*columns)).alias("_row"))
        .select(
            *keys,
            F.when(F.col("_copies") > 1, F.raise_error(message)).otherwise(F.col("_row")).alias("_row"),
        )
        .select(*keys, *[F.col(f"_row.{name}").alias(name) for name in columns])
    )


def upsert(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str],
    defaults: Mapping[str, Column] | None = None,
    generated: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Insert new keys; on a match take only `update_columns` from `updates`.

    New rows take `defaults` for columns the updates lack. `generated` columns are recomputed on every
    row. Target and updates are both keyed, so the join has no hot key and one shuffle per side.
    """
    defaults, generated = dict(defaults or {}), dict(generated or {})
    incoming = set(updates.columns)
    stored = target.withColumn("_stored", F.lit(True)).alias("t")
    fresh = require_unique(updates, keys).withColumn("_fresh", F.lit(True)).alias("u")
    joined = stored.join(fresh, [F.col(f"t.{key}") == F.col(f"u.{key}") for key in keys], "full_outer")

    def column(name: str) -> Column:
        if name in keys:
            return F.coalesce(f"t.{name}", f"u.{name}")
        new = F.col(f"u.{name}") if name in incoming else defaults.get(name, F.lit(None))
        if name in update_columns:
            return F.when(F.col("u._fresh"), new).otherwise(F.col(f"t.{name}"))
        return F.when(F.col("t._stored"), F.col(f"t.{name}")).otherwise(new)

    plain = [name for name in target.columns if name not in generated]
    merged = joined.select(*[column(name).alias(name) for name in plain])
    return merged.withColumns(generated).select(*target.columns) if generated else merged
