"""Rows routed by their table's declared rules in the pass that writes them.

Every row gets the names of all rules it breaks: rules on the row, references to a parent, and unique
keys, of which the first row stays and the others are surplus. Clean and rejected rows go to folders of
one table, and the violations of each rule are counted while the rows are written (`observe`), so that a
load knows its rejects without another pass.

A reference costs a left join with the parent's keys, which Spark splits where a key is hot. A unique key
is looked at in two steps: first among the rows of one task, then among the first rows of all tasks, so
that a key shared by very many rows is not one task's work. Which of them stays follows the order in which
tasks read the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tradeloom.plans.quality import ReferenceRule, RowRule, Rule, with_parent_flags

BROKEN, REJECTED = "broken_rules", "rejected"
_TASK, _IN_TASK, _OVERALL = "_task", "_in_task", "_overall"


def _with_surplus(df: DataFrame, flag: str, columns: Sequence[str]) -> DataFrame:
    """A flag on every row of a key but one."""
    here = Window.partitionBy(*columns, _TASK).orderBy(_TASK)
    numbered = df.withColumn(_TASK, F.spark_partition_id()).withColumn(_IN_TASK, F.row_number().over(here))
    leads = F.when(F.col(_IN_TASK) == 1, -1).otherwise(F.col(_TASK))
    among = Window.partitionBy(*columns, leads).orderBy(_TASK)
    surplus = (F.col(_IN_TASK) > 1) | (F.col(_OVERALL) > 1)
    return numbered.withColumn(_OVERALL, F.row_number().over(among)).withColumn(flag, surplus).drop(_TASK, _IN_TASK, _OVERALL)


def marked_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The rows with `broken_rules`, the names of the rules each breaks, in the order of the rules."""
    columns, broken = df.columns, []
    for at, rule in enumerate(rules):
        flag = f"_broken{at}"
        if isinstance(rule, RowRule):
            holds: Column = ~F.coalesce(rule.holds, F.lit(False))
        elif isinstance(rule, ReferenceRule):
            df = with_parent_flags(df, {flag: (rule.column, rule.parent, rule.parent_column)})
            holds = F.col(rule.column).isNotNull() & F.col(flag)
        else:
            df = _with_surplus(df, flag, rule.columns)
            holds = F.col(flag)
        broken.append(F.when(holds, F.lit(rule.name)))
    found = F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")
    return df.select(*columns, found.alias(BROKEN))


def route_rows(df: DataFrame, rules: Sequence[Rule], folder: str) -> dict[str, int]:
    """Write clean and rejected rows to a new folder; returns the violations of each rule."""
    names = list(dict.fromkeys(rule.name for rule in rules))
    marked = marked_rows(df, rules).withColumn(REJECTED, F.size(BROKEN) > 0)
    seen = Observation("routed rows")
    counts = [F.count_if(F.array_contains(BROKEN, name)).alias(f"rule{at}") for at, name in enumerate(names)]
    marked.observe(seen, F.count("*").alias("rows"), *counts).write.partitionBy(REJECTED).parquet(folder)
    return {name: seen.get[f"rule{at}"] for at, name in enumerate(names)}


def clean_rows(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder).where(F.col(REJECTED) == "false").drop(BROKEN, REJECTED)


def rejected_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The rejected rows with all rules that each breaks."""
    return spark.read.parquet(folder).where(F.col(REJECTED) == "true").drop(REJECTED)


def rejects_by_rule(spark: SparkSession, folder: str, counted: dict[str, int]) -> DataFrame:
    """Per rule the violations that the load counted and the rejected rows that are stored."""
    rules = spark.createDataFrame(list(counted.items()), "rule string, violations bigint")
    rows = rejected_rows(spark, folder).select(F.explode(BROKEN).alias("rule")).groupBy("rule").agg(F.count("*").alias("stored"))
    stored = F.coalesce("stored", F.lit(0)).cast("bigint").alias("stored_rows")
    return F.broadcast(rules).join(rows, "rule", "left").select("rule", "violations", stored)
