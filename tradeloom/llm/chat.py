"""Chat formatting by collapse of cumulative snapshots, in DataFrame operations only.

A logged conversation is often stored again after each turn. Every turn gets the hash of the
conversation up to it: a rolling exclusive-or of hashes of (position, role, text), twice 64 bits. A
conversation whose last such hash is found before the end of another one is a prefix of it. An
anti-join drops these; of equal conversations the one with the smallest id stays. What stays is
rendered turn by turn.

Both sides of the anti-join are made distinct first, so a first turn or a whole conversation that a
third of the log shares is one row. Only a conversation's own turns meet in a task, and its rendering
is one string anyway.

Defined cases: exactly repeated rows count once; turns are ordered by turn (nulls first), role and
text, so ties are whole and in order; a null role is `unknown`, a null text is empty; rows without an
id form one conversation with a null id; markers inside a text are broken up by a space; other columns
are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.common import checkpointed

# The markers around a turn.
START, END = "<|im_start|>", "<|im_end|>"
NO_ROLE = "unknown"


def numbered_turns(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv_id, pos, role, text, a, b, is_last): a and b are the rolling hash up to the turn."""
    rows = turns.select(
        F.col(f"`{conv_col}`").alias("conv_id"),
        F.col(f"`{turn_col}`").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`"), F.lit(NO_ROLE)).alias("role"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    ).distinct()
    ordered = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.withColumns({"pos": F.row_number().over(ordered), "is_last": F.lead(F.lit(True)).over(ordered).isNull()})
    rows = rows.withColumns({"_a": F.xxhash64("pos", "role", "text"), "_b": F.xxhash64("text", "role", "pos", F.lit(1))})
    upto = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({"a": F.bit_xor("_a").over(upto), "b": F.bit_xor("_b").over(upto)})
    return rows.select("conv_id", "pos", "role", "text", "a", "b", "is_last")


def format_chats(
    turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per maximal conversation: conv_id, n_turns, n_equal (conversations alike), text."""
    numbered = numbered_turns(turns, conv_col, turn_col, role_col, text_col)
    hashes = checkpointed(numbered.select("conv_id", "pos", "a", "b", "is_last"))
    whole = hashes.where("is_last").groupBy("pos", "a", "b").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_equal")
    )
    inner = hashes.where(~F.col("is_last")).select("pos", "a", "b").distinct()
    maximal = checkpointed(whole.join(inner, ["pos", "a", "b"], "left_anti"))
    chosen = maximal.select(F.col("conv_id").alias("chosen"), F.col("pos").alias("n_turns"), "n_equal")
    safe = F.replace(F.replace("text", F.lit(START), F.lit("<| im_start|>")), F.lit(END), F.lit("<| im_end|>"))
    segment = F.concat(F.lit(START), "role", F.lit("\n"), safe, F.lit(END + "\n"))
    rows = numbered.select("conv_id", "pos", segment.alias("segment"))
    rows = rows.join(chosen, F.col("conv_id").eqNullSafe(F.col("chosen")))
    rendered = rows.groupBy("conv_id", "n_turns", "n_equal").agg(
        F.sort_array(F.collect_list(F.struct("pos", "segment"))).alias("parts")
    )
    text = F.array_join(F.transform("parts", lambda part: part["segment"]), "")
    return rendered.select("conv_id", F.col("n_turns").cast("bigint").alias("n_turns"), "n_equal", text.alias("text"))
