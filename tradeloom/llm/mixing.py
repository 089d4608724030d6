"""Mixing sources to target weights by hierarchical budgeting, in DataFrame operations only.

The documents are the leaves of a tree of `levels`, for example domain, language, source. A budget of
tokens runs down the tree. Each node splits its budget among its children by weight; a child that has
too few tokens, even when repeated `max_epochs` times, gives the shortage to its siblings, again by
weight, and only what all siblings together cannot take goes to the siblings of the parent. This is
one water level per sibling group: sorted by capacity over weight, the children that fit under the
level are used up and the others get `weight * level`.

A leaf takes whole epochs and, of one more epoch, a prefix in an order seeded by the epoch: documents
by rising md5(seed:epoch:doc_id) as long as the tokens before them are below the rest of the budget.
The prefix of a leaf, however large, is found in two steps: token sums of 4096 hash ranges, then the
documents of the one range in which the budget ends.

All arithmetic is in whole numbers; a node may keep less than one token per child unspent.

Defined cases: null or empty texts have no tokens and cost nothing; null level values are a child of
their own; rows with the same id in a leaf are in or out together; an empty table gives an empty
result; a weight is at least 1 and unknown values have `default_weight`. The result column
`n_copies` replaces an input column of that name.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.common import SPACES, checkpointed, packed, unpacked

LEVELS = ("domain", "lang", "source")
# The production mixture: weights among siblings.
WEIGHTS = {
    "domain": {"web": 5, "books": 3, "forum": 2},
    "lang": {"en": 6, "de": 2, "fr": 2, "es": 1},
    "source": {},
}
DEFAULT_WEIGHT, MAX_EPOCHS, BUDGET_PERCENT, SEED = 1, 2, 100, 17
# A plan has one row per leaf and is broadcast up to this many; otherwise Spark joins by shuffle.
BROADCAST_LEAVES = 50_000
_EXACT = "decimal(38,0)"
_CODES = [f"_level{i}" for i in range(8)]


def domain_of(source: Column) -> Column:
    """The domain of a source, by the last digit of its name."""
    digit = F.regexp_extract(F.coalesce(source, F.lit("")), "([0-9])$", 1)
    return (
        F.when(digit.isin("0", "3", "6", "9"), "web")
        .when(digit.isin("1", "4", "7"), "books")
        .when(digit.isin("2", "5", "8"), "forum")
        .otherwise("other")
    )


def count_words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    count = F.size(F.split(trimmed, "[\x20\x09-\x0d]+"))
    return F.when(trimmed.isNull() | (trimmed == ""), 0).otherwise(count).cast("bigint")


def _same(left: DataFrame, right: DataFrame, names: Sequence[str], suffix: str) -> Column:
    """Equal on all names, nulls included; the right side has them with a suffix."""
    return reduce(Column.__and__, [left[name].eqNullSafe(right[name + suffix]) for name in names], F.lit(True))


def _weight(level: int, weights: Mapping[str, int], default: int) -> Column:
    known = F.col(_CODES[level])
    chosen = F.lit(default)
    for value, weight in weights.items():
        chosen = F.when(known == value, weight).otherwise(chosen)
    return F.greatest(chosen, F.lit(1)).cast(_EXACT)


def _filled(children: DataFrame, parent: Sequence[str], own: str) -> DataFrame:
    """(…, cap, weight, given) with `budget`: what each child gets of the budget of its parent."""
    siblings = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    rising = siblings.orderBy(F.col("cap").cast("double") / F.col("weight").cast("double"), F.col(own).asc_nulls_first())
    before = F.coalesce(F.sum("cap").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast(_EXACT)
    from_here = F.sum("weight").over(rising.rowsBetween(0, Window.unboundedFollowing)).cast(_EXACT)
    full = F.col("cap") * F.col("_from") <= F.col("weight") * (F.col("given") - F.col("_before"))
    children = children.withColumns({"_before": before, "_from": from_here}).withColumn("_full", full)
    spent = F.sum(F.when(F.col("_full"), F.col("cap")).otherwise(0)).over(siblings).cast(_EXACT)
    open_weight = F.sum(F.when(~F.col("_full"), F.col("weight")).otherwise(0)).over(siblings).cast(_EXACT)
    children = children.withColumns({"_spent": spent, "_open": open_weight})
    share = F.call_function("div", F.col("weight") * (F.col("given") - F.col("_spent")), F.col("_open"))
    budget = F.when(F.col("_full"), F.col("cap")).otherwise(share.cast(_EXACT))
    return children.withColumn("budget", budget).drop("_before", "_from", "_full", "_spent", "_open", "given")


def plan_mixture(
    leaves: DataFrame,
    weights: Mapping[str, Mapping[str, int]] = WEIGHTS,
    levels: Sequence[str] = LEVELS,
    *,
    default_weight: int = DEFAULT_WEIGHT,
    max_epochs: int = MAX_EPOCHS,
    budget_percent: int = BUDGET_PERCENT,
) -> DataFrame:
    """Leaves (_level0…, tokens) with the whole epochs and the rest of tokens that each is to give.

    Rows are leaves and nodes of the tree, not documents; a sibling group has one row per child.
    """
    codes = _CODES[: len(levels)]
    caps = leaves.withColumn("cap", F.col("tokens").cast(_EXACT) * max_epochs)
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).cast(_EXACT).alias("all"))
    budget = F.call_function("div", F.col("all") * budget_percent, F.lit(100).cast(_EXACT)).cast(_EXACT)
    given = total.select(F.least(budget, F.col("all") * max_epochs).cast(_EXACT).alias("given"))
    for level in range(len(levels)):
        nodes = caps.groupBy(*codes[: level + 1]).agg(F.sum("cap").cast(_EXACT).alias("cap"))
        nodes = nodes.withColumn("weight", _weight(level, weights.get(levels[level], {}), default_weight))
        if level == 0:
            nodes = nodes.withColumn("given", given.scalar())
        else:
            above = given.select(*[F.col(c).alias(c + "_above") for c in codes[:level]], F.col("budget").alias("given"))
            nodes = nodes.join(above, _same(nodes, above, codes[:level], "_above"))
            nodes = nodes.drop(*[c + "_above" for c in codes[:level]])
        given = checkpointed(_filled(nodes, codes[:level], codes[level]).select(*codes[: level + 1], "budget"))
    named = given.select(*[F.col(c).alias(c + "_plan") for c in codes], "budget")
    planned = leaves.join(named, _same(leaves, named, codes, "_plan"))
    tokens = F.greatest(F.col("tokens"), F.lit(1)).cast(_EXACT)
    epochs = F.call_function("div", F.col("budget"), tokens).cast("bigint")
    return planned.select(*codes, "tokens", epochs.alias("epochs"), "budget").withColumn(
        "rest", (F.col("budget") - F.col("epochs") * tokens).cast("bigint")
    ).drop("budget")


def _with_plan(docs: DataFrame, plan: DataFrame, codes: Sequence[str]) -> DataFrame:
    """Documents with the plan of their leaf; documents have the level values as _level0…"""
    named = plan.select(*[F.col(c).alias(c + "_plan") if c in codes else F.col(c) for c in plan.columns])
    if plan.limit(BROADCAST_LEAVES + 1).count() <= BROADCAST_LEAVES:
        named = F.broadcast(named)
    return docs.join(named, _same(docs, named, codes, "_plan")).drop(*[c + "_plan" for c in codes])


def _order(seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epochs").cast("string"), F.col("_id").cast("string")))


def _cutoffs(tokens: DataFrame, plan: DataFrame, codes: Sequence[str], seed: int) -> DataFrame:
    """The plan with `cutoff`: the largest md5 of the epoch that is only taken in part, or null."""
    placed = _with_plan(tokens, plan, codes).where(F.col("rest") > 0).withColumn("_md5", _order(seed))
    placed = placed.withColumn("_range", F.substring("_md5", 1, 3))
    ranges = placed.groupBy(*codes, "rest", "_range").agg(F.sum("n_tokens").alias("_sum"))
    rising = Window.partitionBy(*codes).orderBy("_range")  # at most 4096 rows per leaf
    ranges = ranges.withColumn("_upto", F.sum("_sum").over(rising)).withColumn("_start", F.col("_upto") - F.col("_sum"))
    # The budget ends in the first range that reaches it; a leaf gives less than one epoch, so there is one.
    ends = ranges.where((F.col("_start") < F.col("rest")) & (F.col("_upto") >= F.col("rest")))
    ends = checkpointed(ends.select(*codes, F.col("_range").alias("_end"), "_start"))

    inside = _with_plan(placed, ends, codes).where(F.col("_range") == F.col("_end"))
    by_md5 = Window.partitionBy(*codes).orderBy("_md5")
    tied = Window.partitionBy(*codes, "_md5")
    upto = F.sum("n_tokens").over(by_md5.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    start = F.col("_start") + upto - F.sum("n_tokens").over(tied)
    inside = inside.withColumn("_before", start).where(F.col("_before") < F.col("rest"))
    found = inside.groupBy(*codes).agg(F.max("_md5").alias("cutoff"))
    named = found.select(*[F.col(c).alias(c + "_found") for c in codes], "cutoff")
    joined = plan.join(named, _same(plan, named, codes, "_found"), "left")
    return checkpointed(joined.select(*codes, "epochs", "cutoff"))


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str, Mapping[str, int]] = WEIGHTS,
    levels: Mapping[str, Column] | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    default_weight: int = DEFAULT_WEIGHT,
    max_epochs: int = MAX_EPOCHS,
    budget_percent: int = BUDGET_PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """All documents with `n_copies`: how often the mixture takes each, 0 for those it leaves out."""
    levels = levels or {"domain": domain_of(F.col("source")), "lang": F.col("lang"), "source": F.col("source")}
    codes = _CODES[: len(levels)]
    keys = dict(zip(codes, levels.values(), strict=True))
    tokens = checkpointed(
        docs.select(*[c.alias(n) for n, c in keys.items()], F.col(f"`{id_col}`").alias("_id"),
                    count_words(F.col(f"`{text_col}`")).alias("n_tokens"))
    )
    leaves = checkpointed(tokens.groupBy(*codes).agg(F.sum("n_tokens").alias("tokens")))
    plan = checkpointed(
        plan_mixture(leaves, weights, list(levels), default_weight=default_weight, max_epochs=max_epochs,
                     budget_percent=budget_percent)
    )
    plan = _cutoffs(tokens, plan, codes, seed)
    wide = _with_plan(packed(docs, _id=F.col(f"`{id_col}`"), **keys), plan, codes)
    extra = F.when(F.col("cutoff").isNotNull() & (_order(seed) <= F.col("cutoff")), 1).otherwise(0)
    return unpacked(wide, docs.columns, {"n_copies": (F.col("epochs") + extra).cast("bigint")})
