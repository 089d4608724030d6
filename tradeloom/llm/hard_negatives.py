"""Hard-negative mining with score bounds along a spanning tree of anchors.

Anchors are dealt into blocks, candidates into blocks of their own, and every anchor block meets every
candidate block in one task. Inside a block the anchors form a minimum spanning tree. For a candidate c
the scores of a tree edge's ends differ by at most the edge's length times the norm of c, so what is
known about a parent's scores bounds its child's: lower and upper bounds of all candidates of the block
are carried from anchor to anchor, and only candidates whose interval reaches a range in question are
scored again, exactly. Their intervals shrink to the score; the others' widen by the next edge.

The tree is walked twice. First for positives: the range of an anchor starts at its fifth best lower
bound among rows of its own label. The blocks' best rows merge into each anchor's positives, and these
give the ranges of scores that are hard negatives: whole-number windows, one per positive. The second
walk scores candidates of another label whose interval touches a window of its anchor, and keeps each
window's best. A block returns at most as many rows per anchor and window as are wanted in the end, so
the merge is small.

Components are whole numbers and scores are exact. Bounds are floating-point, widened by more than their
rounding error. Per task memory is one block of either kind and the bounds on the path down the tree;
heavier subtrees are walked last, when their parent's bounds are not needed any more, so the path holds
at most log2(anchors) pairs of bounds.

Defined cases: rows with a null id, label or vector, or a null or non-finite component, take no part;
equal rows (id, label and vector) are one; rows that share an id but differ are rows of their own, and
never each other's positive or negative; rows whose vectors differ in length have no score with each
other; a vector whose whole numbers have a squared norm above 2**61 takes no part, as its scores need
not fit a 64-bit number; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.common import checkpointed
from tradeloom.llm.vector_codes import usable_vector

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LEAST_PERCENT, MOST_PERCENT = 50, 95
ANCHOR_ROWS, CANDIDATE_ROWS, LEAST_CANDIDATE_BLOCKS = 8192, 32_768, 12
_SLACK = 1e-12  # relative; far more than the rounding error of a bound
_LARGEST_NORM = float(1 << 61)
_EXACT_DOUBLE = 1 << 53
_DENSE = 0.25  # from this share of candidates on, one matrix product is cheaper than picking them


def spanning_tree(points: np.ndarray) -> np.ndarray:
    """The parent of each point in a minimum spanning tree rooted at point 0 (its parent is -1)."""
    parent = np.zeros(len(points), np.int64)
    parent[0] = -1
    wide = points.astype(np.float64)
    norms = np.einsum("ij,ij->i", wide, wide)
    gap = np.full(len(points), np.inf)
    outside = np.ones(len(points), bool)
    latest = 0
    outside[0] = False
    for _ in range(len(points) - 1):
        far = norms - 2 * (wide @ wide[latest]) + norms[latest]
        closer = outside & (far < gap)
        gap[closer], parent[closer] = far[closer], latest
        latest = int(np.where(outside, gap, np.inf).argmin())
        outside[latest] = False
    return parent


def walk_order(parent: np.ndarray) -> list[tuple[int, bool]]:
    """Points after their parents, depth first, the heaviest child last; with each, whether it is its
    parent's last child."""
    children: list[list[int]] = [[] for _ in parent]
    for point, above in enumerate(parent.tolist()):
        if above >= 0:
            children[above].append(point)
    order, stack = [], [0] if len(parent) else []
    while stack:
        point = stack.pop()
        order.append(point)
        stack.extend(children[point])
    weight = [1] * len(parent)
    for point in reversed(order):
        if parent[point] >= 0:
            weight[parent[point]] += weight[point]
    for below in children:
        below.sort(key=weight.__getitem__, reverse=True)  # the lightest is popped first
    found, waiting = [], [(0, True)] if len(parent) else []
    while waiting:
        point, last = waiting.pop()
        found.append((point, last))
        waiting.extend((child, place == 0) for place, child in enumerate(children[point]))
    return found


def edge_lengths(points: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """Never below the true distance to the parent."""
    gap = (points - points[np.maximum(parent, 0)]).astype(np.float64)
    return np.sqrt(np.einsum("ij,ij->i", gap, gap)) * (1 + _SLACK)


class Scores:
    """Exact whole-number scores of anchors with a block of candidates."""

    def __init__(self, candidates: np.ndarray, largest_anchor: int):
        largest = int(np.abs(candidates).max(initial=0))
        # Sums of whole numbers below 2**53 are exact in a double, whatever their order.
        double = max(1, candidates.shape[1]) * largest * largest_anchor < _EXACT_DOUBLE
        self.kind = np.float64 if double else np.int64
        self.candidates = candidates.astype(self.kind)
        self.norms = np.sqrt(np.einsum("ij,ij->i", candidates.astype(np.float64), candidates.astype(np.float64))) * (1 + _SLACK)

    def of(self, anchor: np.ndarray, picked: np.ndarray) -> np.ndarray:
        anchor = anchor.astype(self.kind)
        if len(picked) >= _DENSE * len(self.candidates):
            return (self.candidates @ anchor)[picked].astype(np.int64)
        return (self.candidates[picked] @ anchor).astype(np.int64)


def walk(anchors: np.ndarray, parent: np.ndarray, scores: Scores, wanted: Callable[[int, np.ndarray, np.ndarray], np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(anchor, candidates, scores) of the candidates that `wanted(anchor, low, high)` picks by their bounds."""
    lengths = edge_lengths(anchors, parent)
    bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for point, last in walk_order(parent):
        above = int(parent[point])
        if above < 0:
            reach = float(np.sqrt((anchors[point].astype(np.float64) ** 2).sum())) * (1 + _SLACK) * scores.norms
            low, high = -reach, reach
        else:
            low, high = bounds.pop(above) if last else bounds[above]
            widened = lengths[point] * scores.norms
            widened = widened + _SLACK * (np.maximum(np.abs(low), np.abs(high)) + widened)
            low, high = low - widened, high + widened
        picked = np.flatnonzero(wanted(point, low, high))
        found = scores.of(anchors[point], picked)
        low[picked] = high[picked] = found
        bounds[point] = (low, high)
        yield point, picked, found


def best_of(scores: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    """Places of the highest scores, ties by smaller id."""
    if len(scores) > count:
        least = np.partition(scores, len(scores) - count)[len(scores) - count]
        near = np.flatnonzero(scores >= least)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))[:count]]


def window(positive: int, least: int, most: int) -> tuple[int, int]:
    """The whole-number scores n with least * positive <= 100 * n <= most * positive."""
    return -(-least * positive // 100), most * positive // 100


def _matrix(table: pa.Table | pa.RecordBatch) -> np.ndarray:
    column = table.column("numbers").combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _tree(block: pa.Table) -> pa.Table:
    """The block's anchors in a fixed order, with their place in it and their parent's."""
    ordered = block.sort_by([("vec_id", "ascending"), ("code", "ascending")])
    parent = spanning_tree(_matrix(ordered))
    place = pa.array(np.arange(len(parent)), pa.int32())
    return ordered.append_column("place", place).append_column("parent", pa.array(parent, pa.int32()))


_POSITIVE = "size int, block int, place int, positive_id bigint, positive_score bigint"


def _positives(count: int):
    """The best rows of each anchor's label in a block of candidates."""

    def run(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        found: list[tuple[int, np.ndarray, np.ndarray]] = []
        if len(anchors) and len(candidates):
            anchors = anchors.sort_by("place")
            points, names, labels = _matrix(anchors), _numbers(anchors, "vec_id"), _numbers(anchors, "label")
            ids, others = _numbers(candidates, "vec_id"), _numbers(candidates, "label")
            scores = Scores(_matrix(candidates), int(np.abs(points).max(initial=0)))

            def wanted(point: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
                same = (others == labels[point]) & (ids != names[point])
                rows = np.count_nonzero(same)
                if rows > count:
                    same &= high >= np.partition(low[same], rows - count)[rows - count]
                return same

            for point, picked, score in walk(points, _numbers(anchors, "parent"), scores, wanted):
                top = best_of(score, ids[picked], count)
                found.append((point, ids[picked][top], score[top]))
        return _rows(anchors, found)

    return run


def _rows(anchors: pa.Table, found: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.Table:
    sizes = [len(x[1]) for x in found]
    nothing = np.zeros(0, np.int64)
    key = [anchors.column(name)[0].as_py() if len(anchors) else 0 for name in ("size", "block")]
    return pa.table({
        "size": pa.array(np.full(sum(sizes), key[0]), pa.int32()),
        "block": pa.array(np.full(sum(sizes), key[1]), pa.int32()),
        "place": pa.array(np.repeat([x[0] for x in found], sizes) if found else nothing, pa.int32()),
        "positive_id": pa.array(np.concatenate([x[1] for x in found]) if found else nothing, pa.int64()),
        "positive_score": pa.array(np.concatenate([x[2] for x in found]) if found else nothing, pa.int64()),
    })


_NEGATIVE = "size int, block int, place int, number int, negative_id bigint, negative_score bigint"


def _negatives(count: int, least: int, most: int):
    """The best rows of other labels in each anchor's windows, in a block of candidates."""

    def run(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        places, numbers, rows, values = [], [], [], []
        if len(anchors) and len(candidates):
            anchors = anchors.sort_by("place")
            points, names, labels = _matrix(anchors), _numbers(anchors, "vec_id"), _numbers(anchors, "label")
            windows = [[window(score, least, most) for score in row or []] for row in anchors.column("positive_scores").to_pylist()]
            ids, others = _numbers(candidates, "vec_id"), _numbers(candidates, "label")
            scores = Scores(_matrix(candidates), int(np.abs(points).max(initial=0)))

            def wanted(point: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
                reached = np.zeros(len(ids), bool)
                for bottom, top in windows[point]:
                    if bottom <= top:
                        reached |= (high >= bottom) & (low <= top)
                return reached & (others != labels[point]) & (ids != names[point])

            for point, picked, score in walk(points, _numbers(anchors, "parent"), scores, wanted):
                for number, (bottom, top) in enumerate(windows[point]):
                    inside = np.flatnonzero((score >= bottom) & (score <= top))
                    kept = inside[best_of(score[inside], ids[picked[inside]], count)]
                    places.extend([point] * len(kept))
                    numbers.extend([number] * len(kept))
                    rows.append(ids[picked[kept]])
                    values.append(score[kept])
        nothing = np.zeros(0, np.int64)
        key = [anchors.column(name)[0].as_py() if len(anchors) else 0 for name in ("size", "block")]
        return pa.table({
            "size": pa.array([key[0]] * len(places), pa.int32()),
            "block": pa.array([key[1]] * len(places), pa.int32()),
            "place": pa.array(places, pa.int32()),
            "number": pa.array(numbers, pa.int32()),
            "negative_id": pa.array(np.concatenate(rows) if rows else nothing, pa.int64()),
            "negative_score": pa.array(np.concatenate(values) if values else nothing, pa.int64()),
        })

    return run


def _meeting(anchors: DataFrame, candidates: DataFrame, anchor_blocks: int, candidate_blocks: int):
    """Every anchor block beside every candidate block of its vector length."""
    keys = ["size", "block", "dealt"]
    left = anchors.withColumn("dealt", F.explode(F.sequence(F.lit(0), F.lit(candidate_blocks - 1))))
    right = candidates.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(anchor_blocks - 1))))
    return left.groupBy(*keys).cogroup(right.groupBy(*keys))


def mine_hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least_percent: int = LEAST_PERCENT,
    most_percent: int = MOST_PERCENT,
    anchor_rows: int = ANCHOR_ROWS,
    candidate_rows: int = CANDIDATE_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); `is_anchor` is a condition on vec_id."""
    named = vectors.select(
        F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), F.col(f"`{label_col}`").cast("bigint").alias("label"), F.col(f"`{vector_col}`").alias("vector")
    )
    usable = named.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable_vector(F.col("vector")))
    scaled = usable.withColumn("scaled", F.transform("vector", lambda x: F.floor(x.cast("double") * scale).cast("double")))
    norm = F.aggregate("scaled", F.lit(0.0), lambda total, x: total + x * x)
    whole = scaled.where(norm <= _LARGEST_NORM).select(
        "vec_id", "label", F.transform("scaled", lambda x: x.cast("bigint")).alias("numbers")
    )
    rows = checkpointed(whole.distinct().withColumn("size", F.size("numbers").cast("int")))
    total, n_anchors = rows.agg(F.count("*"), F.count_if(is_anchor)).first()
    anchor_blocks = max(1, -(-n_anchors // anchor_rows))
    candidate_blocks = max(LEAST_CANDIDATE_BLOCKS, -(-total // candidate_rows))
    code = F.xxhash64("vec_id", "label", "numbers")
    coded = rows.withColumn("code", code)
    candidates = coded.withColumn("dealt", F.pmod("code", F.lit(candidate_blocks)).cast("int")).drop("code")

    anchor_block = F.pmod(F.xxhash64("code", F.lit(1)), F.lit(anchor_blocks)).cast("int")
    tree = "vec_id bigint, label bigint, numbers array<bigint>, size int, code bigint, block int, place int, parent int"
    anchors = coded.where(is_anchor).withColumn("block", anchor_block).groupBy("size", "block").applyInArrow(_tree, tree)
    anchors = checkpointed(anchors.drop("code"))
    anchor = ["size", "block", "place"]

    near = _meeting(anchors, candidates, anchor_blocks, candidate_blocks).applyInArrow(_positives(positives), _POSITIVE)
    by_score = Window.partitionBy(*anchor).orderBy(F.desc("positive_score"), "positive_id")
    best = near.withColumn("number", F.row_number().over(by_score) - 1).where(F.col("number") < positives)
    best = checkpointed(best)
    in_order = F.sort_array(F.collect_list(F.struct("number", "positive_score")))
    scored = best.groupBy(*anchor).agg(F.transform(in_order, lambda x: x["positive_score"]).alias("positive_scores"))
    searching = checkpointed(anchors.join(scored, anchor, "left"))

    hard = _meeting(searching, candidates, anchor_blocks, candidate_blocks)
    hard = hard.applyInArrow(_negatives(negatives, least_percent, most_percent), _NEGATIVE)
    by_score = Window.partitionBy(*anchor, "number").orderBy(F.desc("negative_score"), "negative_id")
    hard = hard.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= negatives)
    found = checkpointed(hard).join(best, [*anchor, "number"]).join(anchors.select(*anchor, F.col("vec_id").alias("anchor_id")), anchor)
    return found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
