"""Toxicity by maximum-scoring segments of token log-odds.

Terms (words, and the first letters of longer words, so that other endings are known too) get the
log-odds of toxic against clean labelled documents, with a Dirichlet prior in proportion to the term's
share of the whole corpus. Every term that leans to the toxic side by `MIN_Z` standard deviations keeps
its log-odds, however small; every word costs `DRIFT`, so that random text drifts down. A linear scan finds all maximal
scoring segments of a document: each is a passage that gets better neither when grown nor when cut.

Segments follow an extreme-value law: n clean words hold a number of segments of score S or more that is
Poisson with mean K n exp(-lambda S). Lambda solves the balance equation of the clean word distribution.
K is the smallest with which the law covers the segments of clean labelled documents at every score,
where one segment in MISLABELLED of these documents may be stronger, as labels can be wrong. A document's
chance is the smallest probability, over r, that chance makes r segments as strong as its r strongest; so
many weak terms count as well as a few strong ones. Below the 5 % level these r are its passages. The
chance p bounds the odds of clean against toxic by -e p ln p, which with the share of toxic labels gives
the score, the probability that the document is toxic.

Labels come from at most SAMPLE_ROWS documents of either class (smallest hash of the id), none of them
held out. That sample is the only bound: prior counts and scores read every document, whole. The terms
that are counted are those that at least MIN_DOCS toxic sample documents hold, so their table is
bounded by the sample and broadcast. Counting sums up in each Arrow batch first.

Defined cases: a null or empty text, or one without a known term, has score 0 and no passage; labels
with null are not used, a document with several labels is toxic if one of them is 1; repeated rows are
scored each; a null id is never a training document; without labelled documents of both classes every
score is 0; an empty table gives an empty result. Result columns replace input columns of the same
name. Passages count code points, the end is exclusive.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.llm.common import packed, small_batches, unpacked

SAMPLE_ROWS = 10_000  # labelled documents of either class that a model is fitted on
MIN_DOCS, MIN_Z = 2, 3.5
PRIOR_SHARE = 0.1  # weight of the prior against the sample
DRIFT = 0.5
STEM = 5
LEVEL = 0.05
MISLABELLED = 1000  # one in so many clean labels may be wrong
STEP = 0.01  # of segment scores, when they are counted
HOLD_OUT_FOLDS, HELD_OUT = 3, 1
TOXIC_FROM = 0.7
_WORDS = re.compile(r"\w+")


@dataclass(frozen=True)
class ToxicityModel:
    """Term scores above zero, and the constants of the extreme-value law."""

    terms: dict[str, float] = field(default_factory=dict)
    rate: float = 1.0  # lambda
    factor: float = 1.0  # K
    share: float = 0.5  # of toxic documents


def held_out(doc_id: Column) -> Column:
    """Rows that no label may be learned from."""
    fold = F.crc32(doc_id.cast("string").cast("binary")) % HOLD_OUT_FOLDS
    return F.coalesce(fold == HELD_OUT, F.lit(False))


def terms_of(word: str) -> tuple[str, str | None]:
    word = word.lower()
    return word, f"{word[:STEM]}*" if len(word) >= STEM else None


def maximal_segments(scores: list[tuple[int, float]], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score) of a sequence of numbers, in linear time.

    `scores` lists (position, score) of the words above zero; each word between two of them costs
    `drift`. Candidates are kept with the total before them (left) and up to their end (right), and with
    the number of the last earlier candidate whose left is smaller. A search follows these numbers, so
    it passes a candidate once at most: the next search starts behind it.
    """
    found: list[tuple[int, int, float, float]] = []  # first, last, left, right
    smaller: list[int] = []
    total, previous = 0.0, -1
    for position, score in scores:
        total -= drift * (position - previous - 1)
        previous = position
        first, left = position, total
        total += score
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= left:
                j = smaller[j]
            if j < 0 or found[j][3] >= total:
                break
            # The candidate takes in all from that one on; its left is known, and so is where to look next.
            first, left = found[j][0], found[j][2]
            j, kept = smaller[j], j
            del found[kept:], smaller[kept:]
        found.append((first, position, left, total))
        smaller.append(j)
    return [(first, last, right - left) for first, last, left, right in found]


def _hits(words: list[str], terms: Mapping[str, float]) -> list[tuple[int, float]]:
    """(position, score) of the words above zero."""
    hits = []
    for position, word in enumerate(words):
        word = word.lower()
        score = terms.get(word) or (terms.get(word[:STEM] + "*") if len(word) >= STEM else None)
        if score and score > DRIFT:
            hits.append((position, score - DRIFT))
    return hits


def chance_of(number: int, mean: float) -> float:
    """Probability that a Poisson number of this mean is at least `number`."""
    if mean >= number or mean <= 0:
        # Above the mean no level is reached, so the value does not matter.
        return 1.0 if mean > 0 else 0.0
    term = math.exp(number * math.log(mean) - mean - math.lgamma(number + 1))
    total, k = 0.0, number
    while term > 1e-17 * total:
        total += term
        k += 1
        term *= mean / k
    return min(1.0, total)


def score_words(words: list[str], model: ToxicityModel) -> tuple[float, list[tuple[int, int, float]]]:
    """Score of a document, and its significant segments as word positions."""
    segments = maximal_segments(_hits(words, model.terms))
    if not segments:
        return 0.0, []
    strongest = sorted(range(len(segments)), key=lambda i: -segments[i][2])
    chance, number = 2.0, 0
    for r, i in enumerate(strongest, 1):
        mean = model.factor * len(words) * math.exp(-min(700.0, model.rate * segments[i][2]))
        found = chance_of(r, mean)
        if found < chance:
            chance, number = found, r
    odds = 1.0 if chance >= math.exp(-1) else -math.e * chance * math.log(chance) if chance > 0 else 0.0
    score = 1 / (1 + odds * (1 - model.share) / model.share)
    return score, [segments[i] for i in sorted(strongest[:number])] if chance <= LEVEL else []


def _texts(column: pa.Array) -> Iterator[str]:
    return (text.as_py() or "" for text in column)


def _sample_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, toxic, clean): sample documents with the term, summed up per batch."""
    for batch in batches:
        found: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for text, toxic in zip(_texts(batch.column(0)), batch.column(1).to_pylist(), strict=True):
            found[toxic].update({t for word in set(_WORDS.findall(text)) for t in terms_of(word) if t})
        terms = list(found[0].keys() | found[1].keys())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(terms, pa.string()),
                pa.array([found[1][t] for t in terms], pa.int64()),
                pa.array([found[0][t] for t in terms], pa.int64()),
            ],
            names=["term", "toxic", "clean"],
        )


def _corpus_counts(shared):
    """(number, docs): documents with a candidate term; number -1 has all (document, word) pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = shared.value
        for batch in batches:
            found, everything = Counter(), 0
            for text in _texts(batch.column(0)):
                words = set(map(str.lower, _WORDS.findall(text)))
                everything += len(words)
                hits = {numbers.get(w) for w in words}
                hits.update(numbers.get(w[:STEM] + "*") for w in words if len(w) >= STEM)
                found.update(hits)
            found.pop(None, None)
            found[-1] = everything
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], names=["number", "docs"]
            )

    return run


def _clean_segments(shared):
    """(step, number) per batch: segments by score in whole STEPs, rounded up; step -1 has all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = shared.value
        for batch in batches:
            found = Counter()
            for text in _texts(batch.column(0)):
                words = _WORDS.findall(text)
                found[-1] += len(words)
                found.update(math.ceil(s / STEP) for _, _, s in maximal_segments(_hits(words, terms)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], names=["step", "number"]
            )

    return run


def _solve_factor(segments: Mapping[int, int], rate: float, docs: int) -> float:
    """K with which the law covers the segments (step to number; -1: words) of `docs` clean documents."""
    words, above, factor = segments.get(-1, 0), 0, 0.0
    if not words:
        return 1.0
    for step in sorted((step for step in segments if step >= 0), reverse=True):
        above += segments[step]
        if above * MISLABELLED > docs:
            factor = max(factor, above / words * math.exp(min(700.0, rate * step * STEP)))
    return factor or 1 / words


def _solve_rate(scores: Mapping[str, float], odds: Mapping[str, float]) -> float:
    """Lambda with sum p exp(lambda s) = 1 over clean words; a word without a term scores -DRIFT."""
    rest = max(0.0, 1.0 - sum(odds.values()))

    def balance(rate: float) -> float:
        return rest * math.exp(-rate * DRIFT) + sum(odds[t] * math.exp(rate * (scores[t] - DRIFT)) for t in scores) - 1

    low, high = 0.0, 1.0
    while balance(high) < 0 and high < 64:
        high *= 2
    if high >= 64:
        return high
    low = high / 2 if high > 1 else 1e-3
    while balance(low) > 0 and low > 1e-9:
        low /= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if balance(middle) < 0 else (low, middle)
    return low


def known_labels(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """(doc_id, label) of the rows that may be learned from."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    return known.groupBy(F.col(id_col).alias("doc_id")).agg(F.max(label_col).cast("int").alias("label"))


def labelled_sample(known: DataFrame, rows: int) -> list[tuple[int, int]]:
    """At most `rows` ids of either class, by the smallest hash of the id."""
    chosen = []
    for label in (0, 1):
        some = known.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        chosen += [(row.doc_id, label) for row in some.collect()]
    return chosen


def sample_documents(docs: DataFrame, sample: list[tuple[int, int]], id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, label) of the sample; its ids are at most twice SAMPLE_ROWS and broadcast."""
    spark = docs.sparkSession
    table = pa.table({"_sample_id": pa.array([i for i, _ in sample], pa.int64()), "label": pa.array([y for _, y in sample], pa.int64())})
    narrow = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("_id"), F.col(f"`{text_col}`").alias("text"))
    chosen = narrow.join(F.broadcast(spark.createDataFrame(table)), F.col("_id") == F.col("_sample_id"))
    return chosen.select(F.col("_id").alias("doc_id"), "text", "label")


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
) -> ToxicityModel:
    context = docs.sparkSession.sparkContext
    small_batches(docs.sparkSession)
    known = known_labels(labels, id_col, label_col)
    sample = labelled_sample(known, sample_rows)
    if len({label for _, label in sample}) < 2:
        return ToxicityModel()
    texts = sample_documents(docs, sample, id_col, text_col).select("text", "label")
    # The sample is small against the documents it is picked from.
    counts = texts.coalesce(64).mapInArrow(_sample_terms, "term string, toxic bigint, clean bigint")
    counts = counts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    is_word = ~F.col("term").endswith("*")
    n_toxic, n_clean = sum(y for _, y in sample), sum(1 - y for _, y in sample)
    lean = F.col("toxic") * n_clean > F.col("clean") * n_toxic
    counts = counts.withColumn("is_word", is_word).cache()
    all_toxic, all_clean = counts.where("is_word").agg(F.sum("toxic"), F.sum("clean")).first()
    rows = counts.where((F.col("toxic") >= MIN_DOCS) & lean).select("term", "toxic", "clean").orderBy("term").collect()
    counts.unpersist()
    if not rows or not all_toxic or not all_clean:
        return ToxicityModel()

    numbers = context.broadcast({row.term: i for i, row in enumerate(rows)})
    corpus = docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(_corpus_counts(numbers), "number bigint, docs bigint")
    held = {r.number: r.docs for r in corpus.groupBy("number").agg(F.sum("docs").alias("docs")).collect()}  # one row per term
    prior_total = PRIOR_SHARE * (all_toxic + all_clean)
    terms, odds = {}, {}
    for i, row in enumerate(rows):
        prior = prior_total * max(held.get(i, 0), row.toxic + row.clean) / max(held.get(-1, 0), all_toxic + all_clean)
        up, down = row.toxic + prior, row.clean + prior
        delta = math.log(up / (all_toxic + prior_total - up)) - math.log(down / (all_clean + prior_total - down))
        # A term that does not outweigh DRIFT lets no segment grow.
        if delta / math.sqrt(1 / up + 1 / down) >= MIN_Z and delta > DRIFT:
            terms[row.term] = delta
            odds[row.term] = down / (all_clean + prior_total)
    # A stem counts where its word does not, so the two share the chance of a word.
    words = {t: p for t, p in odds.items() if not t.endswith("*")}
    rate = _solve_rate({t: terms[t] for t in words}, words) if words else 1.0
    share = known.agg(F.avg("label")).first()[0]
    clean = texts.where("label = 0").select("text").coalesce(64).mapInArrow(_clean_segments(context.broadcast(terms)), "step bigint, number bigint")
    segments = {r.step: r.number for r in clean.groupBy("step").agg(F.sum("number").alias("number")).collect()}  # one row per score
    return ToxicityModel(terms, rate, _solve_factor(segments, rate, n_clean), share)


PASSAGES = T.ArrayType(
    T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())])
)
_ARROW_PASSAGES = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def _score(shared):
    """The last column is the text; its score and passages take its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores, passages = [], []
            for text in _texts(batch.column(batch.num_columns - 1)):
                score, segments = score_words(_WORDS.findall(text), model)
                scores.append(score)
                spans = [m.span() for m in _WORDS.finditer(text)] if segments else []
                passages.append([{"start": spans[a][0], "end": spans[b][1], "score": s} for a, b, s in segments])
            columns = [*batch.columns[:-1], pa.array(scores, pa.float64()), pa.array(passages, _ARROW_PASSAGES)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "_score", "_passages"])

    return run


def score_toxicity(docs: DataFrame, model: ToxicityModel, *, text_col: str = "text") -> DataFrame:
    """The documents with toxicity (0 to 1) and toxic_passages, an array of (start, end, score)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    wide = packed(docs, _text=F.col(f"`{text_col}`"))
    schema = T.StructType(wide.schema.fields[:1]).add("_score", T.DoubleType()).add("_passages", PASSAGES)
    results = {"toxicity": F.col("_score"), "toxic_passages": F.col("_passages")}
    return unpacked(wide.mapInArrow(_score(shared), schema), docs.columns, results)
