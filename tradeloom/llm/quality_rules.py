"""Quality rules: base counts and a hashed n-gram log-likelihood ratio, in DataFrame operations only.

Words and word pairs are hashed into 2 x 65,536 buckets. Two multinomials over the buckets are
counted over all documents: the raw corpus, and the trusted target, which is every document that the
labels call good. Each has a Dirichlet prior of
the same relative strength, so that a rare bucket says little. A document's score is the sum of
log(target / raw) over its words and pairs, divided by their number; documents below a fixed threshold
are rejected, and so are those that fail the base rules. Logarithms are kept as whole millionths, so a
sum does not depend on the order in which Spark adds.

One hash per word serves both kinds: a pair's bucket joins half of each word's hash. The texts are read
once: base counts and two bytes per word are kept in the checkpoint folder, and both the counting of the
buckets and the scores begin there. Buckets are grouped and joined by a 64-bit number instead of their
digits; no two of the buckets have the same. Words are counted in the map tasks before anything moves, so
the shuffles hold buckets and one row per document, never texts. At most BROADCAST_IDS trusted ids are
broadcast; where there are more, they meet the documents by a shuffle join, to which a document brings two
bytes per word. The table of logarithms has a fixed size and is broadcast.

Words that stand in five-word windows found twice are counted inside the row: the window hashes are
sorted, and equal neighbours are repeats.

Defined cases: a null text has no words, one with no words has score 0 and fails the base rules; texts
are counted whole; repeated rows are counted each, in the multinomials too; a label without a document
is ignored, a document with several labels is trusted if one of them is 1, a null id is never trusted;
with no trusted document every score is 0; an empty table gives an empty result. Only
the id and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import SPACES, checkpointed

BUCKETS = 65_536  # of words, and as many of pairs
BROADCAST_IDS = 500_000  # trusted ids that are broadcast, some 30 MB of whole numbers; more of them are shuffled
PRIOR = 16.0  # imagined occurrences per bucket, in which the target has its overall share
THRESHOLD = -0.2  # mean log-likelihood ratio per word or pair
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
SYMBOLS = "#*$%&|<>"
_MICRO = 1_000_000
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _settled(df: DataFrame, *columns: Column) -> DataFrame:
    """The columns, computed once: later lambdas read them instead of computing them per element."""
    return df.select(F.inline(F.array(F.struct(*columns))))


def _words(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[\x20\x09-\x0d]+"))


def _symbol_count(text: Column) -> Column:
    return F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", ""))


def _codes(words: Column | str) -> Column:
    return F.transform(words, lambda w: F.substring(F.md5(w), 1, 4))


def _packed_codes(words: Column | str) -> Column:
    """The codes of all words, two bytes each."""
    return F.unhex(F.array_join(_codes(words), ""))


def _bucket_keys(codes: Column, at: Column) -> tuple[Column, Column]:
    """Numbers of the word's bucket at a place in the packed codes and of the pair that it begins, null at
    the end."""
    byte = lambda k, size=1: F.substring(codes, 2 * at + k, F.lit(size))
    pair = F.when(2 * at + 4 <= F.octet_length(codes), F.xxhash64(byte(1), byte(4)))
    return F.xxhash64(byte(1, 2)), pair


def _with_buckets(docs: DataFrame, *keep: str) -> DataFrame:
    """One row per word of `codes`: its bucket and that of the pair it begins, null at the end. A
    document without words is one row without buckets."""
    words = F.octet_length("codes") / 2
    places = F.when(words > 0, F.sequence(F.lit(0), words.cast("int") - 1))
    word, pair = _bucket_keys(F.col("codes"), F.col("_at"))
    known = F.col("_at").isNotNull()
    placed = docs.select(*keep, "codes", F.explode_outer(places).alias("_at"))
    return placed.select(*keep, F.when(known, word).alias("word"), F.when(known, pair).alias("pair"))


def bucket_weights(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """(is_pair, gram, micro): millionths of log(target / raw) per bucket; both counts cover all documents."""
    texts = docs.select(F.col(id_col).alias(id_col), _words(F.col(text_col)).alias("words"))
    return _weights(_settled(texts, F.col(id_col), _packed_codes("words").alias("codes")), labels, id_col, label_col, broadcast_ids)


def _weights(coded: DataFrame, labels: DataFrame, id_col: str, label_col: str, broadcast_ids: int) -> DataFrame:
    """bucket_weights of documents whose words are packed codes."""
    trusted = labels.where((F.col(label_col) == 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("_trusted")).distinct()
    few = trusted.limit(broadcast_ids + 1).count() <= broadcast_ids
    own = coded.select(F.col(id_col).alias("_id"), "codes")
    marked = own.join(trusted.hint("broadcast" if few else "shuffle_merge"), F.col("_id") == F.col("_trusted"), "left")
    placed = _with_buckets(marked.select(F.col("_trusted").isNotNull().cast("bigint").alias("good"), "codes"), "good")
    grams = placed.unpivot("good", ["word", "pair"], "kind", "gram").where(F.col("gram").isNotNull())
    kind = (F.col("kind") == "pair").alias("is_pair")
    counts = checkpointed(grams.groupBy(kind, "gram").agg(F.count("*").alias("raw"), F.sum("good").alias("good")))
    totals = counts.groupBy(F.col("is_pair").alias("pairs")).agg(F.sum("raw").alias("all_raw"), F.sum("good").alias("all_good"))
    share = F.col("all_good") / F.col("all_raw")
    ratio = (F.col("good") + PRIOR * share) / ((F.col("raw") + PRIOR) * share)
    known = F.when(F.col("all_good") > 0, F.round(F.log(ratio) * float(_MICRO)).cast("bigint"))
    micro = F.coalesce(known, F.lit(0)).alias("micro")
    # Two rows of totals; the result has at most 2 * BUCKETS rows, whatever the input.
    return checkpointed(counts.join(F.broadcast(totals), F.col("is_pair") == F.col("pairs")).select("is_pair", "gram", micro))


def base_counts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, id_col, the COUNTS, codes) per document; codes are the hashes of its words, packed."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    start = _settled(
        docs,
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias(id_col),
        _words(text).alias("words"),
        F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "").alias("lines"),
        _symbol_count(text).cast("bigint").alias("n_symbols"),
    )
    counted = _settled(
        start,
        "row",
        id_col,
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
        _packed_codes("words").alias("codes"),
    )
    kept = ["row", id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "codes"]
    last = F.size("hashes") - WINDOW + 1
    window = lambda h, i: F.xxhash64(h, *[F.get("hashes", i + k) for k in range(1, WINDOW)])
    windows = F.when(last > 0, F.transform(F.slice("hashes", 1, last), window))
    windowed = _settled(counted, *kept, F.coalesce(windows, F.array().cast("array<bigint>")).alias("windows"))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    ordered = _settled(windowed, *kept, F.when(repeats, placed).alias("placed"))
    equal = lambda x, j: (F.get("placed", j - 1)["h"] == x["h"]) | (F.get("placed", j + 1)["h"] == x["h"])
    again = F.filter("placed", lambda x, j: F.coalesce(equal(x, j), F.lit(False)))
    starts = F.sort_array(F.transform(again, lambda x: x["i"]))
    found = _settled(ordered, *kept, F.when(F.col("placed").isNotNull(), starts).alias("starts"))
    reach = lambda i, j: F.least(F.lit(WINDOW), F.coalesce(F.get("starts", j + 1) - i, F.lit(WINDOW)))
    covered = F.aggregate(F.transform("starts", reach), F.lit(0), lambda total, x: total + x)
    return found.select(*kept, F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"))


def quality_verdicts(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    threshold: float = THRESHOLD,
    broadcast_ids: int = BROADCAST_IDS,
) -> DataFrame:
    """id_col, the COUNTS, base_failed, score (mean log-likelihood ratio) and kept, per document."""
    counted = checkpointed(base_counts(docs, id_col, text_col))
    weights = _weights(counted, labels, id_col, label_col, broadcast_ids)
    of_words = weights.where(~F.col("is_pair")).select(F.col("gram").alias("word"), F.col("micro").alias("of_word"))
    of_pairs = weights.where("is_pair").select(F.col("gram").alias("pair"), F.col("micro").alias("of_pair"))
    keys = ["row", id_col, *COUNTS]
    placed = _with_buckets(counted, *keys)
    placed = placed.join(F.broadcast(of_words), "word", "left").join(F.broadcast(of_pairs), "pair", "left")
    micro = F.coalesce("of_word", F.lit(0)) + F.coalesce("of_pair", F.lit(0))
    n_grams = F.greatest(2 * F.col("n_words") - 1, F.lit(0))
    scored = placed.groupBy(*keys).agg(F.sum(micro).alias("micro")).withColumn("n_grams", n_grams)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    limit = F.col("n_grams") * round(threshold * _MICRO)
    score = F.col("micro") / F.greatest(F.col("n_grams"), F.lit(1)) / float(_MICRO)
    return scored.select(
        id_col,
        *COUNTS,
        failed.alias("base_failed"),
        F.round(score, 6).alias("score"),
        (~failed & (F.col("micro") >= limit)).alias("kept"),
    )
