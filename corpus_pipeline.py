"""The corpus pipeline: five stages over `documents`, each written as Parquet and read by the next.

toxicity      documents that the toxicity operator rejects go
line_dedup    lines that many documents share stay in one of them; n_chars follows the new text
simhash       one document of each group of near copies stays
mixing        sources are mixed to their target weights; a document taken twice is two rows
sentencepiece what is left is encoded into pieces, and decoded again to see that nothing was lost

Every stage but the last returns the columns of its input, in their order; columns that are named like
a result of an operator are set aside meanwhile. The defined cases of nulls, empty texts, repeated rows
and empty tables are those of the operators. A stage works on all rows that it gets.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm.common import SharedFolder
from tradeloom.llm.line_dedup import dedup_lines
from tradeloom.llm.mixing import mix_sources
from tradeloom.llm.pieces import MARK, round_trip_pieces
from tradeloom.llm.simhash import drop_near_copies
from tradeloom.llm.toxicity import TOXIC_FROM, fit_toxicity, score_toxicity
from tradeloom.session import ship_package

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _with_results(docs: DataFrame, names: list[str], operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The operator's results beside the input columns; input columns of the same names are set aside."""
    aside = {name: f"_aside_{name}" for name in names if name in docs.columns}
    return operator(docs.withColumnsRenamed(aside))


def _back(done: DataFrame, columns: list[str], names: list[str]) -> DataFrame:
    """The input columns in their order, without the results."""
    return done.select(*[F.col(f"_aside_{name}" if name in names else f"`{name}`").alias(name) for name in columns])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    names = ["toxicity", "toxic_passages"]
    model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = _with_results(docs, names, lambda rows: score_toxicity(rows, model))
    return _back(scored.where(F.col("toxicity") < TOXIC_FROM), docs.columns, names)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    names = ["n_lines", "n_dropped"]
    cut = _back(_with_results(docs, names, dedup_lines), docs.columns, names)
    kind = dict(docs.dtypes).get("n_chars")
    return cut.withColumn("n_chars", F.length("text").cast(kind)) if kind else cut


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    names = ["n_copies"]
    mixed = _with_results(docs, names, mix_sources).where(F.col("n_copies") > 0)
    repeated = mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("n_copies"))))
    return _back(repeated, docs.columns, names)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_chars, n_pieces, piece_ids, and whether they decode to the text."""
    columns = [name for name in ("doc_id", "lang", "source", "n_chars") if name in docs.columns]
    coded = round_trip_pieces(docs.select(*columns, "text"))
    plain = F.replace(F.coalesce("text", F.lit("")), F.lit(MARK), F.lit(" "))
    number = F.size("piece_ids").cast("bigint").alias("n_pieces")
    return coded.select(*columns, number, "piece_ids", (F.col("decoded") == plain).alias("exact"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("simhash", simhash),
    ("mixing", mixing),
    ("sentencepiece", sentencepiece),
]
# A learned score and a search for the best pieces are beyond SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; the last one's result is computed when it is read."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = SharedFolder(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        result = stage(spark, docs, sf_dir)
        if number + 1 == len(STAGES):
            return result
        result.write.parquet(f"{folder.path}/{name}")
        docs = spark.read.parquet(f"{folder.path}/{name}")
        if number:
            folder.delete(STAGES[number - 1][0])
    return docs
