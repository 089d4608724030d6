"""The queries of the numbered operators over their whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm.chat import format_chats
from tradeloom.llm.common import SharedFolder
from tradeloom.llm.embedding_dedup import embedding_groups
from tradeloom.llm.hard_negatives import mine_hard_negatives
from tradeloom.llm.line_dedup import dedup_lines
from tradeloom.llm.mixing import domain_of, mix_sources
from tradeloom.llm.pieces import MARK, round_trip_pieces
from tradeloom.llm.quality_model import GOOD_FROM, fit_quality, score_quality
from tradeloom.llm.quality_rules import quality_verdicts
from tradeloom.llm.secrets import BASE_RULES, scan_secrets
from tradeloom.llm.simhash import simhash_groups
from tradeloom.llm.sql import ORACLE
from tradeloom.llm.token_files import read_tokens, write_tokens
from tradeloom.llm.toxicity import TOXIC_FROM, fit_toxicity, held_out, score_toxicity
from tradeloom.llm.vector_codes import compress_vectors

Query = Callable[[SparkSession, str], DataFrame]


def read(spark: SparkSession, directory: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{table}.parquet")


def op1_simhash_dedup(spark: SparkSession, directory: str) -> DataFrame:
    return simhash_groups(read(spark, directory, "documents"))


def op2_line_dedup(spark: SparkSession, directory: str) -> DataFrame:
    cut = dedup_lines(read(spark, directory, "documents"))
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op3_embedding_dedup(spark: SparkSession, directory: str) -> DataFrame:
    groups = embedding_groups(read(spark, directory, "embeddings"))
    return groups.select("vec_id", "n_links", "component_id", "kept")


def op4_mix_sources(spark: SparkSession, directory: str) -> DataFrame:
    mixed = mix_sources(read(spark, directory, "documents"))
    return mixed.select("doc_id", domain_of(F.col("source")).alias("domain"), "lang", "source", "n_copies")


def op5_quality_rules(spark: SparkSession, directory: str) -> DataFrame:
    verdicts = quality_verdicts(read(spark, directory, "documents"), read(spark, directory, "labels"))
    return verdicts.drop("score")


def op6_chat_format(spark: SparkSession, directory: str) -> DataFrame:
    return format_chats(read(spark, directory, "conversations"))


def op7_sentencepiece(spark: SparkSession, directory: str) -> DataFrame:
    docs = read(spark, directory, "documents").select("doc_id", "text")
    coded = round_trip_pieces(docs)
    plain = F.replace(F.coalesce("text", F.lit("")), F.lit(MARK), F.lit(" "))
    return coded.select(
        "doc_id", F.size("piece_ids").cast("bigint").alias("n_pieces"), "piece_ids", (F.col("decoded") == plain).alias("exact")
    )


def op8_quality_model(spark: SparkSession, directory: str) -> DataFrame:
    docs = read(spark, directory, "documents").select("doc_id", "text")
    scored = score_quality(docs, fit_quality(docs, read(spark, directory, "labels")))
    score = F.col("quality_score")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"),
        (score >= GOOD_FROM).cast("int").alias("predicted"),
    )


def op9_toxicity(spark: SparkSession, directory: str) -> DataFrame:
    docs = read(spark, directory, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, fit_toxicity(docs, read(spark, directory, "labels")))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= TOXIC_FROM).cast("int").alias("predicted"),
        F.size("toxic_passages").cast("bigint").alias("n_passages"),
    )


def op10_secret_scan(spark: SparkSession, directory: str) -> DataFrame:
    # Only the id and the text are read; the operator would pass any other column on.
    found = scan_secrets(read(spark, directory, "documents").select("doc_id", "text"))
    base = [rule.kind for rule in BASE_RULES]

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base_spans = F.filter("secrets", lambda s: s["kind"].isin(*base))
    digest = F.sha2(listed(base_spans), 256).alias("base_sha256")
    return found.select("doc_id", *[number(kind) for kind in base], digest, listed(F.col("secrets")).alias("spans"))


def op11_token_files(spark: SparkSession, directory: str) -> DataFrame:
    folder = SharedFolder(spark, "tokens")
    write_tokens(read(spark, directory, "documents"), folder.path)
    return read_tokens(spark, folder.path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op12_hard_negatives(spark: SparkSession, directory: str) -> DataFrame:
    rows = read(spark, directory, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 50 == 0)


def op13_vector_codes(spark: SparkSession, directory: str) -> DataFrame:
    coded, books = compress_vectors(read(spark, directory, "embeddings"))
    digest = F.lit(books.digest() if books else None).cast("string").alias("codebooks_sha256")
    return coded.select("vec_id", "code", "error", "label_error", digest)


def queries() -> dict[str, Query]:
    return {
        "op1_simhash_dedup": op1_simhash_dedup,
        "op2_line_dedup": op2_line_dedup,
        "op3_embedding_dedup": op3_embedding_dedup,
        "op4_mix_sources": op4_mix_sources,
        "op5_quality_rules": op5_quality_rules,
        "op6_chat_format": op6_chat_format,
        "op7_sentencepiece": op7_sentencepiece,
        "op8_quality_model": op8_quality_model,
        "op9_toxicity": op9_toxicity,
        "op10_secret_scan": op10_secret_scan,
        "op11_token_files": op11_token_files,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_vector_codes": op13_vector_codes,
    }


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
