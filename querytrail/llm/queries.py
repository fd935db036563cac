"""The registered queries of this subpackage and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from querytrail.llm import (
    alignment, chat, contamination, lines, mixing, packing, quality, secrets, simhash, spelling, substrings,
    toxicity, vectors,
)
from querytrail.session import ship, tune


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return ship(tune(spark)).read.parquet(f"{folder}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs)
    return found.select(
        "doc_id", simhash.hex_digits(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.remove_repeats(_table(spark, folder, "documents").select("doc_id", "text"))


def op3_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    turns = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    marked = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-7, 0, "user", marked), (-7, 1, "assistant", marked)], turns.schema)
    return chat.read_back(chat.format_conversations(turns.union(extra)))


def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return secrets.digest(secrets.find_secrets(docs))


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "source", "text")
    return lines.drop_boilerplate(docs)


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    trusted = _table(spark, folder, "labels").filter("quality = 1").select("doc_id")
    return quality.apply_rules(docs, trusted).drop("text")


def op7_mixing_sources(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "source", "lang", "text")
    return mixing.mix(docs, mixing.TARGETS, mixing.classes_of_documents(), keep_other=True).drop("text")


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return toxicity.score(docs, toxicity.train(docs, _table(spark, folder, "labels")))


def op9_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    return vectors.near_duplicate_vectors(rows)


def op10_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


def op11_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    vocabularies = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    digest = F.when(F.col("groups") != "", F.sha2("groups", 256)).otherwise("")
    # The groups' texts are several times as large as the documents, so only their digests are kept.
    aligned = alignment.align(docs, *vocabularies).withColumn("groups_sha256", digest).drop("groups")
    return alignment.rate_links(aligned).select(
        F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    benchmark = _table(spark, folder, "benchmark").select("item_id", "text")
    return contamination.mark_contaminated(docs, benchmark).drop("text")


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return spelling.spelling_variants(docs, reading=spelling.with_slips)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_simhash_near_dedup, op2_substring_dedup, op3_chat_formatting, op4_secret_scan,
        op5_line_dedup, op6_quality_rules, op7_mixing_sources, op8_toxicity,
        op9_embedding_near_dedup, op10_best_fit_packing, op11_tokenizer_alignment,
        op12_benchmark_decontamination, op13_spelling_variants)
}

CHECKS: dict[str, str] = {
    "op5_line_dedup": lines.check_sql(), "op7_mixing_sources": mixing.check_sql(),
    "op12_benchmark_decontamination": contamination.check_sql(),
}
