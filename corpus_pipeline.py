"""From documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) with the documents that the stage before kept. All but the
last return the columns of `documents`. `n_chars` follows the text. Null texts, empty tables and
further columns pass through as the operators' docstrings say.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from querytrail.llm import lines, mixing, packing, quality, simhash
from querytrail.session import ship, store, tune, work_folder

SHINGLE_WORDS = 3
DISTANCE = 2


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the n-gram model rejects go."""
    ship(tune(spark))
    trusted = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1").select("doc_id")
    return quality.apply_rules(docs, trusted).filter("kept").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go; documents stay. Exact copies are one page, as they don't make
    their own lines boilerplate."""
    tune(spark)
    cleaned = lines.drop_boilerplate(docs, distinct=True).select(*docs.columns)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cleaned = cleaned.withColumn("n_chars", F.char_length("text").cast(kind))
    return cleaned


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id.

    Groups are those of `simhash.near_duplicates`: fingerprints of three-word shingles, linked at two or
    fewer differing bits. Texts without words share fingerprint zero and are one group. Rows that share
    an id stand or fall together; rows without an id stay.
    """
    ship(tune(spark))
    groups = simhash.near_duplicates(docs.select("doc_id", "text"), size=SHINGLE_WORDS, distance=DISTANCE)
    # Stored, the ids of the copies have a known size: the texts are shuffled only if it is large.
    copies = store(groups.filter(F.col("doc_id") != F.col("component_id")).select("doc_id"), "copies")
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that sources, languages and topics meet their target weights."""
    tune(spark)
    mixed = mixing.mix(docs, mixing.TARGETS, mixing.classes_of_documents(), keep_other=True)
    return mixed.filter("sampled").select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens and their places in sequences."""
    ship(tune(spark))
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources", mixing_sources),
    ("best-fit packing", best_fit_packing),
]

# Hashes of shingles and n-grams and token ids have no counterpart in plain SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other; each one's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = work_folder(spark, f"pipeline-{uuid.uuid4().hex[:8]}")
    for no, (_, stage) in enumerate(STAGES):
        result = stage(spark, docs, sf_dir)
        if no == len(STAGES) - 1:
            return result
        path = f"{folder}/{no}"
        result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
    return docs


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return run(spark, folder)


QUERIES = {"pipeline": pipeline}
CHECKS: dict[str, str] = {}
