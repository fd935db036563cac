"""Script files, log files and JSON documents as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from querytrail.schemas import FILE_METADATA
from querytrail.session import store

# Depth of nested JSON is a matter of the data here: one tree level takes two JSON levels.
DEEP_JSON = {"maxNestingDepth": "1000000", "maxStringLen": "2000000000"}


def read_whole_files(spark: SparkSession, folder: str, glob: str, out: str) -> DataFrame:
    """One row per file. Spark's file sources leave out files of zero bytes."""
    return (
        spark.read.text(folder, wholetext=True, pathGlobFilter=glob)
        .select(F.col("_metadata.file_name").alias("file"), F.col("value").alias(out))
    )


def read_scripts(spark: SparkSession, folder: str) -> DataFrame:
    """Every *.txt of a folder: (file, script)."""
    return read_whole_files(spark, folder, "*.txt", "script")


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Every *.json of a folder: (file, payload)."""
    return read_whole_files(spark, folder, "*.json", "payload")


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with their 1-based number in the file: (file, line_no, line).

    Files stay splittable: lines are numbered per file split, and the line counts of the splits
    before it (one row per split) are added.
    """
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("value").alias("line"),
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        raw.groupBy("file", "block").agg(F.min("seq").alias("first"), F.count("*").alias("n"))
        .withColumn("skip", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .select("file", "block", "first", "skip")
    )
    # Stored, the one row per split has a known size, so the lines themselves need not be shuffled.
    blocks = store(blocks, "log-splits")
    return raw.join(blocks, ["file", "block"]).select(
        "file", (F.col("skip") + F.col("seq") - F.col("first") + 1).alias("line_no"), "line"
    )


def file_metadata(documents: DataFrame) -> DataFrame:
    """Only the metadata part of each document; null fields when it is absent."""
    inner = FILE_METADATA.simpleString()
    parsed = F.from_json("payload", f"metadata {inner}", DEEP_JSON)["metadata"]
    return documents.select("file", parsed.alias("m")).select("file", "m.*")
