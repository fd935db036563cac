"""JSON files picked up as they land."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from querytrail.functions.documents import SHAPE, extractor, shapes
from querytrail.functions.text import is_blank
from querytrail.session import ship


ACCEPTED, REJECTED = "accepted", "rejected"


def landing_stream(
    spark: SparkSession, folder: str, files_per_trigger: int = 10_000, max_file_age: str = "7d"
) -> DataFrame:
    """New *.json files of a folder, each read once: (file, payload).

    The file source logs what it has read beside the checkpoint. Files are expected to be moved
    into the folder when complete. It remembers names for `max_file_age`, and does not read a file that
    bears a time further than that before the newest one; name a longer time where old files land.
    """
    return (
        spark.readStream.format("text").option("wholetext", True)
        .option("pathGlobFilter", "*.json").option("maxFilesPerTrigger", files_per_trigger)
        .option("maxFileAge", max_file_age).load(folder)
        .select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("payload"))
    )


def once_by_content(documents: DataFrame, within: str = "30 days") -> DataFrame:
    """Each content of a stream of documents once, under whatever names and however often it lands.

    The name it came under first is kept; of several in one batch, any of them. State holds a hash of each
    content, keyed and partitioned by it, until `within` has passed since the content first came; the next
    copy is then new again. Time is that of the batch, so no file is late, whatever time it bears.
    """
    return (
        documents.withColumn("content", F.unhex(F.sha2("payload", 256)))
        .withColumn("arrived", F.current_timestamp()).withWatermark("arrived", within)
        .dropDuplicatesWithinWatermark(["content"]).select(*documents.columns)
    )


def built_in_shape(payload: Column) -> Column:
    """Shape of a JSON text by built-in functions; null where they refuse it.

    The parser ignores what follows a value, so the text is parsed inside a list and inside an
    object: no text with something after its value fits into both.
    """
    in_list = F.try_parse_json(F.concat(F.lit("["), payload, F.lit("]")))
    in_object = F.try_parse_json(F.concat(F.lit('{"a":'), payload, F.lit("}")))
    keys = F.json_object_keys(payload)
    listed = F.size(F.try_variant_get(in_list, "$[0].data", "array<variant>"))
    count = F.when(keys.isNotNull(), F.coalesce(
        F.when(listed >= 0, listed), F.size(keys))).otherwise(F.coalesce(F.json_array_length(payload), F.lit(0)))
    return F.when(in_list.isNotNull() & in_object.isNotNull(), F.struct(
        F.lit(True).alias("valid"), count.cast("long").alias("record_count"),
        F.coalesce(F.array_contains(keys, "data"), F.lit(False)).alias("has_data_field"),
        F.lit(None).cast("string").alias("error")))


def extraction_records(documents: DataFrame) -> DataFrame:
    """One record per non-blank document, batch or stream.

    `valid` is false for text that is not JSON; such rows keep the problem text and the payload.
    """
    ship(documents.sparkSession)
    shape = F.pandas_udf(shapes, SHAPE)
    seen = documents.filter(~is_blank(F.col("payload"))).withColumn("_b", built_in_shape(F.col("payload")))
    # Only what the built-in functions refuse goes to Python: broken texts, repeated keys, NaN.
    refused = F.when(F.col("_b").isNull(), F.col("payload"))
    seen = seen.withColumn("_p", shape(refused)).withColumn("_s", F.coalesce("_b", "_p"))
    return seen.select(
        F.col("file").alias("source_file"), "_s.valid", "_s.record_count", "_s.has_data_field",
        "_s.error", F.when(~F.col("_s.valid"), F.col("payload")).alias("rejected_payload"),
        F.current_timestamp().alias("processed_at"),
    )


def good_records(records: DataFrame) -> DataFrame:
    return records.filter("valid").select(
        "source_file", "record_count", "has_data_field", "processed_at")


def quarantined(records: DataFrame) -> DataFrame:
    return records.filter("not valid").select("source_file", "error", "rejected_payload")


def start_ingest(
    documents: DataFrame, target: str, checkpoint: str, available_now: bool = True,
    once_within: str | None = None,
) -> StreamingQuery:
    """Write extraction records to a table split by outcome; exactly once by the sink's log.

    Bad documents go to the `rejected` part and never stop the stream. With `once_within`, copies of a
    content that land under other names, or are written anew, in that time are left out
    (`once_by_content`); all runs on one checkpoint must agree on whether it is given.
    """
    documents = documents if once_within is None else once_by_content(documents, once_within)
    outcome = F.when(F.col("valid"), ACCEPTED).otherwise(REJECTED)
    writer = (
        extraction_records(documents).withColumn("outcome", outcome)
        .writeStream.format("parquet").outputMode("append").partitionBy("outcome").option("checkpointLocation", checkpoint).option("path", target)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def drain(query: StreamingQuery, max_wait_seconds: int | None = None) -> None:
    """Wait until everything that has landed is done, however long that takes.

    With a limit the query is stopped when it is reached, and a TimeoutError says that its output is
    incomplete; the next run on the same checkpoint goes on where it stopped.
    """
    if max_wait_seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(max_wait_seconds):
        query.stop()
        raise TimeoutError(f"the stream was stopped after {max_wait_seconds} s, before it was done")


def processing_stats(records: DataFrame) -> DataFrame:
    """Files, records, processing seconds and records per file; no row for no files."""
    stats = records.agg(
        F.count("*").alias("total_files_processed"),
        F.coalesce(F.sum("record_count"), F.lit(0)).alias("total_records_extracted"),
        (F.max("processed_at").cast("double") - F.min("processed_at").cast("double"))
        .alias("processing_duration_seconds"),
    )
    return stats.filter("total_files_processed > 0").withColumn(
        "average_records_per_file",
        F.col("total_records_extracted") / F.col("total_files_processed"))


def start_running_totals(
    documents: DataFrame, target: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Running totals over all files so far: one row per batch in a part of its own, which a repeated
    batch replaces. Readers take the last one (`latest_totals`), so none ever meets an empty folder.
    """
    totals = extraction_records(documents).filter("valid").agg(
        F.count("*").alias("total_files_processed"),
        F.sum("record_count").alias("total_records_extracted"),
        F.min("processed_at").alias("first_processed_at"),
        F.max("processed_at").alias("last_processed_at"),
    )

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    writer = totals.writeStream.outputMode("complete").option(
        "checkpointLocation", checkpoint).foreachBatch(save)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def latest_totals(spark: SparkSession, target: str) -> DataFrame:
    """The totals after the last batch that was written whole."""
    return spark.read.parquet(target).orderBy(F.col("batch").desc()).limit(1).drop("batch")


def extract_with(
    documents: DataFrame, function: Callable[[Any, str], dict], schema: T.StructType
) -> DataFrame:
    """A caller's per-file extractor: (JSON value, file name) -> record. Batch or stream."""
    return documents.select("file", "payload").mapInPandas(
        extractor(function, schema.names), schema)
