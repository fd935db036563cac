"""Landing JSON files, read as a stream until everything present is done."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from querytrail.plans.registry import query
from querytrail.plans.standins import Tables
from querytrail.session import work_folder
from querytrail.sources import sinks
from querytrail.streaming import landing

_DOCS = """
SELECT 'c' || conv_id || '-' || turn AS file, conv_id, turn, role, length(text) AS n, CASE turn % 4 WHEN 0 THEN 'object' WHEN 1 THEN 'list'
  WHEN 2 THEN CASE WHEN conv_id % 5 = 0 THEN 'broken' ELSE 'data' END ELSE CASE WHEN conv_id % 3 = 0 THEN 'blank' ELSE 'number' END END AS form
FROM {conversations}"""
_GOOD = f"""
SELECT file AS source_file, CAST(CASE form WHEN 'object' THEN 3 WHEN 'list' THEN 2 WHEN 'data' THEN 4 ELSE 0 END AS BIGINT) AS record_count,
  form = 'data' AS has_data_field FROM ({_DOCS}) d WHERE form NOT IN ('blank', 'broken')"""


def documents(turns):
    """(file, payload) from conversation turns: objects, lists, data lists, broken, blank, numbers."""
    name = F.concat(
        F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"))
    full = F.to_json(F.struct("turn", "role", "text"))
    kind = F.col("turn") % 4
    payload = (
        F.when(kind == 0, full)
        .when(kind == 1, F.concat(F.lit("["), full, F.lit(", 1]")))
        .when((kind == 2) & (F.col("conv_id") % 5 == 0), F.concat(full, F.lit(" {")))
        .when(kind == 2, F.concat(F.lit('{"data": [1, 2, 3, '), full, F.lit('], "more": {}}')))
        .when(F.col("conv_id") % 3 == 0, F.lit(" \n"))
        .otherwise(F.col("conv_id").cast("string"))
    )
    return turns.select(name.alias("file"), payload.alias("payload"))


def turn_stream(t: Tables):
    """The conversations table as a file stream, be it one file or a folder of files: of a glob, the source
    does not ask that it be a folder."""
    return t.spark.readStream.schema(t["conversations"].schema).parquet(f"{t.folder}/conversations.parque[t]")


def ingest(t: Tables):
    """Run the stream over what is there and read its output table."""
    folder = work_folder(t.spark, "ingest")
    started = landing.start_ingest(documents(turn_stream(t)), f"{folder}/out", f"{folder}/checkpoint")
    landing.drain(started)
    return t.spark.read.parquet(f"{folder}/out")


def _drop_files(t: Tables, folder: str) -> None:
    """One JSON file per conversation, with its turns as the list `data`."""
    turns = t["conversations"]
    data = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    files = turns.repartition(sinks.shuffle_parts(turns), "conv_id").groupBy("conv_id").agg(data.alias("data"))
    sinks.write_files(files.select("data"), folder, "json")


@query("st1_landing_folder_stream", """
SELECT CAST(sum(n) AS BIGINT) AS records, count(*) AS files FROM (SELECT CAST(count(*) AS BIGINT) AS n FROM {conversations} GROUP BY conv_id) c""")
def landing_folder_stream(t):
    folder = work_folder(t.spark, "landing")
    _drop_files(t, f"{folder}/in")
    stream = landing.landing_stream(t.spark, f"{folder}/in/*")
    landing.drain(landing.start_ingest(stream, f"{folder}/out", f"{folder}/checkpoint"))
    return landing.good_records(t.spark.read.parquet(f"{folder}/out")).agg(
        F.sum("record_count").alias("records"), F.count("*").alias("files"))


@query("st2_each_file_once", f"SELECT count(*) AS records, count(DISTINCT source_file) AS files FROM ({_GOOD}) g")
def each_file_once(t):
    folder = work_folder(t.spark, "once")
    for _ in range(2):  # the second run finds nothing new on the same checkpoint
        landing.drain(landing.start_ingest(
            documents(turn_stream(t)), f"{folder}/out", f"{folder}/checkpoint"))
    return landing.good_records(t.spark.read.parquet(f"{folder}/out")).agg(
        F.count("*").alias("records"), F.countDistinct("source_file").alias("files"))


_CONTENTS = """
SELECT DISTINCT form, CASE WHEN form = 'number' THEN conv_id END AS c, CASE WHEN form <> 'number' THEN turn END AS t,
  CASE WHEN form <> 'number' THEN role END AS r, CASE WHEN form <> 'number' THEN text END AS x
FROM (SELECT *, CASE turn % 4 WHEN 0 THEN 'object' WHEN 1 THEN 'list' WHEN 2 THEN 'data' ELSE 'number' END AS form
  FROM {conversations} WHERE NOT (turn % 4 = 2 AND conv_id % 5 = 0) AND NOT (turn % 4 = 3 AND conv_id % 3 = 0)) d"""


@query("st2_each_content_once", f"""
SELECT CAST(CASE form WHEN 'object' THEN 3 WHEN 'list' THEN 2 WHEN 'data' THEN 4 ELSE 0 END AS BIGINT) AS record_count,
  form = 'data' AS has_data_field, count(*) AS files FROM ({_CONTENTS}) c GROUP BY 1, 2""")
def each_content_once(t):
    folder = work_folder(t.spark, "contents")
    for _ in range(2):
        # Every document lands under two names; the second run meets the state that the first one left.
        once = documents(turn_stream(t))
        names = F.explode(F.array("file", F.concat("file", F.lit("-copy")))).alias("file")
        landing.drain(landing.start_ingest(
            once.select(names, "payload"), f"{folder}/out", f"{folder}/checkpoint", once_within="30 days"))
    return landing.good_records(t.spark.read.parquet(f"{folder}/out")).groupBy(
        "record_count", "has_data_field").agg(F.count("*").alias("files"))


@query("st3_extraction_records", f"SELECT * FROM ({_GOOD}) g")
def extraction_records(t):
    return landing.good_records(ingest(t)).drop("processed_at")


@query("st4_bad_documents_quarantined", f"SELECT file AS source_file, true AS has_payload FROM ({_DOCS}) d WHERE form = 'broken'")
def bad_documents_quarantined(t):
    return landing.quarantined(ingest(t)).select(
        "source_file", (F.length("rejected_payload") > 0).alias("has_payload"))


@query("st5_drain_and_stop", f"SELECT has_data_field, count(*) AS files FROM ({_GOOD}) g GROUP BY 1")
def drain_and_stop(t):
    folder = work_folder(t.spark, "drain")
    started = landing.start_ingest(documents(turn_stream(t)), f"{folder}/out", f"{folder}/checkpoint")
    landing.drain(started)
    return landing.good_records(t.spark.read.parquet(f"{folder}/out")).groupBy(
        "has_data_field").agg(F.count("*").alias("files"))


_TOTALS = f"""
SELECT count(*) AS total_files_processed, CAST(sum(record_count) AS BIGINT) AS total_records_extracted FROM ({_GOOD}) g"""


@query("st6_running_totals", _TOTALS)
def running_totals(t):
    folder = work_folder(t.spark, "totals")
    landing.drain(landing.start_running_totals(
        documents(turn_stream(t)), f"{folder}/out", f"{folder}/checkpoint"))
    return landing.latest_totals(t.spark, f"{folder}/out").select(
        "total_files_processed", "total_records_extracted")


@query("fn12_json_record_counts", f"SELECT * FROM ({_GOOD}) g")
def json_record_counts(t):
    return landing.good_records(landing.extraction_records(documents(t["conversations"]))).drop(
        "processed_at")


@query("ag18_ingest_statistics", f"""
SELECT *, true AS has_duration, total_records_extracted / total_files_processed AS average_records_per_file FROM ({_TOTALS}) t""")
def ingest_statistics(t):
    records = landing.good_records(landing.extraction_records(documents(t["conversations"])))
    return landing.processing_stats(records).select(
        "total_files_processed", "total_records_extracted",
        (F.col("processing_duration_seconds") >= 0).alias("has_duration"),
        "average_records_per_file")


def _turn_and_role(value, file: str) -> dict:
    inner = value if isinstance(value, dict) else {}
    return {"file": file, "role": inner.get("role"), "n": len(inner.get("text") or "")}


@query("ud1_caller_file_extractor", f"""
SELECT file, CASE WHEN form = 'object' THEN role END AS role, CAST(CASE WHEN form = 'object' THEN n ELSE 0 END AS BIGINT) AS n
FROM ({_DOCS}) d WHERE form NOT IN ('blank', 'broken')""")
def caller_file_extractor(t):
    schema = T.StructType([
        T.StructField("file", T.StringType()), T.StructField("role", T.StringType()),
        T.StructField("n", T.LongType())])
    return landing.extract_with(documents(t["conversations"]), _turn_and_role, schema)
