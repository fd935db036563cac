"""What must reach the scan does."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from querytrail.operators import extraction, pairs, usage
from querytrail.plans.standins import Tables
from querytrail.sources import tables
from querytrail.session import work_folder

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored_logs(spark):
    t = Tables(spark, FOLDER)
    base = work_folder(spark, "plan-logs")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    for name in ("v_obj", "v_log", "v_sql"):
        t[name].withColumn("logdate", F.trunc("logdate", "month")).write.partitionBy("logdate").parquet(f"{base}/{name}")
    return tables.read_query_log(spark, *[f"{base}/{n}" for n in ("v_obj", "v_log", "v_sql")])


def scans(df) -> list[str]:
    text = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in text.splitlines() if "FileScan" in line]


def test_fetch_prunes_partitions_of_all_three_logs(stored_logs):
    df = extraction.fetch(*stored_logs, "db1", ["t1", "t2"], "Insert", "1997-01-01", "1997-06-30")
    found = scans(df)  # dynamic pruning may scan a log once more
    assert {re.search(r"/(v_\w+)\]", line)[1] for line in found} == {"v_obj", "v_log", "v_sql"}
    for line in found:
        filters = re.search(r"PartitionFilters: \[(.*?)\], Pushed", line)[1]
        assert ">=" in filters and "<=" in filters, line
    objects = next(line for line in found if "ObjectDatabaseName" in line)
    assert "EqualTo(ObjectDatabaseName,db1)" in objects and "In(ObjectTableName" in objects


def test_work_list_extraction_prunes_partitions(spark, stored_logs):
    batches = spark.createDataFrame([("db1", "t1", 1)], "db string, `table` string, batch_number int")
    df = extraction.extract_work_list(
        batches, *stored_logs, ["Insert"], F.lit("1997-01-01").cast("date"), F.lit("1997-06-30").cast("date"))
    for line in scans(df):
        assert ">=" in re.search(r"PartitionFilters: \[(.*?)\], Pushed", line)[1], line


def test_pair_filter_reads_few_columns_and_pushes(spark, stored_logs):
    df = pairs.filter_pairs(
        stored_logs[0].select("QueryID", "ObjectDatabaseName", "ObjectTableName"), [("db1", "t1"), ("db2", "t2")],
        "ObjectDatabaseName", "ObjectTableName")
    (line,) = scans(df)
    assert "Or(And(EqualTo(ObjectDatabaseName,db1)" in line
    assert "CollectTimeStamp" not in line


def test_facts_use_hash_aggregates_only_until_the_last_step(spark):
    plan = usage.table_facts(Tables(spark, FOLDER)["v_usage"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortAggregate") <= 2 and "Window" not in plan and "Join" not in plan


def test_caller_lists_are_broadcast_by_size(spark, stored_logs):
    df = pairs.semi_join_pairs(
        stored_logs[0], pairs.pair_frame(spark, [("db1", "t1")]), "ObjectDatabaseName", "ObjectTableName")
    assert "BroadcastHashJoin" in df._jdf.queryExecution().executedPlan().toString()
