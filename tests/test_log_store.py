"""Logs stored by query key: joins without an exchange, hot queries apart."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from querytrail import jobs
from querytrail.operators import extraction
from querytrail.sources import log_store

KEY = "ProcID long, QueryID long, logdate date"


@pytest.fixture
def no_broadcasts(spark):
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def logs(spark, hot=0):
    """Queries with three object rows each, one with `hot` rows, and rows without a key."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("QueryID") % 40).cast("int"))
    ids = spark.range(300).select((F.col("id") % 2).alias("ProcID"), F.col("id").alias("QueryID"))
    key = ids.withColumn("logdate", day)
    many = spark.range(3).withColumnRenamed("id", "n")
    objects = key.crossJoin(many).select("*", F.lit("d").alias("ObjectDatabaseName"))
    if hot:
        one = key.filter("QueryID = 7").crossJoin(spark.range(hot).withColumnRenamed("id", "n"))
        objects = objects.union(one.select("*", F.lit("hot").alias("ObjectDatabaseName")))
    objects = objects.withColumn("ObjectTableName", F.sha2(F.col("n").cast("string"), 256)).drop("n")
    objects = objects.withColumn("CollectTimeStamp", F.lit("2024-01-01").cast("timestamp_ntz"))
    bare = spark.createDataFrame([(None, 5, None)], KEY)
    users = key.union(bare).select("*", F.lit(1).alias("SessionID"), F.lit("Insert ").alias("StatementType"), F.lit("u").alias("Username"))
    return objects, users, key.union(bare).withColumn("SQLTEXTINFO", F.lit("x"))


def same(one, two):
    return sorted(map(str, one.collect())) == sorted(map(str, two.select(*one.columns).collect()))


def test_a_store_is_joined_without_an_exchange(spark, tmp_path, no_broadcasts):
    given = logs(spark)
    stored = log_store.write_log_store(given, str(tmp_path / "s"), buckets=4)
    assert stored.hot is None
    joined = extraction.join_stored_logs(stored)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert same(joined, extraction.join_logs(*given)) and joined.count() == 900
    assert stored.bucketed[1].count() == 301  # rows without a key are kept


def test_hot_queries_are_split(spark, tmp_path, no_broadcasts):
    given = logs(spark, hot=20_000)
    stored = log_store.write_log_store(given, str(tmp_path / "s"), buckets=4, hot_rows=1000)
    assert [log.count() for log in stored.hot] == [20_003, 1, 1]
    assert stored.bucketed[0].count() == 897
    cold = extraction.join_logs(*stored.bucketed)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in cold
    joined = extraction.join_stored_logs(stored)
    assert same(joined.groupBy("ObjectDatabaseName").count(), extraction.join_logs(*given).groupBy("ObjectDatabaseName").count())
    run = joined.agg(F.sum(F.hash(*joined.columns).cast("long")))
    run.collect()
    assert "skew=true" in run._jdf.queryExecution().executedPlan().toString()


def test_a_store_is_opened_again_and_replaced(spark, tmp_path, no_broadcasts):
    given, folder = logs(spark), str(tmp_path / "s")
    with pytest.raises(ValueError):
        log_store.open_log_store(spark, folder)
    log_store.write_log_store(given, folder, buckets=4)
    for part in log_store.PARTS:  # as another session finds it
        spark.sql(f"DROP TABLE {log_store._table(folder, part)}")
    again = extraction.join_stored_logs(log_store.open_log_store(spark, folder))
    assert "Exchange" not in again._jdf.queryExecution().executedPlan().toString() and again.count() == 900
    for log, name in zip(given, "out", strict=True):
        log.filter("QueryID < 10").write.parquet(str(tmp_path / name))
    replaced = jobs.store_logs(spark, *(str(tmp_path / n) for n in "out"), folder, buckets=2)
    assert extraction.join_stored_logs(replaced).count() == 30
    empty = log_store.write_log_store(tuple(log.limit(0) for log in given), str(tmp_path / "none"), buckets=2)
    assert extraction.join_stored_logs(empty).count() == 0
