"""One key holds a third of the rows: results stay whole and the hot partition is split."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from querytrail.operators import databases, extraction, pairs, usage
from querytrail.schemas import EXTRACT_COLUMNS
from querytrail.session import store

N = 60_000


@pytest.fixture
def big_data_rules(spark):
    """No broadcast joins, and a partition counts as skewed at a few kilobytes."""
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(spark, name="k"):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
    return spark.range(0, N, 1, 8).select(F.col("id"), key.alias(name), F.sha2(F.col("id").cast("string"), 256).alias("text"))


def plan_after(df):
    """Row count and the final plan of that run."""
    counted = df.agg(F.count("*").alias("n"), F.sum(F.hash(*df.columns).cast("long")).alias("h"))
    n = counted.collect()[0].n
    return n, counted._jdf.queryExecution().executedPlan().toString()


def test_label_rows(spark, big_data_rules):
    rows = hot(spark, "ObjectTableName")
    data = rows.select("*", F.lit("2024-01-01").alias("logdate"), F.lit(1).alias("ProcID"), F.col("id").alias("QueryID"),
                       F.lit(1).alias("SessionID"), F.lit("drop x").alias("SQLTEXTINFO"))
    n, plan = plan_after(usage.classify_tables(data))
    assert n == N and "skew=true" in plan
    n, plan = plan_after(usage.latest_rows(data))
    assert n == N and "skew=true" in plan


def test_fill_databases(spark, big_data_rules):
    rows = hot(spark, "source_table").withColumn("target_table", F.lit("t"))
    names = rows.select(F.col("source_table").alias("table_name")).distinct().select(
        F.lit("source").alias("side"), "table_name", F.lit("D").alias("database_name"))
    n, plan = plan_after(databases.fill_databases(rows, store(names, "names")))
    assert n == N and "skew=true" in plan


def test_semi_join(spark, big_data_rules):
    rows = hot(spark, "db").withColumn("table", F.lit("t"))
    wanted = rows.select("db", "table").distinct()
    n, plan = plan_after(pairs.semi_join_pairs(rows, wanted))
    assert n == N and "skew=true" in plan


def test_hot_query_in_the_object_log(spark, big_data_rules):
    query = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id"))
    day = F.lit("2024-01-01").cast("date")
    objects = spark.range(0, N, 1, 8).select(
        F.lit(1).alias("ProcID"), query.alias("QueryID"), day.alias("logdate"), F.lit("d").alias("ObjectDatabaseName"),
        F.sha2(F.col("id").cast("string"), 256).alias("ObjectTableName"), F.lit(None).cast("timestamp_ntz").alias("CollectTimeStamp"))
    keys = objects.select("ProcID", "QueryID", "logdate").distinct()
    users = keys.select("*", F.lit(1).alias("SessionID"), F.lit("Insert").alias("StatementType"), F.lit("u").alias("Username"))
    texts = keys.select("*", F.lit("x").alias("SQLTEXTINFO"))
    n, plan = plan_after(extraction.join_logs(objects, users, texts).select(*EXTRACT_COLUMNS))
    assert n == N and "skew=true" in plan


def test_copies_do_not_multiply(spark):
    """2 000 copies of one query in two logs: 4 million pairs if joined first."""
    day = F.lit("2024-01-01").cast("date")
    key = [F.lit(1).alias("ProcID"), F.lit(7).alias("QueryID"), day.alias("logdate")]
    many = spark.range(2000)
    objects = many.select(*key, F.lit("d").alias("ObjectDatabaseName"), F.lit("t").alias("ObjectTableName"), F.lit(None).cast("timestamp_ntz").alias("CollectTimeStamp"))
    users = many.limit(1).select(*key, F.lit(1).alias("SessionID"), F.lit("Insert").alias("StatementType"), F.lit("u").alias("Username"))
    texts = many.select(*key, F.lit("x").alias("SQLTEXTINFO"))
    assert extraction.join_distinct(objects, users, texts).count() == 1
