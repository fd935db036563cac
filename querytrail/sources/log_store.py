"""Query logs stored by query key, for joins that move no rows."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from querytrail.schemas import QUERY_KEY
from querytrail.session import store

PARTS = ("objects", "users", "texts")
Logs = tuple[DataFrame, DataFrame, DataFrame]


@dataclass(frozen=True)
class LogStore:
    """The object, user and text logs: bucketed by query key, and the rows of hot keys apart."""

    bucketed: Logs
    hot: Logs | None


def _hot_keys(logs: Logs, hot_rows: int) -> DataFrame:
    """Query keys with more than `hot_rows` rows in one of the logs; at most rows / hot_rows of them a log."""
    found = None
    for log in logs:
        some = log.groupBy(*QUERY_KEY).count().filter(F.col("count") > hot_rows).select(*QUERY_KEY)
        found = some if found is None else found.union(some)
    return store(found.distinct(), "hot-queries")


def write_log_store(logs: Logs, folder: str, buckets: int = 200, hot_rows: int = 1_000_000) -> LogStore:
    """Write the logs to `folder`, each in `buckets` files by query key, replacing what is there.

    Choose `buckets` so that a bucket of the largest log is some hundred megabytes. A join by key then
    reads bucket by bucket without an exchange; such a join can't be split at run time, so rows of
    queries with more than `hot_rows` rows in a log are stored apart, in every log, and are joined
    the usual way, where a hot key is split. Rows without a whole key, which no join finds, are kept among
    the others. The description of the layout comes last: a folder without one was not finished.
    """
    spark = logs[0].sparkSession
    hot = _hot_keys(logs, hot_rows)
    some_hot = not hot.isEmpty()
    for part, log in zip(PARTS, logs, strict=True):
        spark.sql(f"DROP TABLE IF EXISTS {_table(folder, part)}")
        cold = log
        if some_hot:
            log.join(hot, QUERY_KEY, "left_semi").select(*log.columns).write.mode("overwrite").parquet(
                f"{folder}/hot/{part}")
            cold = log.join(hot, QUERY_KEY, "left_anti").select(*log.columns)
        # A task holds one bucket, so a bucket is one file. Ranges of days lie together in it.
        cold.repartition(buckets, *QUERY_KEY).write.mode("overwrite").format("parquet").bucketBy(
            buckets, *QUERY_KEY).sortBy(*_order()).option("path", f"{folder}/{part}").saveAsTable(_table(folder, part))
    layout = spark.createDataFrame([(buckets, some_hot)], "buckets int, some_hot boolean")
    layout.write.mode("overwrite").parquet(f"{folder}/layout")
    return open_log_store(spark, folder)


def _order() -> list[str]:
    return ["logdate", *(c for c in QUERY_KEY if c != "logdate")]


def _table(folder: str, part: str) -> str:
    """Name of the table over one log: bucketing is known to tables only."""
    return f"querytrail_{hashlib.sha256(folder.encode()).hexdigest()[:24]}_{part}"


def open_log_store(spark: SparkSession, folder: str) -> LogStore:
    """The logs of a folder that `write_log_store` has finished, also in another session."""
    try:
        layout = spark.read.parquet(f"{folder}/layout").first()
    except AnalysisException as problem:
        raise ValueError(f"{folder} holds no finished log store") from problem
    bucketed = []
    for part in PARTS:
        name = _table(folder, part)
        if not spark.catalog.tableExists(name):
            columns = spark.read.parquet(f"{folder}/{part}").schema
            spark.sql(
                f"CREATE TABLE {name} ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in columns)}) "
                f"USING parquet CLUSTERED BY ({', '.join(QUERY_KEY)}) SORTED BY ({', '.join(_order())}) "
                f"INTO {layout.buckets} BUCKETS LOCATION '{folder}/{part}'")
        bucketed.append(spark.table(name))
    hot = tuple(spark.read.parquet(f"{folder}/hot/{part}") for part in PARTS) if layout.some_hot else None
    return LogStore(tuple(bucketed), hot)
