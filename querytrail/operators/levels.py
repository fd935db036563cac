"""Level-by-level expansion of a set of tables along lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querytrail.session import work_folder

PAIR = ["db", "table"]


def next_frontier(
    output: DataFrame, previous_input: DataFrame | None
) -> DataFrame:
    """Distinct targets of a level's output that were not in that level's own input.

    Missing target columns give an empty frontier; without usable input all targets count.
    """
    if not {"target_db", "target_table"} <= set(output.columns):
        empty = output.sparkSession.createDataFrame([], "db string, `table` string")
        return empty
    targets = output.select(
        F.col("target_db").alias("db"), F.col("target_table").alias("table")).distinct()
    if previous_input is None or not set(PAIR) <= set(previous_input.columns):
        return targets
    return targets.join(previous_input.select(*PAIR), PAIR, "left_anti")


def expand_levels(
    edges: DataFrame, seeds: DataFrame, max_levels: int, exclude_all: bool = False
) -> DataFrame:
    """(level, db, table): level 1 holds the seeds, each next level the next frontier.

    `edges` has (db, table, target_db, target_table). Only the previous level is excluded, so a
    table may come back later and `max_levels` ends a cycle; `exclude_all` visits a table once.
    Distinct edges and each frontier are written to the shared folder: every level starts from
    stored tables, so a lost executor costs one level at most and plans do not grow.
    """
    spark = edges.sparkSession
    base = work_folder(spark, "levels")
    links = ["db", "table", "target_db", "target_table"]
    edges.select(*links).distinct().write.parquet(f"{base}/edges")
    stored = spark.read.parquet(f"{base}/edges")

    def frontier(level: int) -> DataFrame:
        return spark.read.parquet(f"{base}/frontier/level={level}")

    seeds.select(*PAIR).distinct().write.parquet(f"{base}/frontier/level=1")
    for level in range(2, max_levels + 1):
        previous = frontier(level - 1)
        if previous.isEmpty():
            break
        output = stored.join(previous, PAIR, "left_semi")
        if exclude_all:
            previous = spark.read.parquet(f"{base}/frontier")
        next_frontier(output, previous).write.parquet(f"{base}/frontier/level={level}")
    return spark.read.option("basePath", f"{base}/frontier").parquet(f"{base}/frontier").select(
        F.col("level").cast("int").alias("level"), *PAIR)
