"""The global map of (database, table) pairs: versions that concurrent runs can't overwrite or double."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from querytrail.operators.databases import new_pairs
from querytrail.session import claim_place, remove, subfolders

PAIRS = "db string, `table` string"


def _latest(spark: SparkSession, folder: str) -> tuple[int, list[str]]:
    """Number of the newest version and the parts it is made of; -1 before the first."""
    numbers = [int(name[1:]) for name in subfolders(spark, f"{folder}/versions") if name.startswith("v")]
    if not numbers:
        return -1, []
    newest = max(numbers)
    listed = spark.read.schema("part string").parquet(f"{folder}/versions/v{newest}")
    # One part for every run that added pairs.
    return newest, sorted(r.part for r in listed.collect())


def read_global_map(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct (db, table) pairs of the newest version; none before the first."""
    return _read(spark, folder, _latest(spark, folder)[1])


def _read(spark: SparkSession, folder: str, parts: list[str]) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], PAIRS)
    return spark.read.schema(PAIRS).parquet(*(f"{folder}/parts/{part}" for part in parts))


def map_exists(spark: SparkSession, folder: str) -> bool:
    return _latest(spark, folder)[0] >= 0


def add_pairs(spark: SparkSession, folder: str, pairs: DataFrame) -> int:
    """Append the pairs that the map does not hold; the number of the version that holds them all.

    The new pairs are a part of their own. A version lists its parts and is claimed by a rename that
    only one run can win; a run that loses looks at what the winner added and tries again with the rest, so
    no pair is added twice and none is lost. `pairs` should be stored, as it is read once per attempt.
    Needs a file system whose renames are atomic. Parts of runs that were lost half-way are in no version.
    """
    while True:
        version, parts = _latest(spark, folder)
        part = uuid.uuid4().hex
        new = new_pairs(pairs, _read(spark, folder, parts))
        new.write.parquet(f"{folder}/parts/{part}")
        if version >= 0 and _read(spark, folder, [part]).isEmpty():
            remove(spark, f"{folder}/parts/{part}")
            return version
        staged = f"{folder}/staged-{part}"
        spark.createDataFrame([(p,) for p in [*parts, part]], "part string").coalesce(1).write.parquet(staged)
        if claim_place(spark, staged, f"{folder}/versions/v{version + 1}"):
            return version + 1
        remove(spark, f"{folder}/parts/{part}")
