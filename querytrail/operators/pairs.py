"""Filters by (database, table) pairs."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from querytrail.session import local_frame

NULL_TEXT = "nan"
#: Pairs that are broadcast whatever the planner makes of their size; some hundred bytes each.
BROADCAST_PAIRS = 1_000_000


def pair_frame(spark: SparkSession, pairs: list[tuple[str, str]]) -> DataFrame:
    unique = sorted(set(pairs))
    text = pa.string()
    return local_frame(spark, {
        "db": pa.array([d for d, _ in unique], text), "table": pa.array([t for _, t in unique], text)})


def _as_text(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(NULL_TEXT))


def _need(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} not found; available: {df.columns}")


def semi_join_pairs(
    df: DataFrame, pairs: DataFrame, db: str = "db", table: str = "table"
) -> DataFrame:
    """Rows whose (db, table) is in `pairs`; duplicates stay, a null counts as the text nan.

    The pair side is hinted in no way: Spark broadcasts it when its size allows that, and
    otherwise splits hot pairs of the big side at run time.
    """
    _need(df, db, table)
    wanted = pairs.select(
        F.col(pairs.columns[0]).cast("string").alias("_db"),
        F.col(pairs.columns[1]).cast("string").alias("_table"),
    )
    match = (_as_text(db) == F.col("_db")) & (_as_text(table) == F.col("_table"))
    return df.join(wanted, match, "left_semi")


def any_pair(pairs: list[tuple[str, str]], db: str, table: str) -> Column:
    terms = [(F.col(f"`{db}`") == d) & (F.col(f"`{table}`") == t) for d, t in pairs]
    return reduce(lambda a, b: a | b, terms, F.lit(False))


def filter_pairs(
    df: DataFrame, pairs: list[tuple[str, str]], db: str = "db", table: str = "table",
    max_literals: int = 100,
) -> DataFrame:
    """Pair filter; null never matches.

    Up to `max_literals` pairs are a predicate that reaches the scan; a longer list is joined, with
    the same rows.
    """
    _need(df, db, table)
    if len(pairs) <= max_literals:
        return df.filter(any_pair(pairs, db, table))
    wanted = pair_frame(df.sparkSession, pairs).toDF("_db", "_table")
    match = (F.col(f"`{db}`") == F.col("_db")) & (F.col(f"`{table}`") == F.col("_table"))
    return df.join(wanted, match, "left_semi")


def filter_pair(
    df: DataFrame, database: str, table_name: str, db: str = "db", table: str = "table"
) -> DataFrame:
    """Rows of one (database, table); a null counts as the text nan."""
    _need(df, db, table)
    if NULL_TEXT in (database, table_name):
        return df.filter((_as_text(db) == database) & (_as_text(table) == table_name))
    return filter_pairs(df, [(database, table_name)], db, table)


def unique_pairs(df: DataFrame, db: str = "db", table: str = "table") -> DataFrame:
    """Distinct pairs as text, sorted."""
    _need(df, db, table)
    return (
        df.select(_as_text(db).alias("db"), _as_text(table).alias("table")).distinct()
        .orderBy("db", "table")
    )


def write_matches(
    df: DataFrame, pairs: DataFrame, write: Callable[[DataFrame], None], db: str = "db", table: str = "table"
) -> DataFrame:
    """Hand the rows of the pairs to `write`, which writes them whole; the metrics of `match_metrics`.

    Rows are counted as they pass, before and behind the join, so the source is read once for both. That
    takes a plan without a shuffle, as a task repeated for a lost shuffle file would count twice: beyond
    BROADCAST_PAIRS pairs the source is read again to count. `pairs` is counted, so it should be a
    caller's list or a stored table.
    """
    if not 0 < pairs.count() <= BROADCAST_PAIRS:
        write(semi_join_pairs(df, pairs, db, table))
        return match_metrics(df, pairs, db, table)
    seen, matched, n = Observation(), Observation(), F.count(F.lit(1)).alias("n")
    write(semi_join_pairs(df.observe(seen, n), F.broadcast(pairs), db, table).observe(matched, n))
    return _with_rate(df.sparkSession.createDataFrame(
        [(seen.get["n"], matched.get["n"])], "rows_processed long, rows_matched long"))


def _with_rate(totals: DataFrame) -> DataFrame:
    rate = F.col("rows_matched") / F.nullif("rows_processed", F.lit(0)) * 100
    return totals.withColumn("match_rate", F.round(rate, 2))


def match_metrics(
    df: DataFrame, pairs: DataFrame, db: str = "db", table: str = "table"
) -> DataFrame:
    """Rows seen, rows matched and match rate in percent; one pass, null rate for no rows.

    Rows are counted per pair first, so the join sees one row per pair and no hot pair.
    """
    _need(df, db, table)
    per_pair = df.groupBy(_as_text(db).alias("_d"), _as_text(table).alias("_t")).agg(
        F.count("*").alias("n"))
    wanted = pairs.select(
        F.col(pairs.columns[0]).cast("string").alias("_d"),
        F.col(pairs.columns[1]).cast("string").alias("_t"),
    ).distinct().withColumn("hit", F.lit(True))
    totals = per_pair.join(wanted, ["_d", "_t"], "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_processed"),
        F.coalesce(F.sum(F.when(F.col("hit"), F.col("n"))), F.lit(0)).alias("rows_matched"),
    )
    return _with_rate(totals)
