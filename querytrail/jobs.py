"""File-to-file jobs: read, apply the operators, write. Paths are folders or single files.

Nothing is collected; each job returns the DataFrame it wrote (read lazily) or a one-row summary.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from querytrail import batches, schemas
from querytrail.operators import (
    databases, extraction, levels, logmine, mapping, merge, pairs, scripts, tokens, trees, usage,
)
from querytrail.session import store
from querytrail.sources import global_map, log_store, sinks, tables, texts
from querytrail.streaming import landing

POSITION = "_position"


def _read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """A table that an earlier run may not have written yet."""
    try:
        return tables.read_table(spark, path, schema, position=POSITION)
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" not in str(problem):
            raise
        return spark.createDataFrame([], schema).withColumn(POSITION, F.lit(0).cast("long"))


def compare_files(spark: SparkSession, first: str, second: str, target: str) -> DataFrame:
    """Difference report of two mapping files, ordered; a header-only file when there is none."""
    one = tables.read_table(spark, first, position=POSITION)
    two = tables.read_table(spark, second, position=POSITION)
    report = mapping.compare_mappings(one, two, [POSITION])
    sinks.write_table(mapping.ordered_report(report), target)
    return tables.read_table(spark, target, schemas.DIFFERENCES)


def filter_file_by_pairs(
    spark: SparkSession, source: str, target: str, wanted: list[tuple[str, str]],
    db: str = "db", table: str = "table",
) -> DataFrame:
    """Rows of the wanted pairs; returns rows processed, rows matched and match rate, counted while
    writing."""
    return pairs.write_matches(
        tables.read_table(spark, source), pairs.pair_frame(spark, wanted),
        lambda rows: sinks.write_table(rows, target), db, table)


def merge_files(spark: SparkSession, first: str, second: str, target: str, check: bool = True) -> None:
    """Both files under one header; refused when the headers differ, unless `check` is off."""
    one, two = tables.read_table(spark, first), tables.read_table(spark, second)
    both = merge.concat_checked if check else merge.concat_positional
    sinks.write_table(both(one, two), target)


def map_tables(
    spark: SparkSession, lineage: str, target: str, table_map: str, catalog: DataFrame
) -> DataFrame:
    """Fill the databases of a lineage file and append newly found tables to the saved map."""
    rows = tables.read_table(spark, lineage, position=POSITION)
    saved = _read_or_empty(spark, table_map, schemas.TABLE_MAP)
    name = table_map.rstrip("/").rpartition("/")[2]
    if any(file.rstrip("/").rpartition("/")[2] == name for file in saved.inputFiles()):
        raise ValueError(f"{table_map} is a file; the saved map grows, so it has to be a folder")
    # The map is appended to below, so its rows of now are stored first.
    saved = store(saved, "saved-map")
    filled, found = databases.resolve_databases(rows, saved, catalog, POSITION, POSITION)
    sinks.write_table(filled.drop(POSITION), target)
    found.select(*schemas.TABLE_MAP.names).write.mode("append").options(
        **sinks.DELIMITED).csv(table_map)
    return tables.read_table(spark, target)


def map_level(
    spark: SparkSession, lineage: str, target: str, global_map_folder: str, table_map: str, catalog: DataFrame
) -> DataFrame:
    """The mapping step of a level: fill the databases of its merged rows and extend the global map.

    Where the global map exists and knows every database on either side, the merged rows are kept
    as they are and nothing is looked up or appended. Otherwise `map_tables` fills them, and the (database,
    table) pairs of both sides that the map lacks are appended as a new version of it.
    """
    rows = tables.read_table(spark, lineage)
    if global_map.map_exists(spark, global_map_folder) and databases.unmapped_databases(
            rows, global_map.read_global_map(spark, global_map_folder)).isEmpty():
        sinks.write_table(rows, target)
        return tables.read_table(spark, target)
    filled = map_tables(spark, lineage, target, table_map, catalog)
    sides = [
        filled.select(F.col(f"{side}_db").alias("db"), F.col(f"{side}_table").alias("table"))
        for side in ("source", "target")]
    found = sides[0].union(sides[1]).filter("db is not null and `table` is not null").distinct()
    global_map.add_pairs(spark, global_map_folder, store(found, "level-pairs"))
    return filled


def extract_statements(
    spark: SparkSession, work: DataFrame, logs: tuple[DataFrame, DataFrame, DataFrame],
    statements: list[str], start: Column, end: Column, target: str, ledger: str, day: Column,
    check: batches.Check | None = None, failed: str | None = None, max_failures: int = 20,
) -> DataFrame:
    """One run over the open part of the work list: extract, check, keep, record in the ledger.

    `work` holds (db, table, position). `check` may convert the rows and may raise. All batches run as
    one job; its rows are moved to a part of `target` of their own when they are whole, its ledger
    entries last. Without `failed`, an error ends the run and nothing of it is kept. With it, the batches
    that fail are found by halving, listed there (`batches.read_failed`) with their tables, statement
    type and error, and left out of the ledger; the others are kept, so the next run repeats the
    failed ones only. More than `max_failures` of them raise `batches.TooManyFailures`. Returns row
    totals per database, batch and window; `batches.read_extract` reads what has been kept.
    """
    done = batches.read_ledger(spark, ledger)
    todo = store(extraction.remaining(work.withColumnRenamed(work.columns[2], POSITION), done), "work")
    numbered = store(extraction.number_batches(todo, POSITION), "batches")
    packed = store(extraction.pack_batches(todo, POSITION), "packed")

    def extract(some: DataFrame, kinds: list[str]) -> DataFrame:
        return extraction.extract_work_list(some, *logs, kinds, start, end, prefilter=True)

    run = batches.BatchRun(
        spark, numbered, packed, extract, statements, check or (lambda rows: rows), target, ledger, day)
    return extraction.row_totals(run.whole() if failed is None else run.one_by_one(failed, max_failures))


def store_logs(
    spark: SparkSession, objects: str, users: str, texts_: str, target: str, buckets: int = 200,
    hot_rows: int = 1_000_000,
) -> log_store.LogStore:
    """Copies of the three query logs by query key, for `extraction.join_stored_logs`."""
    return log_store.write_log_store(
        tables.read_query_log(spark, objects, users, texts_), target, buckets, hot_rows)


def mine_log(spark: SparkSession, log: str, target: str) -> DataFrame:
    """Skipped tables and dates of an extraction log; returns the summary per file."""
    lines = texts.read_log_lines(spark, log)
    found = store(logmine.classify_pairs(lines), "log-pairs")
    sinks.write_table(logmine.entries(found), target)
    return logmine.summary(found, lines)


def validate_scripts(
    spark: SparkSession, folder: str, target: str, check: scripts.Check = scripts.is_valid,
    validate: scripts.Validate | None = None,
) -> DataFrame:
    """Statistics, error list and dump of invalid statements for every script of a folder.

    With `validate` (statement -> messages) instead of `check` the messages are the caller's: all
    of them are written to `messages` with their statement, and what it raised for corrupted ones.
    """
    source = texts.read_scripts(spark, folder)
    statements = scripts.split_statements(source, clean=True)
    if validate is None:
        checked, stats = scripts.check_statements(statements, check), scripts.script_stats(source, check)
    else:
        # Stored, so a statement is validated once.
        checked = store(scripts.validate_statements(statements, validate), "validated")
        stats = scripts.stats_of_all(source, checked)
        checked.filter("ok is null or not ok").select("file", "stmt_no", "messages", "problem").write.mode(
            "overwrite").parquet(f"{target}/messages")
    sinks.write_table(stats, f"{target}/stats")
    sinks.append_error_list(checked, f"{target}/errors")
    sinks.write_invalid_statements(checked, f"{target}/invalid")
    return stats


def load_trees(spark: SparkSession, folder: str, target: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Node, token and rejected-document tables of a folder of JSON documents, as parquet."""
    documents = texts.read_documents(spark, folder)
    read = store(trees.read_nodes(documents), "nodes")
    parts = {
        "nodes": trees.nodes_of(read), "tokens": tokens.read_tokens(documents),
        "rejected": trees.rejected_documents(read),
    }
    for name, df in parts.items():
        df.write.mode("overwrite").parquet(f"{target}/{name}")
    return tuple(spark.read.parquet(f"{target}/{name}") for name in parts)


def classify_file(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Usage rows with the class of their table."""
    rows = tables.read_table(spark, source)
    numbers = {c: F.col(c).cast("long") for c in ("ProcID", "QueryID", "SessionID")}
    sinks.write_table(usage.classify_tables(rows.withColumns(numbers)), target)
    return tables.read_table(spark, target)


def ingest_folder(
    spark: SparkSession, folder: str, target: str, checkpoint: str,
    max_wait_seconds: int | None = None, once_within: str | None = None,
) -> DataFrame:
    """Take in what has landed in a folder since the last call; statistics over all of it.

    Waits until all of it is done; with a limit, a TimeoutError is raised when it is reached. With
    `once_within`, such as "30 days", a content counts once in that time, whatever its files are called.
    """
    landing.drain(
        landing.start_ingest(
            landing.landing_stream(spark, folder), target, checkpoint, once_within=once_within),
        max_wait_seconds)
    return landing.processing_stats(landing.good_records(spark.read.parquet(target)))


def run_levels(
    work: DataFrame, lineage_of: Callable[[DataFrame], DataFrame], max_levels: int
) -> DataFrame:
    """Levels whose lineage is not known beforehand: (level, db, table).

    `lineage_of` turns the work list of a level into lineage rows with target_db, target_table,
    for instance by extraction and parsing. Each level's input and output are stored.
    """
    current = store(work.select("db", "table").distinct(), "level")
    every = current.withColumn("level", F.lit(1))
    for level in range(2, max_levels + 1):
        output = store(lineage_of(current), "level-output")
        current = store(levels.next_frontier(output, current), "level")
        if current.isEmpty():
            break
        every = every.unionByName(current.withColumn("level", F.lit(level)))
    return every.select("level", "db", "table")
