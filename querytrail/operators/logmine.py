"""Skipped tables and dates from extraction logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from querytrail.functions.ordered import BITS, odd_of_runs
from querytrail.functions.text import quoted_list, trim_blank
from querytrail.session import store

# The two log messages. Both arrows occur: the message itself prints the second.
# Flags: Unicode classes, and \n as the only line end.
SPOOL = r"(?Ud)^.*WARNING.*Spool\s+error\s+for\s+(\w+)\s+tables\s+(\[.*?\]).*$"
SKIP = (
    r"(?Ud)^.*WARNING.*Skipping\s+date\s+range\s+(\d{4}-\d{2}-\d{2})\s*(?:->|→)\s*"
    r"(\d{4}-\d{2}-\d{2})\s+for\s+(\w+)\s+[Bb]atch\s+(\d+)\s+due\s+to\s+error.*$"
)
SPOOL_NAMES = ["Database", "table_list"]
SKIP_NAMES = ["Start_Date", "End_Date", "skip_db", "Batch"]
MARK = "\x01"


def capture(line: Column, word: str, pattern: str, names: list[str]) -> Column:
    """All groups of a message in one text, each ended by a mark; null when it does not match.

    One regular expression per line, and only on lines that hold the plain words.
    """
    candidate = line.contains("WARNING") & line.contains(word)
    groups = "".join(f"${i + 1}{MARK}" for i in range(len(names)))
    # The pattern takes the whole line, so the mark in front is there exactly if it matched.
    replaced = F.regexp_replace(line, pattern, MARK + groups)
    matched = replaced.startswith(MARK) & ~line.startswith(MARK)
    return F.when(candidate & matched, F.substring(replaced, 2, 1 << 30))


def spool_capture(line: Column) -> Column:
    return capture(line, "Spool", SPOOL, SPOOL_NAMES)


def skip_capture(line: Column) -> Column:
    return capture(line, "Skipping", SKIP, SKIP_NAMES)


def fields(captured: Column, names: list[str]) -> list[Column]:
    return [F.split_part(captured, F.lit(MARK), F.lit(i + 1)).alias(n) for i, n in enumerate(names)]


def adjacent_messages(lines: DataFrame) -> DataFrame:
    """A spool message directly followed by a skip message: (file, line_no, fields, tables).

    Only the captured parts of matching lines are shuffled, keyed by (file, line of the pair), so
    neither the file nor the order of its lines ever gathers in one task.
    """
    text = trim_blank(F.col("line"))
    found = lines.filter(
        F.col("line").contains("WARNING")
        & (F.col("line").contains("Spool") | F.col("line").contains("Skipping"))
    ).select("file", "line_no", spool_capture(text).alias("a"), skip_capture(text).alias("b"))
    none = F.lit(None).cast("string")
    first = F.struct(F.col("line_no").alias("at"), F.col("a").alias("a"), none.alias("b"))
    second = F.struct((F.col("line_no") - 1).alias("at"), none.alias("a"), F.col("b").alias("b"))
    has_a, has_b = F.col("a").isNotNull(), F.col("b").isNotNull()
    roles = (
        F.when(has_a & has_b, F.array(first, second)).when(has_a, F.array(first))
        .when(has_b, F.array(second))
    )
    pairs = (
        found.select("file", F.explode_outer(roles).alias("r"))
        .groupBy("file", F.col("r.at").alias("line_no"))
        .agg(F.max("r.a").alias("a"), F.max("r.b").alias("b"))
        .filter("a is not null and b is not null")
    )
    named = pairs.select(
        "file", "line_no", *fields(F.col("a"), SPOOL_NAMES), *fields(F.col("b"), SKIP_NAMES))
    return named.withColumn("tables", quoted_list(F.col("table_list")))


def classify_pairs(lines: DataFrame, bits: int = BITS) -> DataFrame:
    """Message pairs with their outcome: `processed`, or `problem` (other database, no list).

    A processed pair uses up its second line, so a pair starting there is not looked at. The pairs
    are few but used several times, so they are stored: the log itself is read once.
    """
    pairs = store(adjacent_messages(lines), "message-pairs")
    usable = (F.col("Database") == F.col("skip_db")) & F.col("tables").isNotNull()
    processed = odd_of_runs(pairs.filter(usable), ["file"], "line_no", bits)
    used = processed.select("file", (F.col("line_no") + 1).alias("line_no"))
    problems = pairs.filter(~usable).join(used, ["file", "line_no"], "left_anti")
    return processed.withColumn("outcome", F.lit("processed")).unionByName(
        problems.withColumn("outcome", F.lit("problem")))


def entries(classified: DataFrame) -> DataFrame:
    """(Database, Table, Start_Date, End_Date, Batch), one row per listed table."""
    return classified.filter("outcome = 'processed'").select(
        "Database", F.explode("tables").alias("Table"), "Start_Date", "End_Date", "Batch")


def summary(classified: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Per file: processed pairs, table entries, problem lines; zeros for `files` without a pair."""
    done = F.col("outcome") == "processed"
    counts = classified.groupBy("file").agg(
        F.count_if(done).alias("processed_pairs"),
        F.coalesce(F.sum(F.when(done, F.size("tables"))), F.lit(0)).alias("table_entries"),
        F.count_if(~done).alias("skipped_lines"),
    )
    if files is None:
        return counts
    return files.select("file").distinct().join(counts, "file", "left").fillna(
        0, ["processed_pairs", "table_entries", "skipped_lines"])


def skipped_tables(lines: DataFrame, bits: int = BITS) -> DataFrame:
    return entries(classify_pairs(lines, bits))


def mining_summary(lines: DataFrame, bits: int = BITS) -> DataFrame:
    return summary(classify_pairs(lines, bits), lines)


def windows_to_repeat(skipped: DataFrame, batches: DataFrame) -> DataFrame:
    """All tables of a skipped batch with their window.

    The log names the first tables of a batch only; the packed batch list has them all. A skipped
    row counts only when its table belongs to the batch.
    """
    listed = skipped.select(
        F.col("Database").alias("db"), F.col("Batch").cast("int").alias("batch_number"),
        F.col("Table").alias("named"), "Start_Date", "End_Date",
    ).distinct()
    hit = listed.join(batches, ["db", "batch_number"]).filter(
        F.array_contains("tables", F.col("named")))
    windows = hit.select("db", "batch_number", "tables", "Start_Date", "End_Date").distinct()
    return windows.select(
        "db", F.explode("tables").alias("table"), "batch_number", "Start_Date", "End_Date")
