"""Writers. Each takes a DataFrame and a target folder; nothing passes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querytrail.functions.text import json_name, without_extension
from querytrail.schemas import RUN_METRICS

# Frame of one entry in a dump of invalid statements.
INVALID_HEAD = "--- INVALID QUERY ---"
INVALID_RULE = "+ - " * 50


# Cells are written as they are: Spark would strip blanks at their ends.
DELIMITED = {
    "header": True, "escape": '"', "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


# For many small files: the local file system without checksum files.
PLAIN_FILES = {
    "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true",
}


def append_extracts(
    extract: DataFrame, folder: str, file_format: str = "parquet", mode: str = "append"
) -> None:
    """One sub-folder per statement type, appended."""
    writer = (
        extract.withColumn("statement_type", F.trim("StatementType"))
        .write.mode(mode).partitionBy("statement_type")
    )
    if file_format == "csv":
        writer = writer.options(**DELIMITED)
    writer.format(file_format).save(folder)


def replace_extracts(extract: DataFrame, folder: str) -> None:
    """The same as the whole content of the folder, which a repeated run replaces."""
    append_extracts(extract, folder, mode="overwrite")


def write_files(df: DataFrame, folder: str, file_format: str) -> None:
    """One file per row, in a sub-folder per task.

    A folder for each file would cost the driver a rename and every reader a listing. The files of a
    task are moved together and listed together, so folders grow with the tasks only. In a folder of a
    local file system no checksum files are written: three of the four processes that Hadoop starts to set
    the rights of a file are for its checksum. Other file systems don't read these options.
    """
    df.withColumn("files_of", F.spark_partition_id()).write.options(**PLAIN_FILES).option(
        "maxRecordsPerFile", 1).partitionBy("files_of").format(file_format).save(folder)


def shuffle_parts(df: DataFrame) -> int:
    """Number of partitions of a shuffle, to be named where small rows make much work: files to write."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def write_table(df: DataFrame, folder: str) -> None:
    """Delimited text with header; an empty result still leaves a file with the header."""
    df.write.mode("overwrite").options(**DELIMITED).csv(folder)


def invalid_statements(checked: DataFrame) -> DataFrame:
    """Dump text of each invalid statement: (file_name, stmt_no, entry).

    An entry is a row of its own, so a script with many invalid statements is never one value.
    """
    entry = F.concat_ws(
        "\n", F.lit(INVALID_HEAD), F.concat("stmt", F.lit("\n")), F.lit(""), F.lit(INVALID_RULE),
        F.lit(""),
    )
    return checked.filter(~F.col("ok")).select(
        F.concat(without_extension(F.col("file")), F.lit("_errors")).alias("file_name"),
        "stmt_no", entry.alias("entry"),
    )


def write_invalid_statements(checked: DataFrame, folder: str, per_file: bool = False) -> None:
    """The dump as one table, sorted by file and number; with `per_file` a text folder per script,
    which suits few scripts only."""
    dump = invalid_statements(checked)
    # Range partitioning by (file, number) keeps a script in order and splits a huge one.
    placed = dump.repartitionByRange("file_name", "stmt_no").sortWithinPartitions("file_name", "stmt_no")
    if not per_file:
        placed.write.mode("overwrite").parquet(folder)
        return
    placed.select("file_name", F.col("entry").alias("value")).write.mode("overwrite").partitionBy(
        "file_name").text(folder)


def error_list(checked: DataFrame) -> DataFrame:
    """(error, code): short message and file name without extension, one row per failure."""
    return checked.filter(~F.col("ok")).select(
        "error", without_extension(F.col("file")).alias("code")
    )


def append_error_list(checked: DataFrame, folder: str) -> None:
    error_list(checked).write.mode("append").options(**DELIMITED).csv(folder)


def run_metrics(results: DataFrame) -> DataFrame:
    return results.select(*RUN_METRICS.names).orderBy("FileName")


def write_run_metrics(results: DataFrame, folder: str) -> None:
    run_metrics(results).write.mode("overwrite").options(**DELIMITED).csv(folder)


def failure_report(files: DataFrame, statements: DataFrame) -> DataFrame:
    """Two counted sections of `- item` lines: (section, line_no, line).

    Line 0 of a section is its heading with the count; the items follow one row each (line 1), to
    be sorted by text. No list of failures is ever built in memory.
    """
    def section(df: DataFrame, number: int, heading: str) -> DataFrame:
        items = df.select(F.col(df.columns[0]).alias("item"))
        head = items.agg(F.count("*").alias("n")).select(
            F.lit(number).alias("section"), F.lit(0).alias("line_no"),
            F.concat(F.lit(f"{heading} ("), F.col("n").cast("string"), F.lit("):")).alias("line"),
        )
        body = items.select(
            F.lit(number).alias("section"), F.lit(1).alias("line_no"),
            F.concat(F.lit("- "), "item").alias("line"),
        )
        return head.unionByName(body)

    return section(files, 1, "FILES THAT TIMED OUT").unionByName(
        section(statements, 2, "QUERIES THAT TIMED OUT")
    )


def write_failure_report(files: DataFrame, statements: DataFrame, folder: str) -> None:
    report = failure_report(files, statements).orderBy("section", "line_no", "line")
    report.select(F.col("line").alias("value")).write.mode("overwrite").text(folder)


def tree_documents(documents: DataFrame) -> DataFrame:
    """(file_name, value): the document of each script under its .json name."""
    return documents.select(
        json_name(F.col("file")).alias("file_name"), F.col("payload").alias("value")
    )


def write_trees(documents: DataFrame, folder: str, per_file: bool = False) -> None:
    """The documents as one table, sorted by file name; with `per_file` a folder per script, which
    suits few scripts only."""
    named = tree_documents(documents)
    if per_file:
        named.write.mode("overwrite").partitionBy("file_name").text(folder)
    else:
        named.repartitionByRange("file_name").sortWithinPartitions("file_name").write.mode(
            "overwrite").parquet(folder)
