"""Splitting, validating and summing up SQL scripts.

A script is one row (its file read whole). Whatever concerns one script only is computed inside
that row with array functions and needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from querytrail.functions.text import (
    clean_line_ends, failed_label, json_name, percentage, trim_control,
)
from querytrail.session import ship

# The placeholder validity test and its message.
KEYWORDS = ["INSERT", "UPDATE", "CREATE", "DELETE"]
MESSAGE = "Line 1:0 - Invalid SQL syntax"

Check = Callable[[Column], Column]
Validate = Callable[[str], Iterable[str]]


def is_valid(statement: Column, keywords: list[str] | None = None) -> Column:
    """(not blank AND has SELECT) OR has any other keyword; case-sensitive."""
    valid = (trim_control(statement) != "") & statement.contains("SELECT")
    for word in KEYWORDS if keywords is None else keywords:
        valid = valid | statement.contains(word)
    return valid


def split_statements(scripts: DataFrame, clean: bool = False) -> DataFrame:
    """(file, stmt_no, stmt): trimmed, non-blank; the number counts blank parts too."""
    text = clean_line_ends(F.col("script")) if clean else F.col("script")
    # the outer form spares a second split that Spark would add as a filter on empty arrays
    parts = scripts.select("file", F.posexplode_outer(F.split(text, ";")).alias("pos", "part"))
    return parts.select(
        "file", (F.col("pos") + 1).alias("stmt_no"), trim_control(F.col("part")).alias("stmt")
    ).filter("stmt <> ''")


def check_statements(statements: DataFrame, check: Check = is_valid) -> DataFrame:
    """Adds ok, message and error (message up to the first dash).

    `check` maps the statement column to a boolean column; a pandas UDF works as well. A null
    result marks a statement that could not be checked.
    """
    ok = check(F.col("stmt"))
    message = F.when(~F.col("ok"), F.lit(MESSAGE))
    return (
        statements.withColumn("ok", ok).withColumn("message", message)
        .withColumn("error", trim_control(F.split_part("message", F.lit("-"), F.lit(1))))
    )


def validate_statements(statements: DataFrame, validate: Validate) -> DataFrame:
    """Adds ok, messages, problem, message and error by a caller's validator.

    `validate` gives the messages about a statement, none for a good one, and is called once per
    statement, in batches. Where it raises, the statement counts as corrupted: ok is null, `problem` says what
    was raised, and the others go on. `message` is the first one, `error` that up to its first dash.
    """
    ship(statements.sparkSession)

    def outcome(statement: str) -> tuple[bool | None, list[str], str | None]:
        try:
            messages = [str(m) for m in validate(statement)]
        except Exception as problem:  # noqa: BLE001 - whatever a caller's function raises
            return None, [], f"{type(problem).__name__}: {problem}"
        return not messages, messages, None

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = pd.DataFrame([outcome(s) for s in part], columns=["ok", "messages", "problem"])
            yield found.astype({"ok": "boolean"})

    checked = F.pandas_udf(run, "ok boolean, messages array<string>, problem string")
    found = statements.withColumn("_found", checked("stmt"))
    message = F.get("_found.messages", F.lit(0))
    return found.select(
        *statements.columns, "_found.ok", "_found.messages", "_found.problem", message.alias("message"),
        trim_control(F.split_part(message, F.lit("-"), F.lit(1))).alias("error"))


def script_stats(
    scripts: DataFrame, check: Check = is_valid, time_taken: Column | None = None
) -> DataFrame:
    """Statement and error numbers per script, computed inside each row; with the time that checking
    the script took, where the scripts come with it."""
    parts = F.transform(F.split(clean_line_ends(F.col("script")), ";"), trim_control)
    counted = scripts.withColumn("_s", F.filter(parts, lambda s: s != "")).select(
        F.col("file").alias("file_name"),
        F.size("_s").alias("number_of_queries"),
        F.size(F.filter("_s", lambda s: ~check(s))).alias("queries_with_error"),
        F.size(F.filter("_s", lambda s: check(s).isNull())).alias("corrupted_queries"),
        *([] if time_taken is None else [time_taken.alias("time_taken")]),
    )
    return counted.withColumn(
        "percentage_of_errors",
        percentage(F.col("queries_with_error"), F.col("number_of_queries")))


def statement_stats(checked: DataFrame) -> DataFrame:
    """The same numbers from a table of checked statements (for checks that are UDFs)."""
    counted = checked.groupBy(F.col("file").alias("file_name")).agg(
        F.count("*").alias("number_of_queries"),
        F.count_if(~F.col("ok")).alias("queries_with_error"),
        F.count_if(F.col("ok").isNull()).alias("corrupted_queries"),
    )
    return counted.withColumn(
        "percentage_of_errors",
        percentage(F.col("queries_with_error"), F.col("number_of_queries")))


def message_counts(validated: DataFrame) -> DataFrame:
    """How often each short message was given per file, all messages of a statement counted."""
    each = validated.select("file", F.explode("messages").alias("message"))
    short = trim_control(F.split_part("message", F.lit("-"), F.lit(1)))
    return each.groupBy("file", short.alias("error")).agg(F.count("*").alias("failures"))


def stats_of_all(scripts: DataFrame, checked: DataFrame) -> DataFrame:
    """`statement_stats` with a row of zeros for scripts without a statement."""
    stats = statement_stats(checked)
    zero = {c: 0 for c in stats.columns if c != "file_name"}
    return scripts.select(F.col("file").alias("file_name")).join(stats, "file_name", "left").fillna(zero)


def error_counts(checked: DataFrame) -> DataFrame:
    """Failures per short message and file."""
    return checked.filter(~F.col("ok")).groupBy("file", "error").agg(
        F.count("*").alias("failures"))


def good_text(checked: DataFrame) -> DataFrame:
    """(file, script): the good statements of each script in order, joined by `; `.

    The result is one text per script, no longer than the script itself; null without any.
    """
    good = F.when(F.col("ok"), F.struct("stmt_no", "stmt"))
    ordered = F.sort_array(F.collect_list(good))
    return checked.groupBy("file").agg(ordered.alias("g")).select(
        "file",
        F.when(F.size("g") > 0, F.array_join(F.col("g.stmt"), "; ")).alias("script"))


def failed_statements(checked: DataFrame) -> DataFrame:
    return checked.filter(~F.col("ok")).select(
        "file", "stmt_no",
        failed_label(F.col("file"), F.col("stmt_no"), F.col("stmt")).alias("label"))


def script_status(files: DataFrame, checked: DataFrame, reparse: bool = True) -> DataFrame:
    """Run result per script: (FileName, DurationSeconds, JsonFile, Status).

    `files` holds (file, duration, file_ok, reparse_ok, error) as reported by the parser run;
    `checked` the statement outcomes. Without `reparse` the older naming is used: partial results
    have their own file name and everything else failed completely.
    """
    good = checked.groupBy("file").agg(F.count_if(F.col("ok")).alias("n_good"))
    n_good = F.coalesce(F.col("n_good"), F.lit(0))
    status = F.when(F.col("error").isNotNull(), "EXCEPTION").when(F.col("file_ok"), "SUCCESS")
    if reparse:
        status = status.when(n_good == 0, "NO_SUCCESSFUL_QUERIES").when(
            F.coalesce("reparse_ok", F.lit(False)), "PARTIAL").otherwise("REPARSE_FAILURE")
        partial_name = json_name(F.col("file"))
    else:
        status = F.when(F.col("file_ok"), "SUCCESS").when(n_good > 0, "PARTIAL").otherwise(
            "COMPLETE_FAILURE")
        partial_name = F.replace(F.col("file"), F.lit(".txt"), F.lit("_partial.json"))
    named = files.join(good, "file", "left").withColumn("Status", status)
    json_file = (
        F.when(F.col("Status") == "SUCCESS", json_name(F.col("file")))
        .when(F.col("Status") == "PARTIAL", partial_name).otherwise("FAILED")
    )
    return named.select(
        F.col("file").alias("FileName"), F.col("duration").cast("long").alias("DurationSeconds"),
        json_file.alias("JsonFile"), "Status")


def run_totals(files: DataFrame, failed: DataFrame) -> DataFrame:
    """Files, timed-out files, timed-out statements and total seconds of a run."""
    parts = files.agg(
        F.count("*").alias("files"), F.count_if(~F.col("file_ok")).alias("timeout_files"),
        F.lit(0).cast("long").alias("timeout_queries"),
        F.coalesce(F.sum("duration"), F.lit(0)).cast("long").alias("total_seconds"),
    ).unionByName(failed.agg(
        F.lit(0).cast("long").alias("files"), F.lit(0).cast("long").alias("timeout_files"),
        F.count("*").alias("timeout_queries"), F.lit(0).cast("long").alias("total_seconds")))
    return parts.agg(*[F.sum(c).alias(c) for c in parts.columns])
