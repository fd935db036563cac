"""Scripts, parser runs and table classification."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from querytrail.functions import text as tx
from querytrail.operators import scripts as sc
from querytrail.operators import usage
from querytrail.plans.registry import query
from querytrail.plans.standins import Tables
from querytrail.schemas import RUN_METRICS
from querytrail.session import work_folder
from querytrail.sources import sinks, texts

_TRIM = "trim({}, concat(' ', chr(9), chr(10), chr(13)))"


def checked(t: Tables):
    return sc.check_statements(sc.split_statements(t.scripts()))


def _stats(name: str) -> str:
    return f"""
SELECT p.file AS file_name, CAST(count(s.stmt) AS {name}) AS number_of_queries,
  CAST(count(*) FILTER (NOT s.ok) AS {name}) AS queries_with_error, CAST(0 AS {name}) AS corrupted_queries,
  CASE WHEN count(s.stmt) = 0 THEN 0.0::DOUBLE ELSE floor(CAST(count(*) FILTER (NOT s.ok) AS DOUBLE)
    / CAST(count(s.stmt) AS DOUBLE) * 100.0::DOUBLE * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE END AS percentage_of_errors
FROM {{v_parts}} p LEFT JOIN {{c_stmts}} s ON s.file = p.file AND s.stmt_no = p.stmt_no GROUP BY 1"""


@query("fn1_split_statements", "SELECT file, stmt_no, stmt FROM {c_stmts}")
def split_statements(t):
    return sc.split_statements(t.scripts())


@query("fn2_line_end_cleaning", f"""
SELECT file, {_TRIM.format("replace(replace(string_agg(part, ';' ORDER BY stmt_no), chr(13) || chr(10), chr(10)), chr(13), chr(10))")} AS script
FROM {{v_parts}} GROUP BY 1""")
def line_end_cleaning(t):
    return t.scripts().select("file", tx.clean_line_ends(F.col("script")).alias("script"))


@query("fn3_control_trim", f"""
SELECT file, stmt_no, {_TRIM.format('part')} AS trimmed, CAST(length({_TRIM.format('part')}) AS INT) AS n FROM {{v_parts}}""")
def control_trim(t):
    trimmed = tx.trim_control(F.col("part"))
    return t["v_parts"].select("file", "stmt_no", trimmed.alias("trimmed"), F.length(trimmed).alias("n"))


@query("fn4_failed_statement_labels", """
SELECT file, stmt_no, file || '_query_' || stmt_no || ': ' || substr(stmt, 1, 100) || '...' AS label
FROM {c_stmts} WHERE NOT ok""")
def failed_statement_labels(t):
    return sc.failed_statements(checked(t))


@query("fn5_file_name_parts", """
SELECT DISTINCT file, regexp_replace(file, '\\.[^.]*$', '') AS base, replace(file, '.txt', '.json') AS json_file
FROM {v_runs}""")
def file_name_parts(t):
    file = F.col("file")
    return t["v_runs"].select(
        "file", tx.without_extension(file).alias("base"), tx.json_name(file).alias("json_file"))


@query("fn9_half_up_percentage", """
SELECT l_orderkey, floor(l_extendedprice * l_discount * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE AS rounded
FROM {lineitem}""")
def half_up_percentage(t):
    return t["lineitem"].select(
        "l_orderkey", tx.half_up_2(F.col("l_extendedprice") * F.col("l_discount")).alias("rounded"))


@query("pf7_statement_validity", """
SELECT file, stmt_no, ok, CASE WHEN NOT ok THEN 'Line 1:0 - Invalid SQL syntax' END AS message FROM {c_stmts}""")
def statement_validity(t):
    return checked(t).select("file", "stmt_no", "ok", "message")


@query("pf10_blank_parts_dropped", """
SELECT file, count(*) AS kept, CAST(max(stmt_no) AS INT) AS last_no FROM {c_stmts} GROUP BY 1""")
def blank_parts_dropped(t):
    return sc.split_statements(t.scripts(), clean=True).groupBy("file").agg(
        F.count("*").alias("kept"), F.max("stmt_no").alias("last_no"))


@query("ag6_script_statistics", _stats("INT"))
def script_statistics(t):
    return sc.script_stats(t.scripts())


@query("ag7_error_message_counts", """
SELECT file, 'Line 1:0' AS error, count(*) AS failures FROM {c_stmts} WHERE NOT ok GROUP BY 1""")
def error_message_counts(t):
    return sc.error_counts(checked(t))


@query("ag17_good_statements_concatenated", """
SELECT file, string_agg(stmt, '; ' ORDER BY stmt_no) FILTER (ok) AS script FROM {c_stmts} GROUP BY 1""")
def good_statements_concatenated(t):
    return sc.good_text(checked(t))


_STATUS = """
SELECT r.file AS FileName, r.duration AS DurationSeconds,
  CASE WHEN s IN ('SUCCESS', 'PARTIAL') THEN replace(r.file, '.txt', '.json') ELSE 'FAILED' END AS JsonFile, s AS Status
FROM (SELECT r.*, CASE WHEN error IS NOT NULL THEN 'EXCEPTION' WHEN file_ok THEN 'SUCCESS'
    WHEN coalesce(n_good, 0) = 0 THEN 'NO_SUCCESSFUL_QUERIES' WHEN reparse_ok THEN 'PARTIAL' ELSE 'REPARSE_FAILURE' END AS s
  FROM {v_runs} r LEFT JOIN (SELECT file, count(*) FILTER (ok) AS n_good FROM {c_stmts} GROUP BY 1) g ON g.file = r.file) r"""


def statuses(t: Tables):
    return sc.script_status(t["v_runs"], checked(t))


@query("ag16_script_status", _STATUS)
def script_status(t):
    return statuses(t)


@query("ag16_script_status_without_reparse", """
SELECT r.file AS FileName, r.duration AS DurationSeconds,
  CASE s WHEN 'SUCCESS' THEN replace(r.file, '.txt', '.json') WHEN 'PARTIAL' THEN replace(r.file, '.txt', '_partial.json')
    ELSE 'FAILED' END AS JsonFile, s AS Status
FROM (SELECT r.*, CASE WHEN file_ok THEN 'SUCCESS' WHEN coalesce(n_good, 0) > 0 THEN 'PARTIAL' ELSE 'COMPLETE_FAILURE' END AS s
  FROM {v_runs} r LEFT JOIN (SELECT file, count(*) FILTER (ok) AS n_good FROM {c_stmts} GROUP BY 1) g ON g.file = r.file) r""")
def script_status_without_reparse(t):
    return sc.script_status(t["v_runs"], checked(t), reparse=False)


@query("ag15_run_totals", """
SELECT (SELECT count(*) FROM {v_runs}) AS files, (SELECT count(*) FROM {v_runs} WHERE NOT file_ok) AS timeout_files,
  (SELECT count(*) FROM {c_stmts} WHERE NOT ok) AS timeout_queries,
  (SELECT CAST(sum(duration) AS BIGINT) FROM {v_runs}) AS total_seconds""")
def run_totals(t):
    return sc.run_totals(t["v_runs"], sc.failed_statements(checked(t)))


@query("sk3_invalid_statement_dump", """
SELECT regexp_replace(file, '\\.[^.]*$', '') || '_errors' AS file_name, stmt_no,
  '--- INVALID QUERY ---' || chr(10) || stmt || chr(10) || chr(10) || chr(10) || repeat('+ - ', 50) || chr(10) AS entry
FROM {c_stmts} WHERE NOT ok""")
def invalid_statement_dump(t):
    folder = work_folder(t.spark, "invalid")
    sinks.write_invalid_statements(checked(t), folder)
    return t.spark.read.parquet(folder)


@query("sk4_error_list", """
SELECT 'Line 1:0' AS error, regexp_replace(file, '\\.[^.]*$', '') AS code FROM {c_stmts} WHERE NOT ok""")
def error_list(t):
    folder = work_folder(t.spark, "errors")
    sinks.append_error_list(checked(t), folder)
    return t.spark.read.schema("error string, code string").option("header", True).csv(folder)


@query("sk5_run_metrics_table", _STATUS + " ORDER BY FileName")
def run_metrics_table(t):
    folder = work_folder(t.spark, "metrics")
    sinks.write_run_metrics(statuses(t), folder)
    return t.spark.read.options(**sinks.DELIMITED).schema(RUN_METRICS).csv(folder)


@query("sk6_failure_report", """
SELECT 1 AS section, 0 AS line_no, 'FILES THAT TIMED OUT (' || count(*) || '):' AS line FROM {v_runs} WHERE NOT file_ok
UNION ALL SELECT 1, 1, '- ' || file FROM {v_runs} WHERE NOT file_ok
UNION ALL SELECT 2, 0, 'QUERIES THAT TIMED OUT (' || count(*) || '):' FROM {c_stmts} WHERE NOT ok
UNION ALL SELECT 2, 1, '- ' || file || '_query_' || stmt_no || ': ' || substr(stmt, 1, 100) || '...' FROM {c_stmts} WHERE NOT ok""")
def failure_report(t):
    files = t["v_runs"].filter("not file_ok").select("file")
    # Statements may hold line ends, so the written report can't be told apart line by line again.
    return sinks.failure_report(files, sc.failed_statements(checked(t)).select("label"))


@query("sc2_script_scan", """
SELECT true AS is_txt, CAST(length(string_agg(part, ';' ORDER BY seq)) + 1 AS INT) AS n, count(*) AS parts
FROM (SELECT l_orderkey // 100 AS hundred, part, l_orderkey * 1000 + stmt_no AS seq FROM {v_parts}) p GROUP BY hundred""")
def script_scan(t):
    # Script files from the scripts of 100 orders each: files grow in number, not in size. Parts are put
    # together by order, where they were ranked; only those texts go on to their file. Missing parts are left out.
    parts = F.sort_array(F.collect_list(F.struct("stmt_no", "part")))["part"]
    some = F.exists("parts", lambda part: part.isNotNull())
    orders = t["v_parts"].groupBy("l_orderkey").agg(parts.alias("parts")).select(
        F.floor(F.col("l_orderkey") / 100).alias("hundred"), "l_orderkey",
        F.when(some, F.array_join("parts", ";")).alias("text"))
    ordered = F.sort_array(F.collect_list(F.struct("l_orderkey", "text")))["text"]
    files = orders.repartition(sinks.shuffle_parts(orders), "hundred").groupBy("hundred").agg(
        F.array_join(ordered, ";").alias("value"))
    folder = work_folder(t.spark, "scripts")
    sinks.write_files(files.select("value"), folder, "text")
    return texts.read_scripts(t.spark, f"{folder}/*").select(
        F.col("file").endswith(".txt").alias("is_txt"), F.length("script").alias("n"),
        F.size(F.split("script", ";")).cast("long").alias("parts"))


def _keyword_check(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for part in parts:
        yield part.str.contains("SELECT", regex=False) | part.str.contains("INSERT", regex=False)


@query("ud3_caller_statement_validator", """
SELECT file AS file_name, count(*) AS number_of_queries, count(*) FILTER (NOT ok) AS queries_with_error,
  CAST(0 AS BIGINT) AS corrupted_queries,
  floor(CAST(count(*) FILTER (NOT ok) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100.0::DOUBLE * 100.0::DOUBLE + 0.5::DOUBLE)
    / 100.0::DOUBLE AS percentage_of_errors
FROM {c_stmts} GROUP BY 1""")
def caller_statement_validator(t):
    check = F.pandas_udf(_keyword_check, "boolean")
    return sc.statement_stats(sc.check_statements(sc.split_statements(t.scripts()), check))


def _messages(statement: str) -> list[str]:
    """Two messages about each merge, one about some selects; some inserts can't be read."""
    if statement.endswith("0)"):
        raise ValueError("unreadable value")
    if statement.startswith("merge"):
        return ["Line 1:0 - unknown statement", "Line 1:100 - long line"]
    return ["Line 1:7 - odd table"] if statement.startswith("SELECT") and statement.endswith("5") else []


@query("ag7_caller_messages", """
SELECT file, error, count(*) AS failures FROM (
  SELECT file, unnest(['Line 1:0', 'Line 1:100']) AS error FROM {c_stmts} WHERE stmt LIKE 'merge%'
  UNION ALL SELECT file, 'Line 1:7' FROM {c_stmts} WHERE stmt LIKE 'SELECT%5') m GROUP BY 1, 2""")
def caller_messages(t):
    return sc.message_counts(sc.validate_statements(sc.split_statements(t.scripts(), clean=True), _messages))


@query("ud3_validator_that_raises", """
SELECT file AS file_name, n AS number_of_queries, bad AS queries_with_error, odd AS corrupted_queries,
  floor(CAST(bad AS DOUBLE) / CAST(n AS DOUBLE) * 100.0::DOUBLE * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE AS percentage_of_errors
FROM (SELECT file, count(*) AS n, count(*) FILTER (stmt LIKE 'merge%' OR stmt LIKE 'SELECT%5') AS bad,
    count(*) FILTER (stmt LIKE '%0)') AS odd FROM {c_stmts} GROUP BY 1) s""")
def validator_that_raises(t):
    return sc.statement_stats(sc.validate_statements(sc.split_statements(t.scripts(), clean=True), _messages))


# --- usage classification ------------------------------------------------------------------

_FLAGS = """
SELECT *, SQLTEXTINFO IS NOT NULL AND regexp_matches(SQLTEXTINFO, '(?i)Create ') AS c,
  SQLTEXTINFO IS NOT NULL AND regexp_matches(SQLTEXTINFO, '(?i)Drop|Rename') AS d,
  trim(coalesce(SQLTEXTINFO, ''), concat(' ', chr(9))) = '' AS blank FROM {v_usage}"""
_LATEST = f"""
SELECT * FROM ({_FLAGS}) f WHERE logdate = (SELECT max(logdate) FROM {{v_usage}} m WHERE m.ObjectTableName = f.ObjectTableName)"""
_TEMP = f"""
SELECT DISTINCT a.ObjectTableName FROM ({_LATEST}) a JOIN ({_LATEST}) b ON a.ObjectTableName = b.ObjectTableName
WHERE a.c AND b.d AND ((a.ProcID = b.ProcID AND b.QueryID > a.QueryID) OR b.SessionID > a.SessionID)"""
_CLASS = f"""
SELECT f.ObjectTableName, CASE WHEN all_blank THEN 'Active Table' WHEN NOT c AND d THEN 'Isolated Drop/Rename'
  WHEN c AND d AND f.ObjectTableName IN ({_TEMP}) THEN 'Temporary' ELSE 'Active Table' END AS Table_Classification
FROM (SELECT ObjectTableName, bool_and(blank) AS all_blank FROM ({_FLAGS}) x WHERE ObjectTableName IS NOT NULL GROUP BY 1) f
JOIN (SELECT ObjectTableName, bool_or(c) AS c, bool_or(d) AS d FROM ({_LATEST}) y GROUP BY 1) l
  ON f.ObjectTableName = l.ObjectTableName"""


@query("pf8_create_drop_rename_filters", f"SELECT QueryID, c, d FROM ({_FLAGS}) f")
def create_drop_rename_filters(t):
    return t["v_usage"].select(
        "QueryID", usage.is_create().alias("c"), usage.is_change().alias("d"))


@query("pf9_latest_day_slice", f"""
SELECT Username, ObjectDatabaseName, StatementType, logdate_Grouped, StatementType_Count FROM ({_LATEST}) l
WHERE StatementType = 'view' AND Username = 'u1'""")
def latest_day_slice(t):
    return usage.latest_statements(t["v_usage"], "view", "u1")


@query("wn4_latest_rows_per_table", f"SELECT QueryID, ObjectTableName, logdate FROM ({_LATEST}) l")
def latest_rows_per_table(t):
    return usage.latest_rows(t["v_usage"]).select("QueryID", "ObjectTableName", "logdate")


@query("jn9_existential_later_drop", f"""
SELECT ObjectTableName FROM ({_TEMP}) t
WHERE ObjectTableName NOT IN (SELECT ObjectTableName FROM ({_CLASS}) k WHERE Table_Classification <> 'Temporary')""")
def existential_later_drop(t):
    return usage.temporary_tables(t["v_usage"])


@query("ag19_table_classification", _CLASS)
def table_classification(t):
    return usage.table_classes(t["v_usage"])


@query("jn10_label_every_row", f"""
SELECT u.QueryID, u.ObjectTableName, coalesce(k.Table_Classification, 'Active Table') AS Table_Classification
FROM {{v_usage}} u LEFT JOIN ({_CLASS}) k ON k.ObjectTableName = u.ObjectTableName""")
def label_every_row(t):
    return usage.classify_tables(t["v_usage"]).select(
        "QueryID", "ObjectTableName", "Table_Classification")


@query("fn14_blank_test", f"SELECT QueryID, blank FROM ({_FLAGS}) f")
def blank_test(t):
    return t["v_usage"].select("QueryID", tx.is_blank(F.col("SQLTEXTINFO")).alias("blank"))
