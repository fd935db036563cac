"""Query log, extraction, levels and log mining."""

from __future__ import annotations

from pyspark.sql import functions as F

from querytrail import batches, jobs
from querytrail.functions import dates
from querytrail.functions import text as tx
from querytrail.operators import extraction as ex
from querytrail.operators import levels, logmine
from querytrail.plans.registry import query
from querytrail.plans.standins import Tables
from querytrail.session import work_folder
from querytrail.sources import log_store, sinks, tables, texts

DB, START, END = "db1", "1997-01-01", "1997-06-30"
LISTED = [f"t{i}" for i in range(1, 150, 5)]
_IN = ", ".join(f"'{n}'" for n in LISTED)
# A span of 13 windows for the work-list extraction.
SPAN_START, SPAN_END = "1997-01-01", "1998-01-31"

_SHOW = """ProcID, strftime(logdate, '%Y-%m-%d') AS logdate,
  strftime(CollectTimeStamp, '%Y-%m-%dT%H:%M:%S') AS CollectTimeStamp, SessionID, QueryID, StatementType,
  ObjectDatabaseName, ObjectTableName, Username, SQLTEXTINFO"""


def _logs(t: Tables):
    return t["v_obj"], t["v_log"], t["v_sql"]


def _show(df):
    return df.withColumn("logdate", tx.iso_date(F.col("logdate"))).withColumn(
        "CollectTimeStamp", tx.iso_timestamp(F.col("CollectTimeStamp")))


@query("sc3_query_log_scan", """
SELECT 'obj' AS log, ObjectDatabaseName AS part, count(*) AS "rows", min(QueryID) AS low FROM {v_obj} GROUP BY 2
UNION ALL SELECT 'log', StatementType, count(*), min(QueryID) FROM {v_log} GROUP BY 2
UNION ALL SELECT 'sql', SQLTEXTINFO, count(*), min(QueryID) FROM {v_sql} GROUP BY 2""")
def query_log_scan(t):
    folder = work_folder(t.spark, "logs")
    paths = [f"{folder}/{n}" for n in ("obj", "log", "sql")]
    for df, path in zip(_logs(t), paths, strict=True):
        df.write.parquet(path)
    parts = ["ObjectDatabaseName", "StatementType", "SQLTEXTINFO"]
    out = None
    for df, name, part in zip(
            tables.read_query_log(t.spark, *paths), ("obj", "log", "sql"), parts, strict=True):
        one = df.groupBy(F.col(part).alias("part")).agg(
            F.count("*").alias("rows"), F.min("QueryID").alias("low")
        ).select(F.lit(name).alias("log"), "part", "rows", "low")
        out = one if out is None else out.unionByName(one)
    return out


@query("pf4_parametrised_log_filter", f"""
SELECT 'obj' AS log, ProcID, QueryID FROM {{v_obj}}
WHERE ObjectDatabaseName = '{DB}' AND ObjectTableName IN ({_IN})
UNION ALL SELECT 'log', ProcID, QueryID FROM {{v_log}} WHERE trim(StatementType) = 'Insert'
UNION ALL SELECT 'sql', ProcID, QueryID FROM {{v_sql}} WHERE logdate BETWEEN DATE '{START}' AND DATE '{END}'""")
def parametrised_log_filter(t):
    objects, users, texts_ = ex.log_filter(*_logs(t), DB, LISTED, "Insert", START, END)
    key = ["ProcID", "QueryID"]
    return objects.select(F.lit("obj").alias("log"), *key).unionByName(
        users.select(F.lit("log").alias("log"), *key)).unionByName(
        texts_.select(F.lit("sql").alias("log"), *key))


_THREE_LOGS = """
SELECT ObjectDatabaseName, trim(StatementType) AS StatementType, Username, count(*) AS "rows",
  CAST(sum(SessionID) AS BIGINT) AS sessions, min(SQLTEXTINFO) AS first_text
FROM {v_obj} JOIN {v_log} USING (ProcID, QueryID, logdate) JOIN {v_sql} USING (ProcID, QueryID, logdate)
GROUP BY 1, 2, 3"""


@query("jn1_three_log_join", _THREE_LOGS)
def three_log_join(t):
    return _call_totals(ex.join_logs(*_logs(t)))


def _call_totals(joined):
    return joined.groupBy(
        "ObjectDatabaseName", F.trim("StatementType").alias("StatementType"), "Username").agg(
        F.count("*").alias("rows"), F.sum("SessionID").alias("sessions"),
        F.min("SQLTEXTINFO").alias("first_text"))


@query("sc3_log_store_join", _THREE_LOGS)
def log_store_join(t):
    # Orders with seven lines count as hot queries, so that both parts of the store hold rows.
    return _call_totals(ex.join_stored_logs(
        log_store.write_log_store(_logs(t), work_folder(t.spark, "log-store"), buckets=8, hot_rows=6)))


@query("ag1_distinct_extract_rows", f"""
SELECT DISTINCT {_SHOW}
FROM {{v_obj}} JOIN {{v_log}} USING (ProcID, QueryID, logdate) JOIN {{v_sql}} USING (ProcID, QueryID, logdate)
WHERE trim(StatementType) = 'Insert' AND ObjectDatabaseName = '{DB}' AND ObjectTableName IN ({_IN})
  AND logdate BETWEEN DATE '{START}' AND DATE '{END}'""")
def distinct_extract_rows(t):
    return _show(ex.fetch(*_logs(t), DB, LISTED, "Insert", START, END, prefilter=True))


@query("fn8_calendar_windows", """
SELECT o_orderkey, CAST(w + 1 AS INT) AS window_no, strftime(d0 + CAST(w * 30 AS INT), '%Y-%m-%d') AS window_start,
  strftime(least(d0 + CAST(w * 30 + 29 AS INT), d1), '%Y-%m-%d') AS window_end
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d0, CAST(max(l_shipdate) AS DATE) AS d1,
    unnest(range(0, CAST(CAST(max(l_shipdate) AS DATE) - CAST(o_orderdate AS DATE) AS BIGINT) // 30 + 1)) AS w FROM {orders} JOIN {lineitem} ON o_orderkey = l_orderkey GROUP BY 1, 2) t
WHERE d0 + CAST(w * 30 AS INT) < d1""")
def calendar_windows(t):
    spans = t["orders"].join(t["lineitem"], F.col("o_orderkey") == F.col("l_orderkey")).groupBy(
        "o_orderkey", F.to_date("o_orderdate").alias("d0")).agg(
        F.to_date(F.max("l_shipdate")).alias("d1"))
    return dates.windows_between(spans, "d0", "d1").select(
        "o_orderkey", "window_no", tx.iso_date(F.col("window_start")).alias("window_start"),
        tx.iso_date(F.col("window_end")).alias("window_end"))


@query("fn13_iso_dates", """
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, max(strftime(ts, '%Y-%m-%dT%H:%M:%S')) AS last_time,
  count(*) AS "rows" FROM {events} GROUP BY 1""")
def iso_dates(t):
    return t["events"].groupBy(tx.iso_date(F.col("ts")).alias("day")).agg(
        F.max(tx.iso_timestamp(F.col("ts"))).alias("last_time"), F.count("*").alias("rows"))


@query("jn3_work_list_minus_done", """
SELECT db, tbl FROM {v_work} WHERE NOT EXISTS (
  SELECT 1 FROM {v_ledger} WHERE target_db = db AND target_table = tbl)""")
def work_list_minus_done(t):
    return ex.remaining(t.table_column("v_work"), t["v_ledger"]).select(
        "db", F.col("table").alias("tbl"))


_NUMBERED = """
SELECT db, tbl, pos, CAST((row_number() OVER (PARTITION BY db ORDER BY pos) - 1) // 100 + 1 AS BIGINT) AS batch_number
FROM {v_work}"""


@query("wn2_batch_numbers", f"SELECT db, tbl, batch_number FROM ({_NUMBERED}) n")
def batch_numbers(t):
    return ex.number_batches(t.table_column("v_work"), "pos").select(
        "db", F.col("table").alias("tbl"), "batch_number")


@query("ag10_batch_packing", f"""
SELECT db, batch_number, string_agg(tbl, ',' ORDER BY pos) AS tables, CAST(count(*) AS INT) AS batch_size
FROM ({_NUMBERED}) n GROUP BY 1, 2""")
def batch_packing(t):
    return ex.pack_batches(t.table_column("v_work"), "pos").withColumn(
        "tables", F.array_join("tables", ","))


_EXTRACTED = f"""
SELECT DISTINCT {_SHOW}, logdate AS day, batch_number,
  CAST(date_diff('day', DATE '{SPAN_START}', logdate) // 30 + 1 AS INT) AS window_no
FROM {{v_obj}} JOIN {{v_log}} USING (ProcID, QueryID, logdate) JOIN {{v_sql}} USING (ProcID, QueryID, logdate)
JOIN (SELECT db, tbl, (row_number() OVER (PARTITION BY db ORDER BY pos) - 1) // 100 + 1 AS batch_number
      FROM (SELECT * FROM {{v_work}} WHERE NOT EXISTS (
        SELECT 1 FROM {{v_ledger}} WHERE target_db = db AND target_table = tbl)) r) w
  ON ObjectDatabaseName = db AND ObjectTableName = tbl
WHERE trim(StatementType) IN ('Insert', 'Update') AND logdate BETWEEN DATE '{SPAN_START}' AND DATE '{SPAN_END}'
  AND DATE '{SPAN_START}' + CAST(date_diff('day', DATE '{SPAN_START}', logdate) // 30 * 30 AS INT) < DATE '{SPAN_END}'"""


def extracted(t: Tables):
    numbered = ex.number_batches(
        ex.remaining(t.table_column("v_work"), t["v_ledger"]), "pos")
    return ex.extract_work_list(
        numbered, *_logs(t), ["Insert", "Update"],
        F.lit(SPAN_START).cast("date"), F.lit(SPAN_END).cast("date"), prefilter=True)


@query("lv2_windows_batches_types_in_one_job", f"""
SELECT * EXCLUDE (day), strftime(DATE '{SPAN_START}' + (window_no - 1) * 30, '%Y-%m-%d') AS window_start,
  strftime(least(DATE '{SPAN_START}' + (window_no * 30 - 1), DATE '{SPAN_END}'), '%Y-%m-%d') AS window_end
FROM ({_EXTRACTED}) e""")
def windows_batches_types(t):
    return _show(extracted(t)).withColumn("window_start", tx.iso_date(F.col("window_start"))).withColumn(
        "window_end", tx.iso_date(F.col("window_end")))


@query("ag11_extraction_row_totals", f"""
SELECT db, batch_number, window_start, count(*) AS "rows", CAST(grouping(db, batch_number, window_start) AS BIGINT) AS level
FROM (SELECT ObjectDatabaseName AS db, batch_number,
    strftime(DATE '{SPAN_START}' + (window_no - 1) * 30, '%Y-%m-%d') AS window_start FROM ({_EXTRACTED}) e) x
GROUP BY ROLLUP (db, batch_number, window_start)""")
def extraction_row_totals(t):
    return ex.row_totals(extracted(t)).withColumn(
        "window_start", tx.iso_date(F.col("window_start")))


# Outcome of each batch: it fails when some query of the batch has a large total.
_OUTCOMES = """
SELECT db, batch_number, bool_and(big <= 0) AS ok FROM (
  SELECT db, (row_number() OVER (PARTITION BY db ORDER BY pos) - 1) // 100 + 1 AS batch_number, big
  FROM {v_work} JOIN (SELECT concat('db', l_suppkey % 5) AS d, concat('t', l_partkey % 300) AS o,
      sum(CASE WHEN l_quantity = 50 AND l_discount = 0.1 AND l_tax = 0.08 THEN 1 ELSE 0 END) AS big
      FROM {lineitem} GROUP BY 1, 2) s ON d = db AND o = tbl) j GROUP BY 1, 2"""


def outcomes(t: Tables):
    hard = (F.col("l_quantity") == 50) & (F.col("l_discount") == 0.1) & (F.col("l_tax") == 0.08)
    big = t["lineitem"].groupBy(
        F.concat(F.lit("db"), (F.col("l_suppkey") % 5).cast("string")).alias("db"),
        F.concat(F.lit("t"), (F.col("l_partkey") % 300).cast("string")).alias("table"),
    ).agg(F.count_if(hard).alias("big"))
    return ex.number_batches(t.table_column("v_work"), "pos").join(big, ["db", "table"]).groupBy(
        "db", "batch_number").agg(F.bool_and(F.col("big") <= 0).alias("ok"))


@query("ag12_batch_outcome_summary", f"""
SELECT 'summary' AS part, NULL AS db, NULL AS batch_number, count(*) AS total_batches,
  count(*) FILTER (ok) AS successful_batches, count(*) FILTER (NOT ok) AS failed_batches FROM ({_OUTCOMES}) o
UNION ALL SELECT 'failed', db, batch_number, NULL, NULL, NULL FROM ({_OUTCOMES}) o WHERE NOT ok""")
def batch_outcome_summary(t):
    result = outcomes(t)
    failed = ex.failed_batches(result).withColumn("part", F.lit("failed"))
    return ex.outcome_summary(result).withColumn("part", F.lit("summary")).unionByName(
        failed, allowMissingColumns=True)


@query("ag13_completion_check", """
SELECT processed_tables, total_tables, processed_tables >= total_tables AS completed FROM (
  SELECT (SELECT count(*) FROM (SELECT DISTINCT target_db, target_table FROM {v_ledger}) a) AS processed_tables,
         (SELECT count(*) FROM {v_work}) AS total_tables) c""")
def completion_check(t):
    return ex.completion(t.table_column("v_work"), t["v_ledger"])


@query("lv3_ledger_append_after_success", f"""
SELECT target_db, target_table, batch_number, batch_size, processed_date FROM (
  SELECT n.db AS target_db, n.tbl AS target_table, n.batch_number,
    CAST(count(*) OVER (PARTITION BY n.db, n.batch_number) AS INT) AS batch_size, '2024-06-30' AS processed_date, ok
  FROM ({_NUMBERED}) n JOIN ({_OUTCOMES}) o ON n.db = o.db AND n.batch_number = o.batch_number) x WHERE ok""")
def ledger_append(t):
    folder = work_folder(t.spark, "ledger")
    packed = ex.pack_batches(t.table_column("v_work"), "pos")
    rows = ex.ledger_rows(packed, outcomes(t), F.lit("2024-06-30").cast("date"))
    ex.append_ledger(rows, folder)
    return t.spark.read.parquet(folder)


# The second batch of one database meets an error in its updates.
_REFUSED = f"""
SELECT DISTINCT db, batch_number FROM ({_NUMBERED}) n JOIN {{v_obj}} ON ObjectDatabaseName = db AND ObjectTableName = tbl
JOIN {{v_log}} USING (ProcID, QueryID, logdate) JOIN {{v_sql}} USING (ProcID, QueryID, logdate)
WHERE db = 'db3' AND batch_number = 2 AND trim(StatementType) = 'Update' AND logdate BETWEEN DATE '{SPAN_START}' AND DATE '{SPAN_END}'
  AND DATE '{SPAN_START}' + CAST(date_diff('day', DATE '{SPAN_START}', logdate) // 30 * 30 AS INT) < DATE '{SPAN_END}'"""


@query("lv3_real_batch_outcomes", f"""
SELECT 'done' AS part, db, batch_number, CAST(count(*) AS INT) AS batch_size, CAST(NULL AS VARCHAR) AS tables,
  CAST(NULL AS VARCHAR) AS statement, CAST(NULL AS VARCHAR) AS error
FROM ({_NUMBERED}) n WHERE (db, batch_number) NOT IN ({_REFUSED}) GROUP BY 2, 3
UNION ALL SELECT 'failed', db, batch_number, CAST(count(*) AS INT), string_agg(tbl, ',' ORDER BY pos), 'Update',
  'no more spool space' FROM ({_NUMBERED}) m WHERE (db, batch_number) IN ({_REFUSED}) GROUP BY 2, 3""")
def real_batch_outcomes(t):
    folder = work_folder(t.spark, "outcomes")
    refused = (F.col("ObjectDatabaseName") == "db3") & (F.col("batch_number") == 2) & (F.trim("StatementType") == "Update")
    text = F.when(refused, F.raise_error(F.lit("no more spool space"))).otherwise(F.col("SQLTEXTINFO"))
    jobs.extract_statements(
        t.spark, t.table_column("v_work").select("db", "table", "pos"), _logs(t), ["Insert", "Update"],
        F.lit(SPAN_START).cast("date"), F.lit(SPAN_END).cast("date"), f"{folder}/extract", f"{folder}/ledger",
        F.lit("2024-06-30").cast("date"), check=lambda rows: rows.withColumn("SQLTEXTINFO", text),
        failed=f"{folder}/failed")
    done = batches.read_ledger(t.spark, f"{folder}/ledger").groupBy(
        F.col("target_db").alias("db"), "batch_number").agg(F.first("batch_size").alias("batch_size"))
    failed = batches.read_failed(t.spark, f"{folder}/failed").withColumn(
        "tables", F.array_join("tables", ",")).withColumn(
        "error", F.regexp_extract("error", "no more spool space", 0))
    return done.withColumn("part", F.lit("done")).unionByName(
        failed.withColumn("part", F.lit("failed")), allowMissingColumns=True)


@query("sk1_append_extract_sink", """
SELECT statement_type, count(*) AS "rows", CAST(sum(QueryID) AS BIGINT) AS queries FROM (
  SELECT trim(StatementType) AS statement_type, QueryID
  FROM {v_obj} JOIN {v_log} USING (ProcID, QueryID, logdate) JOIN {v_sql} USING (ProcID, QueryID, logdate)) e
GROUP BY 1""")
def append_extract_sink(t):
    folder = work_folder(t.spark, "extract")
    rows = ex.join_logs(*_logs(t))
    kind = F.trim("StatementType")
    sinks.append_extracts(rows.filter(kind == "Insert"), folder)
    sinks.append_extracts(rows.filter(kind != "Insert"), folder)
    return t.spark.read.parquet(folder).groupBy("statement_type").agg(
        F.count("*").alias("rows"), F.sum("QueryID").alias("queries"))


# --- log mining ----------------------------------------------------------------------------

# The two log messages.
_SPOOL = r"WARNING.*Spool\s+error\s+for\s+(\w+)\s+tables\s+(\[[^\]]*\])"
_SKIP = (
    r"WARNING.*Skipping\s+date\s+range\s+(\d{4}-\d{2}-\d{2})\s*(?:->|→)\s*(\d{4}-\d{2}-\d{2})"
    r"\s+for\s+(\w+)\s+[Bb]atch\s+(\d+)\s+due\s+to\s+error"
)

_PAIRED = rf"""
SELECT *, db = skip_db AND readable AS good FROM (
  SELECT file, line_no, regexp_extract(line, '{_SPOOL}', 1) AS db, regexp_extract(line, '{_SPOOL}', 2) AS list,
    regexp_extract(line, '{_SPOOL}', 2) LIKE '[''%' AS readable,
    regexp_extract(nxt, '{_SKIP}', 1) AS s, regexp_extract(nxt, '{_SKIP}', 2) AS e,
    regexp_extract(nxt, '{_SKIP}', 3) AS skip_db, regexp_extract(nxt, '{_SKIP}', 4) AS b
  FROM (SELECT *, lead(line) OVER (PARTITION BY file ORDER BY line_no) AS nxt FROM {{v_loglines}}) l
  WHERE regexp_matches(line, '{_SPOOL}') AND regexp_matches(nxt, '{_SKIP}')) p"""
_CHOSEN = f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY file, run ORDER BY line_no) AS r FROM (
  SELECT *, line_no - row_number() OVER (PARTITION BY file ORDER BY line_no) AS run FROM ({_PAIRED}) a WHERE good) b) c
WHERE r % 2 = 1"""
_MINED = f"""
SELECT db AS "Database", unnest(string_split(replace(replace(replace(list, '''', ''), '[', ''), ']', ''), ', ')) AS "Table",
  s AS Start_Date, e AS End_Date, b AS Batch FROM ({_CHOSEN}) k"""


@query("wn1_adjacent_line_pairs", _MINED)
def adjacent_line_pairs(t):
    return logmine.skipped_tables(t["v_loglines"])


@query("wn3_log_pair_summary", f"""
SELECT file, count(*) FILTER (what = 'p') AS processed_pairs, CAST(sum(n) AS BIGINT) AS table_entries,
  count(*) FILTER (what = 's') AS skipped_lines FROM (
  SELECT file, 'p' AS what, len(string_split(list, ', ')) AS n FROM ({_CHOSEN}) k
  UNION ALL SELECT file, 's', 0 FROM ({_PAIRED}) q WHERE NOT good AND NOT EXISTS (
    SELECT 1 FROM ({_CHOSEN}) u WHERE u.file = q.file AND u.line_no + 1 = q.line_no)) x GROUP BY 1""")
def log_pair_summary(t):
    return logmine.mining_summary(t["v_loglines"])


@query("fn6_log_captures", rf"""
SELECT file, line_no, regexp_extract(line, '{_SPOOL}', 1) AS "Database", regexp_extract(line, '{_SPOOL}', 2) AS table_list,
  regexp_extract(line, '{_SKIP}', 1) AS Start_Date, regexp_extract(line, '{_SKIP}', 2) AS End_Date,
  regexp_extract(line, '{_SKIP}', 3) AS skip_db, regexp_extract(line, '{_SKIP}', 4) AS Batch FROM {{v_loglines}}""")
def log_captures(t):
    line = tx.trim_blank(F.col("line"))
    captured = t["v_loglines"].select(
        "file", "line_no", F.coalesce(logmine.spool_capture(line), F.lit("")).alias("a"),
        F.coalesce(logmine.skip_capture(line), F.lit("")).alias("b"))
    return captured.select(
        "file", "line_no", *logmine.fields(F.col("a"), logmine.SPOOL_NAMES),
        *logmine.fields(F.col("b"), logmine.SKIP_NAMES))


@query("fn7_printed_lists", r"""
SELECT file, line_no, CASE WHEN l LIKE '[''%' THEN replace(replace(replace(l, '''', ''), '[', ''), ']', '') END AS names
FROM (SELECT file, line_no, regexp_extract(line, '(\[[^\]]*\])', 1) AS l FROM {v_loglines}) x WHERE l <> ''""")
def printed_lists(t):
    found = t["v_loglines"].select(
        "file", "line_no", F.regexp_extract("line", r"(\[[^\]]*\])", 1).alias("l")).filter("l <> ''")
    return found.select("file", "line_no", F.array_join(tx.quoted_list(F.col("l")), ", ").alias("names"))


@query("sc6_numbered_log_scan", """
SELECT file, count(*) AS lines, CAST(max(line_no) AS BIGINT) AS last_no, CAST(sum(line_no * length(line)) AS BIGINT) AS weight
FROM (SELECT file, row_number() OVER (PARTITION BY file ORDER BY line_no) AS line_no, line FROM {v_loglines}) l
GROUP BY 1""")
def numbered_log_scan(t):
    folder = work_folder(t.spark, "log")
    (
        t["v_loglines"].repartition("file").sortWithinPartitions("file", "line_no")
        .select("file", F.col("line").alias("value")).write.partitionBy("file").text(folder)
    )
    lines = texts.read_log_lines(t.spark, f"{folder}/*")
    return lines.withColumn("file", F.regexp_extract("file", "file=([^/]+)", 1)).groupBy("file").agg(
        F.count("*").alias("lines"), F.max("line_no").alias("last_no"),
        F.sum(F.col("line_no") * F.length("line")).alias("weight"))


@query("lv4_skipped_windows_to_repeat", f"""
SELECT DISTINCT m.db, t.tbl, m.batch_number, m.Start_Date, m.End_Date FROM (
  SELECT DISTINCT "Database" AS db, CAST(Batch AS BIGINT) AS batch_number, Start_Date, End_Date
  FROM ({_MINED}) k JOIN ({_NUMBERED}) n ON n.db = "Database" AND n.batch_number = CAST(Batch AS BIGINT) AND n.tbl = "Table") m
JOIN ({_NUMBERED}) t ON t.db = m.db AND t.batch_number = m.batch_number""")
def skipped_windows_to_repeat(t):
    packed = ex.pack_batches(t.table_column("v_work"), "pos")
    skipped = logmine.skipped_tables(t["v_loglines"])
    return logmine.windows_to_repeat(skipped, packed).withColumnRenamed("table", "tbl").withColumn(
        "batch_number", F.col("batch_number").cast("long"))


# --- levels --------------------------------------------------------------------------------

@query("jn5_next_level_frontier", """
SELECT DISTINCT target_db AS db, target_table AS tbl FROM {v_edges} e
WHERE EXISTS (SELECT 1 FROM {v_seeds} s WHERE s.db = e.db AND s.tbl = e.tbl)
  AND NOT EXISTS (SELECT 1 FROM {v_seeds} s WHERE s.db = e.target_db AND s.tbl = e.target_table)""")
def next_level_frontier(t):
    seeds = t.table_column("v_seeds")
    output = t.table_column("v_edges").join(seeds, ["db", "table"], "left_semi")
    return levels.next_frontier(output, seeds).withColumnRenamed("table", "tbl")


def _level_sql(depth: int) -> str:
    steps = ["l1 AS (SELECT DISTINCT db, tbl FROM {v_seeds})"]
    for k in range(2, depth + 1):
        p = f"l{k - 1}"
        steps.append(
            f"l{k} AS (SELECT DISTINCT e.target_db AS db, e.target_table AS tbl FROM {{v_edges}} e"
            f" JOIN {p} ON {p}.db = e.db AND {p}.tbl = e.tbl"
            f" WHERE NOT EXISTS (SELECT 1 FROM {p} q WHERE q.db = e.target_db AND q.tbl = e.target_table))")
    union = " UNION ALL ".join(f"SELECT {k} AS level, db, tbl FROM l{k}" for k in range(1, depth + 1))
    return f"SELECT * FROM (WITH {', '.join(steps)} {union}) levels"


@query("lv1_level_expansion", _level_sql(6))
def level_expansion(t):
    return levels.expand_levels(
        t.table_column("v_edges"), t.table_column("v_seeds"), 6).withColumnRenamed("table", "tbl")
