"""Query logs, mappings, scripts, trees and tokens built from the given tables.

The SQL texts run unchanged on Spark and on the checking engine. They name given tables and other
stand-ins as {name}.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from querytrail.functions.documents import joined_texts, token_lists
from querytrail.session import ship, tune

GIVEN = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

# A position that is unique per lineitem row and grows with order and line.
_POS = "((l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey) * 10000 + l_suppkey"


def _mapping(table_prefix: str, shared: str, own: str) -> str:
    """A mapping over all lines; lines outside `shared` have target columns of their own."""
    return f"""
SELECT {_POS} AS pos,
  CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE concat('SDB', CAST(l_suppkey % 5 AS STRING)) END AS source_db,
  concat(CASE WHEN l_suppkey % 2 = 0 THEN '{table_prefix}' ELSE 'ST' END, CAST(l_partkey % 400 AS STRING)) AS source_table,
  concat('C', CAST(l_linenumber AS STRING)) AS source_column,
  concat('TDB', CAST(l_suppkey % 3 AS STRING)) AS target_db,
  concat('TT', CAST(l_orderkey % 6 AS STRING)) AS target_table,
  concat(CASE WHEN {shared} THEN 'C' ELSE '{own}' END, CAST(l_linenumber AS STRING)) AS target_column
FROM {{lineitem}}"""


VIEWS = {
    # --- query log ---
    "v_obj": """
SELECT l_orderkey % 4 AS ProcID, l_orderkey AS QueryID, CAST(o_orderdate AS DATE) AS logdate,
  concat('db', CAST(l_suppkey % 5 AS STRING)) AS ObjectDatabaseName,
  concat('t', CAST(l_partkey % 300 AS STRING)) AS ObjectTableName, l_shipdate AS CollectTimeStamp
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "v_log": """
SELECT o_orderkey % 4 AS ProcID, o_orderkey AS QueryID, CAST(o_orderdate AS DATE) AS logdate,
  o_custkey AS SessionID,
  CASE o_orderstatus WHEN 'F' THEN 'Insert ' WHEN 'O' THEN 'Select' ELSE 'Update' END AS StatementType,
  concat('u', CAST(o_custkey % 20 AS STRING)) AS Username FROM {orders}""",
    "v_sql": """
SELECT o_orderkey % 4 AS ProcID, o_orderkey AS QueryID, CAST(o_orderdate AS DATE) AS logdate,
  concat('INSERT INTO x SELECT ', o_orderpriority) AS SQLTEXTINFO FROM {orders}""",
    "v_work": f"""
SELECT concat('db', CAST(l_suppkey % 5 AS STRING)) AS db,
  concat('t', CAST(l_partkey % 300 AS STRING)) AS tbl, min({_POS}) AS pos
FROM {{lineitem}} GROUP BY 1, 2""",
    "v_ledger": """
SELECT concat('db', CAST(l_suppkey % 5 AS STRING)) AS target_db,
  concat('t', CAST(l_partkey % 300 AS STRING)) AS target_table,
  CAST(max(l_shipdate) AS DATE) AS processed_date
FROM {lineitem} WHERE l_quantity < 3 AND l_returnflag = 'R' GROUP BY 1, 2""",
    # --- lineage mappings ---
    "v_map_a": _mapping("st", "l_discount <= 0.05", "E"),
    "v_map_b": _mapping(" st", "l_tax <= 0.04", "D"),
    "v_lineage": f"""
SELECT {_POS} AS pos,
  concat('C', CAST(l_linenumber AS STRING)) AS source_col,
  CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE concat('ST', CAST(l_partkey % 500 AS STRING)) END AS source_table,
  concat('TT', CAST(l_orderkey % 700 AS STRING)) AS target_table,
  concat('C', CAST(l_linenumber % 3 AS STRING)) AS target_col,
  CASE WHEN l_partkey % 500 < 250 THEN NULL ELSE concat('SDB', CAST(l_suppkey % 5 AS STRING)) END AS source_db,
  CASE WHEN l_orderkey % 700 < 600 THEN concat('TDB', CAST(l_suppkey % 3 AS STRING)) ELSE NULL END AS target_db,
  l_returnflag AS Derivation_logic
FROM {{lineitem}}""",
    "v_tmap": """
SELECT p_partkey AS map_pos, concat(CASE WHEN p_size % 2 = 0 THEN 'ST' ELSE 'TT' END,
    CAST(p_partkey % 650 AS STRING)) AS table_name,
  CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE concat('MDB', CAST(p_size % 9 AS STRING)) END AS database_name
FROM {part}""",
    "v_catalog": """
SELECT concat(CASE WHEN l_quantity > 30 THEN 'ST' ELSE 'TT' END, CAST(l_partkey % 640 AS STRING)) AS tablename,
  concat('SDB', CAST(l_suppkey % 5 AS STRING)) AS DatabaseName,
  CASE WHEN l_linenumber = 1 THEN NULL ELSE l_shipdate END AS LastAccessTimeStamp FROM {lineitem}""",
    "v_global": """
SELECT DISTINCT concat('TDB', CAST(l_suppkey % 2 AS STRING)) AS db,
  concat('TT', CAST(l_orderkey % 350 AS STRING)) AS tbl FROM {lineitem} WHERE l_quantity < 25""",
    # --- usage ---
    "v_usage": """
SELECT event_id % 3 AS ProcID, event_id AS QueryID, event_id * 7 % 11 AS SessionID,
  CASE WHEN event_id % 97 = 5 THEN NULL ELSE concat('t', CAST(user_id AS STRING)) END AS ObjectTableName,
  concat('db', CAST(user_id % 4 AS STRING)) AS ObjectDatabaseName,
  CAST(CAST(ts AS DATE) AS STRING) AS logdate, CAST(CAST(ts AS DATE) AS STRING) AS logdate_Grouped,
  event_type AS StatementType, event_id % 5 AS StatementType_Count,
  concat('u', CAST(event_id % 2 AS STRING)) AS Username,
  CASE WHEN user_id % 10 = 0 THEN concat(' ', chr(9)) WHEN event_type = 'signup' THEN 'Create table x'
       WHEN event_type = 'error' THEN 'DROP TABLE x'
       WHEN event_type = 'purchase' THEN 'rename table a to b' ELSE NULL END AS SQLTEXTINFO
FROM {events}""",
    # --- extraction log: pairs of messages, other databases, unreadable lists, double messages ---
    "v_loglines": """
SELECT concat('f', CAST((event_id - event_id % 1000) AS STRING)) AS file, event_id AS line_no,
  CASE WHEN event_id % 2 = 0 OR event_id % 50 > 44
  THEN concat(CASE WHEN event_id % 50 > 44 THEN concat('2024-01-01 00:00:01,000 WARNING  Skipping date range 2024-01-01 -> 2024-01-30 for db',
       CAST(user_id % 2 AS STRING), ' Batch 4 due to error ') ELSE '  ' END,
       '2024-01-01 00:00:00,000 WARNING  Spool error for db', CAST(
         CASE WHEN event_id % 50 > 44 THEN user_id % 2 ELSE event_id % 6 END AS STRING),
       ' tables [', CASE WHEN event_id % 14 = 0 THEN 't1' ELSE concat('''t', CAST(user_id % 90 AS STRING), ''', ''t2''') END,
       ']... [x]: skip')
  ELSE concat('2024-01-01 00:00:01,000 WARNING  Skipping date range 2024-01-', CAST(10 + event_id % 9 AS STRING),
       CASE WHEN event_id % 3 = 0 THEN ' -> ' ELSE ' → ' END, '2024-02-', CAST(10 + event_id % 9 AS STRING), ' for db',
       CAST(((event_id - 1 + CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END) % 6) AS STRING),
       ' Batch ', CAST(1 + user_id % 3 AS STRING), ' due to error', chr(9)) END AS line
FROM {events}""",
    # --- lineage edges with cycles ---
    "v_edges": """
SELECT concat('db', CAST(c_custkey % 3 AS STRING)) AS db, concat('n', CAST(c_custkey AS STRING)) AS tbl,
  concat('db', CAST((c_custkey * 2 + 1) % 997 % 3 AS STRING)) AS target_db,
  concat('n', CAST((c_custkey * 2 + 1) % 997 AS STRING)) AS target_table FROM {customer}
UNION ALL
SELECT concat('db', CAST(c_custkey % 3 AS STRING)), concat('n', CAST(c_custkey AS STRING)),
  concat('db', CAST((c_custkey * 3 + 2) % 1013 % 3 AS STRING)),
  concat('n', CAST((c_custkey * 3 + 2) % 1013 AS STRING)) FROM {customer}""",
    "v_seeds": """
SELECT concat('db', CAST(c_custkey % 3 AS STRING)) AS db, concat('n', CAST(c_custkey AS STRING)) AS tbl
FROM {customer} WHERE c_acctbal < -950""",
    # --- pair filter ---
    "v_wide": """
SELECT l_orderkey, l_linenumber, l_quantity,
  CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE concat('d', CAST(l_suppkey AS STRING)) END AS db,
  concat('t', CAST(l_partkey AS STRING)) AS tbl FROM {lineitem}""",
    "v_pairs": """
SELECT DISTINCT concat('d', CAST(l_suppkey AS STRING)) AS db, concat('t', CAST(l_partkey AS STRING)) AS tbl
FROM {lineitem} WHERE l_discount >= 0.08
UNION SELECT 'nan', concat('t', CAST(p_partkey AS STRING)) FROM {part} WHERE p_size > 25""",
    # --- scripts: an order is a script, its lines are the parts, in order ---
    "v_ranked": f"""
SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {_POS}) AS INT) AS rank_no FROM {{lineitem}}""",
    "v_parts": """
SELECT concat('s', CAST(l_orderkey AS STRING), '.txt') AS file, l_orderkey, rank_no AS stmt_no,
  CASE WHEN l_quantity < 4 THEN concat(' ', chr(9), chr(10))
       WHEN l_returnflag = 'A' THEN concat(chr(10), 'SELECT c', CAST(l_partkey AS STRING), ' FROM t', CAST(l_suppkey AS STRING), '  ')
       WHEN l_returnflag = 'N' THEN concat(chr(13), chr(10), ' INSERT INTO t', CAST(l_suppkey AS STRING), chr(13), chr(10), 'VALUES (', CAST(l_partkey AS STRING), ')')
       ELSE concat('merge into t', CAST(l_partkey AS STRING), ' using s', CAST(l_suppkey AS STRING),
                   ' on a.id = b.id when matched then set x = 1 and a long rest of the statement that goes past one hundred characters') END AS part
FROM {v_ranked}""",
    # --- parser runs: one per order ---
    "v_runs": """
SELECT concat('s', CAST(o_orderkey AS STRING), '.txt') AS file, CAST(o_custkey % 400 AS BIGINT) AS duration,
  o_orderstatus = 'F' AS file_ok, o_orderstatus = 'O' AS reparse_ok,
  CASE WHEN o_custkey % 50 = 3 THEN 'boom' ELSE NULL END AS error FROM {orders}""",
    # --- tree lines: one rule per lineitem with two or three children ---
    "v_lines": """
SELECT concat('s', CAST(l_orderkey AS STRING), '.txt') AS file,
  l_orderkey % 4 AS layout, rank_no AS n, CASE WHEN l_linestatus = 'O' THEN 3 ELSE 5 END AS k,
  CAST(l_partkey AS STRING) AS part_text, CAST(l_suppkey AS STRING) AS supp_text, l_returnflag AS flag_text
FROM {v_ranked}""",
}


class Tables:
    """Given tables and stand-ins of one data folder as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = ship(tune(spark)), folder

    def __getitem__(self, name: str) -> DataFrame:
        if name in GIVEN:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        text = VIEWS[name]
        used = {n: self[n] for n in re.findall(r"\{([a-z]\w*)\}", text)}
        return self.spark.sql(text, **used)

    def table_column(self, name: str) -> DataFrame:
        """The stand-in with its `tbl` column under the library's name."""
        return self[name].withColumnRenamed("tbl", "table")

    def scripts(self) -> DataFrame:
        """(file, script): the parts of each script joined by `;` in order."""
        ordered = F.sort_array(F.collect_list(F.struct("stmt_no", "part")))
        return self["v_parts"].groupBy("file").agg(ordered.alias("p")).select(
            "file", F.array_join(F.col("p.part"), ";").alias("script"))

    def tree_documents(self) -> DataFrame:
        """(file, payload): one JSON document per script, in four layouts.

        The lines come with the key that they were ranked by, and sorted by it, so the texts are joined
        where the rows are, as they pass, and neither shuffled nor sorted. Token lists are built for the
        one layout that has them.
        """
        n = F.col("n")
        at = n * 100

        def text(name: str):
            # numbers, which need no escapes; missing ones are left out
            return F.coalesce(F.concat(F.lit('"text":"'), name, F.lit('",')), F.lit(""))

        def span(offset: int):
            return F.concat(
                F.lit('"startIndex":'), (at + offset).cast("string"),
                F.lit(',"stopIndex":'), (at + offset + 9).cast("string"))

        def leaf(kind: str, name: str, offset: int):
            return F.concat(F.lit(f'{{"nodeType":"Terminal: {kind}",'), text(name), span(offset), F.lit("}"))

        any_flag = F.to_json(F.struct(
            F.lit("Terminal: FLAG").alias("nodeType"), F.col("flag_text").alias("text"),
            (at + 20).alias("startIndex"), (at + 29).alias("stopIndex")))
        plain = F.col("flag_text").rlike(r"\A[A-Za-z0-9]*\z")
        flag = F.concat(
            F.lit('{"nodeType":"RuleContext: flag","children":['),
            F.when(plain, leaf("FLAG", "flag_text", 20)).otherwise(any_flag),
            F.lit('],"startIndex":'), (at + 20).cast("string"), F.lit("}"))
        children = F.concat_ws(
            ",", leaf("PART", "part_text", 0), leaf("'SUPP'", "supp_text", 10), F.when(F.col("k") == 5, flag))
        line = F.concat(
            F.lit('{"nodeType":"RuleContext: line","text":"'), "part_text", "supp_text",
            F.lit('","children":['), children, F.lit('],"startIndex":'), at.cast("string"),
            F.lit(',"stopIndex":'), (at + 99).cast("string"), F.lit("}"))

        def token(kind: str, number: int, name: str, offset: int):
            return F.concat(
                F.lit('{"index":'), (n * 2 - (2 - number) - 1).cast("string"),
                F.lit(f',"type":{number},"typeName":"{kind}",'), text(name), span(offset),
                F.lit(',"line":'), n.cast("string"), F.lit(f',"column":{offset}}}'))

        tokens = F.when(F.col("layout") == 2, F.concat(
            token("PART", 1, "part_text", 0), F.lit(","), token("SUPP", 2, "supp_text", 10)))
        keyed = self.spark.sql(
            VIEWS["v_lines"].replace("SELECT ", "SELECT l_orderkey, ", 1), v_ranked=self["v_ranked"])
        # An aggregate would sort the rows once more, with their texts. The ranking has sorted them by this key:
        # Spark leaves out the sort that is asked for.
        texts = keyed.select("l_orderkey", "file", "layout", "n", line.alias("lines"), tokens.alias("tokens"))
        rows = texts.sortWithinPartitions("l_orderkey").mapInArrow(
            joined_texts("l_orderkey", "n", ["file", "layout"], ["lines", "tokens"]),
            "file string, layout bigint, lines string, tokens string, size int, n int")
        lines = F.col("lines")
        # The end of the file stops where the last token does, and begins where a flag may begin.
        last = n * 100
        stream = F.concat_ws(",", "tokens", F.to_json(F.struct(
            (F.col("size") * 2).alias("index"), F.lit(-1).alias("type"), F.lit("EOF").alias("typeName"),
            F.lit("<EOF>").alias("text"), (last + 20).alias("startIndex"), (last + 19).alias("stopIndex"))))
        root = F.concat(F.lit('{"nodeType":"RuleContext: script","children":['), lines, F.lit("]}"))
        payload = (
            F.when(F.col("layout") == 0, root)
            .when(F.col("layout") == 1, F.concat(F.lit('{"parseTree":'), root, F.lit("}")))
            .when(F.col("layout") == 2, F.concat(
                F.lit('{"metadata":{"filename":"'), "file", F.lit('","totalTokens":'),
                (F.col("size") * 2).cast("string"),
                F.lit(',"processingTime":"0s","status":"SUCCESS","failedQueries":["a","b"]},"tokenStream":['),
                stream, F.lit('],"parseTree":'), root, F.lit("}")))
            .otherwise(F.concat(F.lit("["), lines, F.lit("]")))
        )
        return rows.select("file", payload.alias("payload"))

    def token_documents(self) -> DataFrame:
        """(file, payload): the words of each document as a token list."""
        file = F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("file")
        return self["documents"].select(file, "text").mapInArrow(token_lists, "file string, payload string")


# Rows that only the checking engine builds: what the documents above must turn into.
CHECK_VIEWS = {
    "c_lines": """
SELECT *, CAST(sum(k) OVER (PARTITION BY file ORDER BY n) - k AS BIGINT) AS before_k FROM {v_lines}""",
    "c_nodes": """
SELECT file, CAST(0 AS INT) AS tree_no, CAST(0 AS BIGINT) AS node_id, CAST(NULL AS BIGINT) AS parent_id,
  CAST(sum(k) AS BIGINT) AS end_id, 0 AS depth, CAST(0 AS BIGINT) AS ordinal, count(*) AS child_count,
  CAST(NULL AS VARCHAR) AS parent_type, 'RuleContext: script' AS node_type, '' AS text, -1 AS start, -1 AS stop
FROM {v_lines} WHERE layout < 3 GROUP BY file
UNION ALL
SELECT file, CASE WHEN layout = 3 THEN n - 1 ELSE 0 END, base + o,
  CASE WHEN o = 0 THEN CASE WHEN layout = 3 THEN NULL ELSE 0 END WHEN o = 4 THEN base + 3 ELSE base END,
  base + CASE o WHEN 0 THEN k - 1 WHEN 3 THEN 4 ELSE o END,
  CASE WHEN layout = 3 THEN 0 ELSE 1 END + CASE o WHEN 0 THEN 0 WHEN 4 THEN 2 ELSE 1 END,
  CASE o WHEN 0 THEN CASE WHEN layout = 3 THEN 0 ELSE n - 1 END WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN 2 ELSE 0 END,
  CASE o WHEN 0 THEN CASE WHEN k = 3 THEN 2 ELSE 3 END WHEN 3 THEN 1 ELSE 0 END,
  CASE o WHEN 0 THEN CASE WHEN layout = 3 THEN NULL ELSE 'RuleContext: script' END WHEN 4 THEN 'RuleContext: flag' ELSE 'RuleContext: line' END,
  CASE o WHEN 0 THEN 'RuleContext: line' WHEN 1 THEN 'Terminal: PART' WHEN 2 THEN 'Terminal: ''SUPP''' WHEN 3 THEN 'RuleContext: flag' ELSE 'Terminal: FLAG' END,
  CASE o WHEN 0 THEN part_text || supp_text WHEN 1 THEN part_text WHEN 2 THEN supp_text WHEN 3 THEN '' ELSE flag_text END,
  n * 100 + CASE o WHEN 2 THEN 10 WHEN 3 THEN 20 WHEN 4 THEN 20 ELSE 0 END,
  CASE o WHEN 0 THEN n * 100 + 99 WHEN 1 THEN n * 100 + 9 WHEN 2 THEN n * 100 + 19 WHEN 3 THEN -1 ELSE n * 100 + 29 END
FROM (SELECT *, CASE WHEN layout = 3 THEN 0 ELSE 1 + before_k END AS base FROM {c_lines}) l,
  (SELECT unnest([0, 1, 2, 3, 4]) AS o) s WHERE o < k""",
    "c_labels": """
SELECT *, CASE WHEN node_type LIKE 'Rule%' THEN 'rule' ELSE 'terminal' END AS kind,
  CASE WHEN node_type LIKE 'Rule%' THEN substr(node_type, 14) ELSE 'unknown' END AS rule_name,
  CASE WHEN node_type LIKE 'Term%' THEN substr(node_type, 11) ELSE 'unknown' END AS token_name
FROM {c_nodes}""",
    "c_tokens": """
SELECT concat('d', doc_id) AS file, CAST(i AS INT) AS pos, CAST(i AS INT) AS index,
  CAST(length(w) % 7 AS INT) AS type, concat('T', length(w) % 7) AS type_name, w AS text,
  CAST(i * 100 AS INT) AS start_index, CAST(i * 100 + length(w) - 1 AS INT) AS stop_index,
  CAST(i // 10 + 1 AS INT) AS line, CAST(i % 10 AS INT) AS "column", 0 AS channel
FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS w, unnest(range(len(string_split(text, ' ')))) AS i
  FROM {documents}) t""",
    "c_stmts": """
SELECT file, l_orderkey, stmt_no, trim(part, concat(' ', chr(9), chr(10), chr(13))) AS stmt,
  contains(part, 'SELECT') OR contains(part, 'INSERT') AS ok
FROM {v_parts} WHERE trim(part, concat(' ', chr(9), chr(10), chr(13))) <> ''""",
}


def check_sql(body: str) -> str:
    """The check query with the stand-ins it names as common table expressions."""
    every = {**VIEWS, **CHECK_VIEWS}
    order: list[str] = []

    def need(text: str) -> None:
        for name in re.findall(r"\{([a-z]\w*)\}", text):
            if name in every and name not in order:
                need(every[name])
                order.append(name)

    need(body)
    plain = lambda text: re.sub(r"\{([a-z]\w*)\}", r"\1", text).strip()
    head = ",\n".join(f"{n} AS ({plain(every[n])})" for n in order)
    return f"WITH {head}\n{plain(body)}" if order else plain(body)
