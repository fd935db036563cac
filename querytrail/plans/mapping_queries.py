"""Pair filters, unions, mapping comparison and database resolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from querytrail.operators import databases as db
from querytrail.operators import mapping as mp
from querytrail.operators import merge, pairs
from querytrail.plans.registry import query
from querytrail.plans.standins import Tables
from querytrail.schemas import strings
from querytrail.session import store, work_folder
from querytrail.sources import global_map, sinks, tables

# --- pair filters --------------------------------------------------------------------------

_WIDE = "l_orderkey, l_linenumber, l_quantity, db, tbl"
_MATCH = "coalesce(w.db, 'nan') = p.db AND coalesce(w.tbl, 'nan') = p.tbl"
SOME = [("db1", "t1"), ("db3", "t103"), ("db2", "t7"), ("db2", "t22"), ("nan", "t11"), ("db4", "t299")]
_SOME = " OR ".join(
    f"(ObjectDatabaseName = '{d}' AND ObjectTableName = '{t}')" for d, t in SOME)
_OBJECTS = "ProcID, QueryID, ObjectDatabaseName, ObjectTableName"


def _objects(t: Tables):
    return t["v_obj"].select("ProcID", "QueryID", "ObjectDatabaseName", "ObjectTableName")


@query("jn2_pair_semi_join", f"""
SELECT {_WIDE} FROM {{v_wide}} w WHERE EXISTS (SELECT 1 FROM {{v_pairs}} p WHERE {_MATCH})""")
def pair_semi_join(t):
    return pairs.semi_join_pairs(t["v_wide"], t["v_pairs"], "db", "tbl")


@query("pf5_any_of_pairs_filter", f"SELECT {_OBJECTS} FROM {{v_obj}} WHERE {_SOME}")
def any_of_pairs_filter(t):
    return pairs.filter_pairs(_objects(t), SOME, "ObjectDatabaseName", "ObjectTableName")


@query("pf6_single_pair_filter", f"""
SELECT {_OBJECTS} FROM {{v_obj}} WHERE ObjectDatabaseName = 'db3' AND ObjectTableName = 't13'""")
def single_pair_filter(t):
    return pairs.filter_pair(_objects(t), "db3", "t13", "ObjectDatabaseName", "ObjectTableName")


@query("ag4_unique_pairs", """
SELECT DISTINCT coalesce(db, 'nan') AS db, coalesce(tbl, 'nan') AS tbl FROM {v_wide}""")
def unique_pairs(t):
    return pairs.unique_pairs(t["v_wide"], "db", "tbl").withColumnRenamed("table", "tbl")


_METRICS = f"""
SELECT rows_processed, rows_matched, round(rows_matched * 100.0 / rows_processed, 2)::DOUBLE AS match_rate FROM (
  SELECT count(*) AS rows_processed, count(*) FILTER (EXISTS (SELECT 1 FROM {{v_pairs}} p WHERE {_MATCH})) AS rows_matched
  FROM {{v_wide}} w) x"""


@query("ag5_match_metrics", _METRICS)
def match_metrics(t):
    return pairs.match_metrics(t["v_wide"], t["v_pairs"], "db", "tbl")


@query("ag5_counts_while_writing", _METRICS)
def counts_while_writing(t):
    folder = work_folder(t.spark, "matches")
    return pairs.write_matches(
        t["v_wide"], store(t["v_pairs"], "pairs"), lambda rows: sinks.write_table(rows, folder), "db", "tbl")


# --- unions --------------------------------------------------------------------------------

_ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice"


def _slice(t: Tables, status: str):
    return t["orders"].filter(F.col("o_orderstatus") == status).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query("se1_header_checked_concat", f"SELECT {_ORDERS} FROM {{orders}}")
def header_checked_concat(t):
    return merge.concat_checked(merge.concat_checked(_slice(t, "F"), _slice(t, "O")), _slice(t, "P"))


@query("se2_positional_concat", f"""
SELECT {_ORDERS} FROM {{orders}} WHERE o_orderstatus <> 'P'
UNION ALL SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM {{orders}} WHERE o_orderstatus = 'P'""")
def positional_concat(t):
    other = _slice(t, "P").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")
    whole = merge.concat_positional(_slice(t, "F"), _slice(t, "O"))
    return merge.concat_positional(whole, other)


@query("se3_combine_statement_extracts", f"""
SELECT {_ORDERS} FROM {{orders}} WHERE o_orderstatus IN ('F', 'O')
UNION ALL SELECT o_orderkey, NULL, o_orderstatus, o_totalprice FROM {{orders}} WHERE o_orderstatus = 'P'""")
def combine_statement_extracts(t):
    short = _slice(t, "P").select("o_totalprice", "o_orderstatus", "o_orderkey")
    return merge.combine_extracts([_slice(t, "F"), _slice(t, "O"), short])


# --- mapping comparison --------------------------------------------------------------------

_COLS = ["target_db", "target_table", "target_column", "source_db", "source_table", "source_column"]
_KEY = "lower(concat_ws('|', " + ", ".join(f"trim(coalesce({c}, 'nan'))" for c in _COLS) + "))"
_LIST = ", ".join(_COLS)


def _first(name: str) -> str:
    return (
        f"SELECT comparison_key, {_LIST} FROM (SELECT *, row_number() OVER (PARTITION BY comparison_key"
        f" ORDER BY pos) AS r FROM (SELECT *, {_KEY} AS comparison_key FROM {{{name}}}) k) f WHERE r = 1")


_DIFF = f"""
SELECT '12' AS error_code, {_LIST}, 'Present in File 1 but not in File 2' AS description FROM ({_first('v_map_a')}) a
WHERE comparison_key NOT IN (SELECT {_KEY} FROM {{v_map_b}})
UNION ALL SELECT '21', {_LIST}, 'Present in File 2 but not in File 1' FROM ({_first('v_map_b')}) b
WHERE comparison_key NOT IN (SELECT {_KEY} FROM {{v_map_a}})"""


def _messy(df):
    """The same mapping under other header spellings."""
    return df.withColumnsRenamed({
        "source_db": " Source_Database ", "target_db": "TargetDB", "source_table": "Source Table",
        "target_column": "Target Column ", "source_column": "SourceColumn"})


def differences(t: Tables):
    return mp.compare_mappings(t["v_map_a"], _messy(t["v_map_b"]), ["pos"])


@query("pf1_header_normalisation", f"SELECT pos, {_LIST} FROM {{v_map_b}}")
def header_normalisation(t):
    df = t["v_map_b"].withColumnsRenamed({c: f" {c.replace('_', ' ').title()} " for c in _COLS})
    return mp.normalize_headers(df)


@query("pf2_alias_resolution", f"SELECT pos, {_LIST} FROM {{v_map_b}}")
def alias_resolution(t):
    return mp.resolve_aliases(mp.normalize_headers(_messy(t["v_map_b"])), ("pos",))


@query("pf3_comparison_key", f"SELECT {_KEY} AS comparison_key, count(*) AS \"rows\" FROM {{v_map_b}} GROUP BY 1")
def comparison_key(t):
    return t["v_map_b"].groupBy(mp.comparison_key().alias("comparison_key")).agg(
        F.count("*").alias("rows"))


@query("ag2_keep_first_by_key", _first("v_map_a"))
def keep_first_by_key(t):
    return mp.unique_mapping(t["v_map_a"], ["pos"])


@query("jn4_mapping_differences", _DIFF)
def mapping_differences(t):
    return differences(t)


@query("or1_ordered_difference_report", _DIFF + """
ORDER BY error_code, target_db NULLS LAST, target_table NULLS LAST, target_column NULLS LAST""")
def ordered_difference_report(t):
    return mp.ordered_report(differences(t))


@query("ag8_difference_counts", f"""
SELECT error_code, target_db, count(*) AS differences FROM ({_DIFF}) d GROUP BY 1, 2""")
def difference_counts(t):
    return mp.difference_counts(differences(t))


@query("or2_first_rows_and_rest", f"""
SELECT *, CAST((SELECT greatest(count(*) - 10, 0) FROM ({_DIFF}) e) AS BIGINT) AS more_rows FROM ({_DIFF}) d
ORDER BY error_code, target_db, target_table, target_column, source_db NULLS LAST, source_table, source_column LIMIT 10""")
def first_rows_and_rest(t):
    return mp.sample_report(
        store(differences(t), "differences"), [*mp.REPORT_ORDER, "source_db", "source_table", "source_column"])


# --- database resolution -------------------------------------------------------------------

_SEVEN = "source_col, source_table, target_table, target_col, source_db, target_db, Derivation_logic"
_UNIQUE = f"""
SELECT pos, {_SEVEN} FROM (SELECT *, row_number() OVER (PARTITION BY {_SEVEN} ORDER BY pos) AS r FROM {{v_lineage}}) u
WHERE r = 1"""
_SIDES = """
SELECT side, table_name, arg_max(database_name, first_pos) FILTER (database_name IS NOT NULL) AS lineage_db FROM (
  SELECT side, table_name, database_name, min(pos) AS first_pos FROM (
    SELECT 'source' AS side, source_table AS table_name, source_db AS database_name, pos FROM {v_lineage}
    UNION ALL SELECT 'target', target_table, target_db, pos FROM {v_lineage}) s
  WHERE table_name IS NOT NULL GROUP BY 1, 2, 3) p GROUP BY 1, 2"""
_SAVED = """
SELECT table_name, arg_min(database_name, map_pos) AS map_db FROM {v_tmap}
WHERE table_name IS NOT NULL AND database_name IS NOT NULL GROUP BY 1"""
_MAP = f"""
SELECT coalesce(l.side, m.side) AS side, coalesce(l.table_name, m.table_name) AS table_name,
  coalesce(lineage_db, map_db) AS database_name
FROM ({_SIDES}) l FULL JOIN (SELECT * FROM ({_SAVED}) x, (SELECT unnest(['source', 'target']) AS side) y) m
  ON l.side = m.side AND l.table_name = m.table_name
WHERE coalesce(lineage_db, map_db) IS NOT NULL"""
_NEED = f"""
SELECT table_name, bool_or(side = 'source') AS as_source, bool_or(side = 'target') AS as_target FROM ({_SIDES}) s
WHERE lineage_db IS NULL AND table_name NOT IN (SELECT table_name FROM ({_SAVED}) k) GROUP BY 1"""
_FOUND = f"""
SELECT n.table_name, coalesce(d, 'Unknown') AS database_name FROM ({_NEED}) n LEFT JOIN (
  SELECT tablename, DatabaseName AS d FROM (SELECT *, row_number() OVER (PARTITION BY tablename
    ORDER BY LastAccessTimeStamp DESC, DatabaseName DESC) AS r FROM {{v_catalog}}
    WHERE LastAccessTimeStamp IS NOT NULL) c WHERE r = 1) k ON k.tablename = n.table_name"""


@query("ag3_lineage_dedup", _UNIQUE)
def lineage_dedup(t):
    return db.unique_lineage(t["v_lineage"], ["pos"])


@query("ag14_table_map_build", _MAP)
def table_map_build(t):
    return db.build_table_map(t["v_lineage"], t["v_tmap"], "pos", "map_pos")


@query("se5_tables_needing_lookup", _NEED)
def tables_needing_lookup(t):
    return db.tables_needing_lookup(t["v_lineage"], t["v_tmap"], "pos", "map_pos")


@query("jn8_catalog_lookup", _FOUND)
def catalog_lookup(t):
    return db.resolve_databases(t["v_lineage"], t["v_tmap"], t["v_catalog"], "pos", "map_pos")[1]


@query("jn7_database_fill_join", f"""
SELECT * FROM (WITH full_map AS (SELECT * FROM ({_MAP}) m UNION ALL
  SELECT side, n.table_name, database_name FROM ({_NEED}) n JOIN ({_FOUND}) f ON n.table_name = f.table_name,
    (SELECT unnest(['source', 'target']) AS side) y WHERE CASE side WHEN 'source' THEN as_source ELSE as_target END)
SELECT pos, source_col, source_table, target_table, target_col, coalesce(s.database_name, source_db) AS source_db,
  coalesce(g.database_name, target_db) AS target_db, Derivation_logic
FROM ({_UNIQUE}) u LEFT JOIN full_map s ON s.side = 'source' AND s.table_name = source_table
LEFT JOIN full_map g ON g.side = 'target' AND g.table_name = target_table) filled""")
def database_fill_join(t):
    return db.resolve_databases(t["v_lineage"], t["v_tmap"], t["v_catalog"], "pos", "map_pos")[0]


@query("jn6_new_global_pairs", """
SELECT DISTINCT target_db AS db, target_table AS tbl FROM {v_lineage} l WHERE target_db IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM {v_global} g WHERE g.db = target_db AND g.tbl = target_table)""")
def new_global_pairs(t):
    current = t["v_lineage"].filter("target_db is not null").select(
        F.col("target_db").alias("db"), F.col("target_table").alias("table"))
    return db.new_pairs(current, t.table_column("v_global")).withColumnRenamed("table", "tbl")


@query("jn6_global_map_versions", """
SELECT DISTINCT target_db AS db, target_table AS tbl FROM {v_lineage} WHERE target_db IS NOT NULL
UNION SELECT db, tbl FROM {v_global}""")
def global_map_versions(t):
    folder = work_folder(t.spark, "global-map")
    global_map.add_pairs(t.spark, folder, t.table_column("v_global"))
    current = store(t["v_lineage"].filter("target_db is not null").select(
        F.col("target_db").alias("db"), F.col("target_table").alias("table")).distinct(), "pairs")
    for _ in range(2):  # the second run finds nothing to add
        global_map.add_pairs(t.spark, folder, current)
    return global_map.read_global_map(t.spark, folder).withColumnRenamed("table", "tbl")


@query("se4_unmapped_databases", """
SELECT db FROM (SELECT source_db AS db FROM {v_lineage} UNION SELECT target_db FROM {v_lineage}) d
WHERE db IS NOT NULL AND db NOT IN (SELECT db FROM {v_global})""")
def unmapped_databases(t):
    return db.unmapped_databases(t["v_lineage"], t["v_global"])


# --- delimited files -----------------------------------------------------------------------

_AS_TEXT = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in ["pos", *_COLS])


@query("sc1_delimited_scan", f"SELECT {_AS_TEXT} FROM {{v_map_a}}")
def delimited_scan(t):
    folder = work_folder(t.spark, "csv")
    sinks.write_table(t["v_map_a"], folder)
    return tables.read_table(t.spark, folder, strings(*t["v_map_a"].columns))


@query("sk2_overwrite_table_sink", f"SELECT * FROM ({_DIFF}) d")
def overwrite_table_sink(t):
    folder = work_folder(t.spark, "report")
    found = differences(t)
    sinks.write_table(found.limit(0), folder)
    sinks.write_table(found, folder)
    return tables.read_table(t.spark, folder)
