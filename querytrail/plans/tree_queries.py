"""Parse trees and tokens."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from querytrail.functions import text as tx
from querytrail.operators import tokens as tk
from querytrail.operators import trees as tr
from querytrail.plans.registry import query
from querytrail.plans.standins import Tables
from querytrail.session import store, work_folder
from querytrail.sources import sinks, texts

RULES = ["script", "line", "flag", "line"]
# What the steps after a stored node table read of it.
BELOW = [*tr.TREE, "node_id", "parent_id", "ordinal", "child_count", "node_type", "text"]
VISIT = [*tr.TREE, "node_id", "parent_id", "end_id", "kind", "rule_name", "token_name", "text"]
STRINGS = [*tr.TREE, "node_id", "kind", "rule_name", "text", "closes", "child_count", "stop"]


def nodes(t: Tables):
    return tr.flatten(t.tree_documents())


def tokens(t: Tables):
    return tk.read_tokens(t.token_documents())


# --- trees ---------------------------------------------------------------------------------

@query("tr1_flatten_trees", """
SELECT file, tree_no, node_id, parent_id, end_id, depth, ordinal, child_count, node_type, text, start, stop FROM {c_nodes}""")
def flatten_trees(t):
    return nodes(t).select(
        "file", "tree_no", "node_id", "parent_id", "end_id", "depth", "ordinal", "child_count",
        "node_type", "text", "start", "stop")


@query("sc4_tree_scan_four_layouts", """
SELECT CAST(l.layout AS BIGINT) AS layout, count(DISTINCT (n.file, n.tree_no)) AS trees, count(*) AS nodes
FROM {c_nodes} n JOIN (SELECT DISTINCT file, layout FROM {v_lines}) l ON l.file = n.file GROUP BY 1""")
def tree_scan_four_layouts(t):
    folder = work_folder(t.spark, "trees")
    # One document per text line keeps the number of files small; layouts are told apart inside.
    t.tree_documents().write.parquet(folder)
    read = tr.flatten(t.spark.read.parquet(folder), tr.TREE)
    layout = (F.regexp_extract("file", r"(\d+)", 1).cast("long") % 4).alias("layout")
    return read.groupBy(layout).agg(
        F.countDistinct("file", "tree_no").alias("trees"), F.count("*").alias("nodes"))


@query("sc5_metadata_scan", """
SELECT DISTINCT file AS document, CASE WHEN layout = 2 THEN file END AS filename,
  CASE WHEN layout = 2 THEN CAST(2 * max(n) OVER (PARTITION BY file) AS INT) END AS totalTokens,
  CASE WHEN layout = 2 THEN '0s' END AS processingTime, CASE WHEN layout = 2 THEN 'SUCCESS' END AS status,
  CASE WHEN layout = 2 THEN 'a,b' END AS failedQueries FROM {v_lines}""")
def metadata_scan(t):
    return texts.file_metadata(t.tree_documents()).withColumnRenamed("file", "document").withColumn(
        "failedQueries", F.array_join("failedQueries", ","))


@query("fn10_node_labels", """
SELECT node_type, kind, rule_name, token_name,
  CASE WHEN kind = 'rule' THEN rule_name || 'Context' ELSE 'TerminalNodeImpl' END AS class_name, count(*) AS nodes
FROM {c_labels} GROUP BY ALL""")
def node_labels(t):
    return nodes(t).groupBy("node_type", "kind", "rule_name", "token_name", "class_name").agg(
        F.count("*").alias("nodes"))


@query("tr2_child_counts", """
SELECT file, tree_no, node_id, child_count, child_count > 0 AS has_children FROM {c_nodes}""")
def child_counts(t):
    return tr.child_counts(nodes(t))


@query("tr3_parent_links", """
SELECT file, tree_no, node_id, node_type, parent_id, parent_type FROM {c_nodes}""")
def parent_links(t):
    return tr.parents(nodes(t))


_BELOW = """
SELECT n.file, n.tree_no, n.node_id, c.node_id AS child_id, c.node_type AS child_type, c.text AS child_text
FROM {{c_nodes}} n LEFT JOIN ({child}) c ON c.file = n.file AND c.tree_no = n.tree_no AND c.parent_id = n.node_id"""


@query("tr4_ith_child", _BELOW.format(child="SELECT * FROM {{c_nodes}} WHERE ordinal = 1").replace("{{", "{").replace("}}", "}"))
def ith_child(t):
    return tr.ith_child(tr.store_nodes(nodes(t).select(*BELOW)), 1)


@query("tr5_first_named_child", _BELOW.format(child="""
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY file, tree_no, parent_id ORDER BY ordinal) AS r
  FROM {{c_labels}} WHERE rule_name = 'line' OR token_name = 'line') f WHERE r = 1""").replace("{{", "{").replace("}}", "}"))
def first_named_child(t):
    return tr.first_child_named(tr.store_nodes(nodes(t).select(*BELOW, "rule_name", "token_name")), "line")


@query("tr6_children_of_rule", """
SELECT file, tree_no, parent_id, ordinal, node_id, text FROM {c_labels} WHERE rule_name = 'line' AND parent_id IS NOT NULL""")
def children_of_rule(t):
    return tr.children_named(nodes(t), "line_list")


@query("tr7_source_intervals", "SELECT file, tree_no, node_id, start, stop, text FROM {c_nodes}")
def source_intervals(t):
    return tr.intervals(nodes(t))


@query("tr8_rule_index", """
SELECT file, tree_no, node_id, CAST(CASE rule_name WHEN 'script' THEN 0 WHEN 'line' THEN 1 ELSE -1 END AS INT) AS rule_index
FROM {c_labels}""")
def rule_index(t):
    return tr.rule_index(nodes(t), ["script", "line", "line", "other"]).select(
        "file", "tree_no", "node_id", "rule_index")


_LINE = "'(line \"' || part_text || '\" \"' || supp_text || '\"' || CASE WHEN k = 5 THEN ' (flag \"' || flag_text || '\")' ELSE '' END || ')'"


@query("tr9_tree_strings", f"""
SELECT file, CAST(0 AS INT) AS tree_no, '(script ' || string_agg({_LINE}, ' ' ORDER BY n) || ')' AS tree
FROM {{v_lines}} WHERE layout < 3 GROUP BY 1
UNION ALL SELECT file, n - 1, {_LINE} FROM {{v_lines}} WHERE layout = 3""")
def tree_strings(t):
    return tr.tree_strings(nodes(t))


@query("tr10_visit_rules", """
SELECT file, CAST(CASE WHEN layout = 3 THEN n - 1 ELSE 0 END AS INT) AS tree_no,
  arg_max(part_text || supp_text, n) FILTER (flag_text <> 'N') AS result FROM (
  SELECT *, CASE WHEN part_text LIKE '%7' THEN 'N' ELSE 'Y' END AS flag_text FROM (SELECT * EXCLUDE (flag_text) FROM {v_lines}) x) l
GROUP BY 1, 2""")
def visit_rules(t):
    # flag nodes lie below line nodes, so a visitor for both reaches the lines only
    all_nodes = tr.store_nodes(nodes(t).select(*VISIT))
    first = all_nodes.filter("token_name = 'PART'").select(
        "file", "tree_no", F.col("parent_id").alias("node_id"), F.col("text").alias("part"))
    with_part = all_nodes.join(first, ["file", "tree_no", "node_id"], "left")
    return tr.visit(with_part, ["line", "flag"], F.when(~F.col("part").endswith("7"), F.col("text")))


@query("tr11_detailed_flat_form", """
SELECT file, tree_no, node_id, kind AS type, CASE WHEN kind = 'rule' THEN rule_name END AS rule_name,
  CAST(CASE WHEN kind = 'rule' THEN CASE rule_name WHEN 'script' THEN 0 WHEN 'line' THEN 1 ELSE 2 END END AS INT) AS rule_index,
  CASE WHEN kind = 'terminal' THEN token_name END AS token_type, CAST(CASE WHEN kind = 'terminal' THEN s.i END AS INT) AS token_index,
  text, CAST(s.i AS INT) AS start_index, s.w AS start_text, CASE WHEN kind = 'rule' THEN e.w END AS stop_text
FROM {c_labels} n
LEFT JOIN (SELECT file AS f, n * 100 AS a, 2 * n - 2 AS i, part_text AS w FROM {v_lines} WHERE layout = 2
  UNION ALL SELECT file, n * 100 + 10, 2 * n - 1, supp_text FROM {v_lines} WHERE layout = 2) s ON s.f = file AND s.a = start
LEFT JOIN (SELECT file AS f, n * 100 + 9 AS b, part_text AS w FROM {v_lines} WHERE layout = 2
  UNION ALL SELECT file, n * 100 + 19, supp_text FROM {v_lines} WHERE layout = 2) e ON e.f = file AND e.b = stop""")
def detailed_flat_form(t):
    documents = tk.read_tokens(t.tree_documents(), nested=True)
    listed = tr.flatten(documents, tr.READ_WITH_TOKENS, with_tokens=True)
    full = tr.detailed(listed, None, RULES)
    return full.select(
        "file", "tree_no", "node_id", "type", "rule_name", "rule_index", "token_type", "token_index",
        "text", F.col("start_token.token_index").alias("start_index"),
        F.col("start_token.text").alias("start_text"), F.col("stop_token.text").alias("stop_text"))


@query("tr12_combined_trees", f"""
SELECT file, CASE WHEN layout = 3 THEN count(*) ELSE 1 END AS children,
  CAST(sum(k) + CASE WHEN layout = 3 THEN 1 ELSE 2 END AS BIGINT) AS nodes, CAST(max(n) * 100 AS INT) AS stop,
  CASE WHEN layout = 3 THEN '(unknown ' ELSE '(unknown (script ' END || string_agg({_LINE}, ' ' ORDER BY n)
    || CASE WHEN layout = 3 THEN ')' ELSE '))' END AS tree FROM {{v_lines}} GROUP BY file, layout""")
def combined_trees(t):
    lengths = t["v_lines"].groupBy("file").agg((F.max("n") * 100).alias("length"))
    listed = tr.store_nodes(nodes(t).drop("kind", "rule_name", "token_name", "class_name"))
    combined = tr.store_nodes(tr.combine_trees(listed, lengths).select(*STRINGS))
    root = F.col("node_id") == 0
    numbers = combined.groupBy("file").agg(
        F.max(F.when(root, F.col("child_count"))).alias("children"),
        F.count("*").alias("nodes"), F.max(F.when(root, F.col("stop"))).alias("stop"))
    return tr.tree_strings(combined).join(numbers, "file").drop("tree_no")


@query("sk7_tree_export", """
SELECT replace(file, '.txt', '.json') AS file_name, count(*) AS nodes FROM {c_nodes} GROUP BY 1""")
def tree_export(t):
    folder = work_folder(t.spark, "trees")
    sinks.write_trees(t.tree_documents(), folder)
    out = t.spark.read.parquet(folder)
    return tr.flatten(out.withColumnsRenamed({"file_name": "file", "value": "payload"})).groupBy(
        F.col("file").alias("file_name")).agg(F.count("*").alias("nodes"))


def _count_leaves(tree: pa.Table) -> pa.Table:
    return pa.table({
        "file": tree["file"][:1], "tree_no": tree["tree_no"][:1],
        "leaves": [pc.sum(pc.equal(tree["child_count"], 0)).as_py()],
        "deepest": [pc.max(tree["depth"]).as_py()]})


@query("ud2_caller_tree_visitor", """
SELECT file, tree_no, count(*) FILTER (child_count = 0) AS leaves, CAST(max(depth) AS BIGINT) AS deepest
FROM {c_nodes} GROUP BY 1, 2""")
def caller_tree_visitor(t):
    return tr.visit_with(
        nodes(t).select("file", "tree_no", "child_count", "depth"), _count_leaves,
        "file string, tree_no int, leaves bigint, deepest bigint")


# --- tokens --------------------------------------------------------------------------------

_T = 'file, pos, index, type, type_name, text, start_index, stop_index, line, "column", channel'


@query("tk1_explode_tokens", f"SELECT {_T} FROM {{c_tokens}}")
def explode_tokens(t):
    return tokens(t)


@query("tk2_token_index_range", f"""
SELECT {_T} FROM {{c_tokens}} WHERE pos BETWEEN 5 AND 40 AND type IN (2, 5)""")
def token_index_range(t):
    return tk.in_positions(tokens(t), 5, 40, [2, 5])


@query("tk3_tokens_by_type", f"""
SELECT 'id' AS by_what, {_T} FROM {{c_tokens}} WHERE type = 6
UNION ALL SELECT 'name', {_T} FROM {{c_tokens}} WHERE type_name = 'T0'""")
def tokens_by_type(t):
    # both read the lists: what either wants is read once
    wanted = store(tokens(t).filter("type = 6 or type_name = 'T0'"), "tokens")
    return tk.of_type(wanted, 6).withColumn("by_what", F.lit("id")).unionByName(
        tk.of_type_name(wanted, "T0").withColumn("by_what", F.lit("name")))


@query("tk4_token_range_text", """
SELECT file, string_agg(text, '' ORDER BY pos) AS text FROM {c_tokens} WHERE pos >= 3 GROUP BY 1""")
def token_range_text(t):
    return tk.range_text(tokens(t), 3)


@query("tk5_tokens_in_character_range", f"""
SELECT {_T}, CAST(NULL AS BIGINT) AS range_start FROM {{c_tokens}} WHERE start_index >= 250 AND stop_index <= 2200
UNION ALL SELECT {", ".join("c." + x.strip() for x in _T.split(","))}, range_start FROM {{c_tokens}} c JOIN (
  SELECT concat('d', doc_id) AS file, n_chars % 1000 AS range_start, n_chars % 1000 + n_chars AS range_stop FROM {{documents}}) r
  ON r.file = c.file AND start_index >= range_start AND stop_index <= range_stop""")
def tokens_in_character_range(t):
    ranges = store(t["documents"].select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("file"),
        (F.col("n_chars") % 1000).alias("range_start"),
        (F.col("n_chars") % 1000 + F.col("n_chars")).alias("range_stop")), "ranges")
    # the lists are read once: what neither range nor ranges can hold is left out
    marked = tk.mark_near(tokens(t), ranges)
    wanted = store(marked.filter(tk.is_inside(250, 2200) | F.col(tk.NEAR)), "tokens")
    one = tk.inside(wanted.drop(tk.NEAR), 250, 2200).withColumn("range_start", F.lit(None).cast("long"))
    return one.unionByName(tk.inside_ranges(wanted, ranges).drop("range_stop"))


@query("tk6_tokens_between_points", f"""
SELECT {_T} FROM {{c_tokens}} WHERE (line > 2 OR (line = 2 AND "column" >= 4)) AND (line < 5 OR (line = 5 AND "column" <= 3))""")
def tokens_between_points(t):
    return tk.between_points(tokens(t), (2, 4), (5, 3))


@query("tk7_token_display_text", """
SELECT file, pos, '[@' || index || ',' || start_index || ':' || stop_index || '=''' || text || ''',<' || type_name || '>,' || line || ':' || "column" || ']' AS display
FROM {c_tokens}""")
def token_display_text(t):
    return tk.display(tokens(t)).select("file", "pos", "display")


@query("ag9_token_type_distribution", """
SELECT file, type_name, count(*) AS tokens FROM {c_tokens} GROUP BY 1, 2
UNION ALL SELECT file, NULL, count(*) FROM {c_tokens} GROUP BY 1""")
def token_type_distribution(t):
    distribution = tk.type_distribution(tokens(t))
    return distribution.unionByName(tk.sizes(distribution), allowMissingColumns=True)


@query("wn5_token_look_ahead", """
SELECT file, pos, coalesce(lead(type, 1) OVER w, -1) AS la_2, lead(text, 1) OVER w AS lt_2,
  coalesce(lead(type, 3) OVER w, -1) AS la_4, lead(text, 3) OVER w AS lt_4,
  coalesce(lag(type, 2) OVER w, -1) AS la_m1, lag(text, 2) OVER w AS lt_m1
FROM {c_tokens} WINDOW w AS (PARTITION BY file ORDER BY pos)""")
def token_look_ahead(t):
    return tk.look_ahead(tokens(t), [2, 4, -1]).select(
        "file", "pos", "la_2", "lt_2", "la_4", "lt_4", "la_m1", "lt_m1")


@query("fn11_literal_type_names", """
SELECT node_type, CASE WHEN token_name LIKE '''%''' THEN substr(token_name, 2, length(token_name) - 2) ELSE token_name END AS type_name,
  count(*) AS nodes FROM {c_labels} WHERE kind = 'terminal' GROUP BY 1, 2""")
def literal_type_names(t):
    return nodes(t).filter("kind = 'terminal'").groupBy(
        "node_type", tx.literal_name(F.col("token_name")).alias("type_name")).agg(
        F.count("*").alias("nodes"))
