"""Parse trees of a whole corpus as one node table, and the navigation over it."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from querytrail.functions import documents as docs
from querytrail.functions import text as tx
from querytrail.functions.ordered import number_rows
from querytrail.schemas import END_NAME, END_OF_FILE, NODE, PLACED
from querytrail.session import local_frame, ship, store

TREE = ["file", "tree_no"]
# The synthetic root over the trees of one script.
COMBINED_TYPE = "CombinedQueries"
COMBINED_TEXT = "Multiple queries"


def read_nodes(documents: DataFrame, columns: list[str] | None = None, with_tokens: bool = False) -> DataFrame:
    """Flatten (file, payload) documents; unreadable ones become rows with `error`.

    Spark can't tell a Python function which columns are read later, so they may be named here.
    `with_tokens` takes documents with their token lists (`read_tokens(..., nested=True)`); nodes then have the
    tokens at which they begin and end (`start_token`, `stop_token`), found where their document is.
    """
    ship(documents.sparkSession)
    fields = [*NODE, *PLACED] if with_tokens else NODE
    wanted = [f for f in fields if columns is None or f.name in {*columns, "error"}]
    return documents.select("file", "payload", *(["tokens"] if with_tokens else [])).mapInArrow(
        docs.some_columns([f.name for f in wanted], with_tokens), T.StructType(wanted))


def nodes_of(read: DataFrame) -> DataFrame:
    """The node table with the derived labels kind, rule_name, token_name and class_name."""
    kind, good = F.col("node_type"), read.filter("error is null").drop("error")
    if "node_type" not in good.columns:
        return good
    return good.withColumns({
        "kind": tx.node_kind(kind), "rule_name": tx.rule_name(kind),
        "token_name": tx.token_name(kind), "class_name": tx.class_name(kind),
    })


def rejected_documents(read: DataFrame) -> DataFrame:
    return read.filter("error is not null").select("file", "error")


def flatten(documents: DataFrame, columns: list[str] | None = None, with_tokens: bool = False) -> DataFrame:
    return nodes_of(read_nodes(documents, columns, with_tokens))


def child_counts(nodes: DataFrame) -> DataFrame:
    """Number of children; `has_children` is false for leaves."""
    return nodes.select(
        *TREE, "node_id", "child_count", (F.col("child_count") > 0).alias("has_children"))


def parents(nodes: DataFrame) -> DataFrame:
    """Parent of every node (null for roots) with the parent's type; no join needed."""
    return nodes.select(*TREE, "node_id", "node_type", "parent_id", "parent_type")


def _below(nodes: DataFrame, children: DataFrame, least: int) -> DataFrame:
    """Every node with its row of `children`, which holds one child per parent at most.

    Only nodes with `least` children or more are joined; the others, most of a tree, pass by.
    """
    found = children.select(
        *TREE, F.col("parent_id").alias("node_id"), F.col("node_id").alias("child_id"),
        F.col("node_type").alias("child_type"), F.col("text").alias("child_text"))
    has = F.coalesce(F.col("child_count") >= least, F.lit(True))
    joined = nodes.filter(has).select(*TREE, "node_id").join(found, [*TREE, "node_id"], "left")
    return joined.unionByName(nodes.filter(~has).select(*TREE, "node_id"), allowMissingColumns=True)


def ith_child(nodes: DataFrame, i: int) -> DataFrame:
    """The i-th child (0-based) of every node; null when out of range. Pass a stored node table."""
    return _below(nodes, nodes.filter((F.col("ordinal") == i) & F.col("parent_id").isNotNull()), i + 1)


def first_child_named(nodes: DataFrame, name: str) -> DataFrame:
    """The first child with this rule or token name of every node; null without one.

    Node ids grow in pre-order, so the first child has the smallest one: a number, which combines
    before the shuffle. Pass a stored node table.
    """
    fitting = nodes.filter(
        ((F.col("rule_name") == name) | (F.col("token_name") == name)) & F.col("parent_id").isNotNull())
    first = fitting.groupBy(*TREE, "parent_id").agg(F.min("node_id").alias("node_id"))
    return _below(nodes, fitting.join(first, [*TREE, "parent_id", "node_id"], "left_semi"), 1)


def children_named(nodes: DataFrame, attribute: str) -> DataFrame:
    """All children of a rule, one row each with its place; `name_list` or `nameList` works too."""
    rule = attribute.replace("_list", "").replace("List", "")
    return nodes.filter((F.col("rule_name") == rule) & F.col("parent_id").isNotNull()).select(
        *TREE, "parent_id", "ordinal", "node_id", "text")


def intervals(nodes: DataFrame) -> DataFrame:
    return nodes.select(*TREE, "node_id", "start", "stop", "text")


def rule_index(nodes: DataFrame, rule_names: list[str]) -> DataFrame:
    """Position of the rule in a rule-name list; -1 if absent or not a rule."""
    first = {}
    for i, name in enumerate(rule_names):
        first.setdefault(name, i)
    listed = local_frame(nodes.sparkSession, {
        "rule_name": pa.array(list(first), pa.string()),
        "_index": pa.array(list(first.values()), pa.int32())})
    index = F.when(F.col("kind") != "terminal", F.col("_index"))
    return nodes.join(listed, "rule_name", "left").select(
        *nodes.columns, F.coalesce(index, F.lit(-1)).alias("rule_index"))


def tree_strings(nodes: DataFrame) -> DataFrame:
    """One line per tree: (rule child child), (rule), "text".

    Each node gives one piece; brackets that close after it are already counted. The result is a
    single text per tree, as its document was.
    """
    piece = F.concat(
        F.when(F.col("node_id") == 0, "").otherwise(" "),
        F.when(F.col("kind") == "terminal", F.concat(F.lit('"'), "text", F.lit('"')))
        .otherwise(F.concat(F.lit("("), "rule_name")),
        F.expr("repeat(')', cast(closes as int))"),
    )
    pieces = F.sort_array(F.collect_list(F.struct("node_id", piece.alias("piece"))))
    return nodes.groupBy(*TREE).agg(pieces.alias("p")).select(
        *TREE, F.array_join(F.col("p.piece"), "").alias("tree"))


def visited(nodes: DataFrame, rules: list[str]) -> DataFrame:
    """Rule nodes that a visitor with methods for these rules reaches, in pre-order.

    A method for `foo` also serves rules that are called `fooContext`.
    A visited node is not searched further, so nodes below another match are left out. The window
    holds the matches of one tree, which came as one document.
    """
    earlier = Window.partitionBy(*TREE).orderBy("node_id").rowsBetween(
        Window.unboundedPreceding, -1)
    served = [*rules, *(f"{rule}Context" for rule in rules)]
    matches = nodes.filter((F.col("kind") != "terminal") & F.col("rule_name").isin(served))
    return (
        matches.withColumn("_reach", F.max("end_id").over(earlier))
        .filter(F.col("_reach").isNull() | (F.col("_reach") < F.col("node_id"))).drop("_reach")
    )


def visit(nodes: DataFrame, rules: list[str], value: Column) -> DataFrame:
    """Result of a visit per tree: the value of the last visited node that has one."""
    reached = visited(nodes, rules).withColumn("_v", value)
    last = F.when(F.col("_v").isNotNull(), F.col("node_id"))
    return reached.groupBy(*TREE).agg(F.max_by("_v", last).alias("result"))


# What the detailed form reads of a node table, which need hold no more.
READ_OF_NODES = [*TREE, "node_id", "end_id", "kind", "rule_name", "token_name", "text", "start", "stop"]
# The same of nodes that were flattened with their tokens.
READ_WITH_TOKENS = [*TREE, "node_id", "node_type", "text", *PLACED.names]


def detailed(nodes: DataFrame, tokens: DataFrame | None, rule_names: list[str]) -> DataFrame:
    """Flat detailed form: rule index and start/stop token of rules, token of terminals.

    One row per node. Of several tokens at one offset (empty ones, the end of file) the first in the
    list counts; the end-of-file token belongs to the end-of-file terminal and to the rules that end
    with it only, although it begins and ends where other tokens do.

    Nodes that were flattened with their tokens need no other `tokens`, and are neither stored nor shuffled.
    """
    if tokens is None:
        placed = rule_index(nodes.filter("kind <> 'other'").select(
            *TREE, "node_id", "kind", "rule_name", "token_name", "text", *PLACED.names), rule_names)
    else:
        placed = _with_tokens(nodes, tokens, rule_names)
    is_rule = F.col("kind") == "rule"
    return placed.select(
        *TREE, "node_id", F.col("kind").alias("type"),
        F.when(is_rule, F.col("rule_name")).alias("rule_name"),
        F.when(is_rule, F.col("rule_index")).alias("rule_index"),
        F.when(~is_rule, F.col("token_name")).alias("token_type"),
        F.when(~is_rule, F.col("start_token.token_index")).alias("token_index"),
        "text", "start_token", F.when(is_rule, F.col("stop_token")).alias("stop_token"),
    )


def _with_tokens(nodes: DataFrame, tokens: DataFrame, rule_names: list[str]) -> DataFrame:
    """Nodes with `rule_index` and with their tokens out of a table of tokens."""
    token = F.struct(
        "type", "text", "line", "column", "start_index", "stop_index",
        F.col("index").alias("token_index"))
    at_end = (F.col("type") == END_OF_FILE) | (F.col("type_name") == END_NAME)
    # three steps read the tokens: their lists are parsed once
    listed = store(
        tokens.select("file", "pos", "index", "type", "type_name", "start_index", "stop_index", token.alias("_token")),
        "tokens")

    def side(name: str, offset: str) -> DataFrame:
        first = Window.partitionBy("file", offset).orderBy("index", "pos")
        return (
            listed.filter(~at_end).withColumn("_n", F.row_number().over(first)).filter("_n = 1")
            .select("file", F.col(offset).alias(f"_{name}_at"), F.col("_token").alias(name))
        )

    indexed = store(
        rule_index(nodes.filter("kind <> 'other'").select(*READ_OF_NODES), rule_names), "indexed-nodes")
    ends = indexed.filter((F.col("kind") == "terminal") & (F.col("token_name") == END_NAME)).groupBy(
        *TREE).agg(F.max("node_id").alias("_end_node"))
    end_tokens = listed.filter(at_end).groupBy("file").agg(F.min_by("_token", "pos").alias("_end_token"))
    known = store(
        ends.join(end_tokens, "file", "left").select(*TREE, "_end_node", "_end_token"), "end-nodes")
    placed = indexed.join(known, TREE, "left")
    first, last = side("start_token", "start_index"), side("stop_token", "stop_index")
    begun = placed.join(first.withColumnRenamed("_start_token_at", "start"), ["file", "start"], "left")
    is_rule = F.col("kind") == "rule"
    rules = begun.filter(is_rule).join(
        last.withColumnRenamed("_stop_token_at", "stop"), ["file", "stop"], "left")
    both = rules.unionByName(begun.filter(~is_rule), allowMissingColumns=True)
    ends_file = F.coalesce(F.col("end_id") == F.col("_end_node"), F.lit(False))
    is_end = ends_file & ~is_rule
    return both.withColumns({
        "start_token": F.when(is_end, F.col("_end_token")).otherwise(F.col("start_token")),
        "stop_token": F.when(ends_file, F.col("_end_token")).otherwise(F.col("stop_token")),
    })


def store_nodes(nodes: DataFrame) -> DataFrame:
    """The node table in the shared folder, for use by several operators."""
    return store(nodes, "nodes")


def _ends_tree() -> Column:
    """Whether a node is the last one of its tree: with it end all nodes above, if all of them are counted."""
    rule = (~F.col("node_type").startswith(tx.TERMINAL_MARK)).cast("int")
    return F.coalesce(F.col("closes") == F.col("depth") + rule, F.lit(True))


def _plain(nodes: DataFrame) -> bool:
    """Whether each tree has one root, and no terminal, which `closes` leaves out, has children."""
    odd = (F.col("child_count") > 0) & F.col("node_type").startswith(tx.TERMINAL_MARK)
    trees = nodes.groupBy(*TREE).agg(
        F.count_if(F.col("parent_id").isNull()).alias("roots"), F.count_if(odd).alias("odd"))
    return trees.filter("file is not null and tree_no is not null and (roots <> 1 or odd > 0)").isEmpty()


def combine_trees(nodes: DataFrame, lengths: DataFrame) -> DataFrame:
    """All trees of a file under one synthetic root; `lengths` holds (file, length) of the script.

    A node keeps its order as (tree number, node id) in one number, so no running total over the
    nodes of a file is needed; end ids follow the same rule. Pass a stored node table: it is read
    for the roots and for the nodes. What concerns whole trees (one row each) is stored, so the
    join with the nodes can be split where a file has very many. Only the first and the last node of
    a tree need it: where every tree has one root, the others pass by.
    """
    base = (F.col("tree_no").cast("long") + 1) * F.lit(1 << 32)
    roots = nodes.filter("parent_id is null").select(
        "file", "tree_no", (base + F.col("end_id")).alias("_last"))
    placed = store(number_rows(roots, ["file"], "tree_no", "_place"), "tree-places")
    per_file = placed.groupBy("file").agg(
        F.max("_last").alias("_file_end"), F.max("_place").alias("_trees"))
    places = store(
        placed.join(per_file, "file").select("file", "tree_no", "_place", "_file_end"),
        "tree-places")
    is_root, node_id = F.col("parent_id").isNull(), base + F.col("node_id")
    begins_or_ends, others = is_root | _ends_tree(), nodes.limit(0)
    joined = nodes
    if _plain(nodes):
        joined = nodes.filter(begins_or_ends)
        others = nodes.filter(~begins_or_ends & F.col("file").isNotNull() & F.col("tree_no").isNotNull())
    known = joined.join(places, TREE).unionByName(others, allowMissingColumns=True)
    moved = known.select(
        "file", F.lit(0).alias("tree_no"), node_id.alias("node_id"),
        F.coalesce(base + F.col("parent_id"), F.lit(0)).alias("parent_id"),
        (base + F.col("end_id")).alias("end_id"), (F.col("depth") + 1).alias("depth"),
        F.when(is_root, F.col("_place") - 1).otherwise(F.col("ordinal")).alias("ordinal"),
        "child_count",
        # the new root closes after the last node of the last tree
        (F.col("closes") + F.coalesce(node_id == F.col("_file_end"), F.lit(False)).cast("int")).alias("closes"),
        F.coalesce("parent_type", F.lit(COMBINED_TYPE)).alias("parent_type"),
        "node_type", "text", "start", "stop",
    )
    none, zero = F.lit(None), F.lit(0)
    top = per_file.join(lengths, "file").select(
        "file", zero.alias("tree_no"), zero.cast("long").alias("node_id"),
        none.cast("long").alias("parent_id"), F.col("_file_end").alias("end_id"),
        zero.alias("depth"), zero.cast("long").alias("ordinal"),
        F.col("_trees").alias("child_count"), zero.cast("long").alias("closes"),
        none.cast("string").alias("parent_type"), F.lit(COMBINED_TYPE).alias("node_type"),
        F.lit(COMBINED_TEXT).alias("text"), zero.alias("start"),
        F.col("length").cast("int").alias("stop"),
    )
    return nodes_of(top.unionByName(moved).withColumn("error", none.cast("string")))


def visit_with(
    nodes: DataFrame, visitor: Callable, schema: T.StructType | str
) -> DataFrame:
    """A caller's function over the rows of one tree at a time (Arrow table in, Arrow table out).

    The rows are sorted by tree and cut out of large batches: a batch of its own for each tree would
    cost more than most visits.
    """
    ship(nodes.sparkSession)
    names = list(T.StructType.fromDDL(schema).names if isinstance(schema, str) else schema.names)
    sorted_trees = nodes.repartition(*TREE).sortWithinPartitions(*TREE)
    return sorted_trees.mapInArrow(docs.per_tree(visitor, TREE, names), schema)
