from __future__ import annotations

import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from querytrail.operators import tokens as tk
from querytrail.operators import trees as tr
from querytrail.sources import texts


def term(name, text, start=-1, stop=-1):
    return {"nodeType": f"Terminal: {name}", "text": text, "startIndex": start, "stopIndex": stop}


def rule(name, *children, **extra):
    return {"nodeType": f"RuleContext: {name}", "children": list(children), **extra}


SAMPLE = rule(
    "query", rule("select", term("SELECT", "select", 0, 5), rule("item", term("ID", "a", 7, 7)), rule("item", term("ID", "b", 9, 9))),
    rule("from", rule("item", term("ID", "t", 14, 14)), rule("empty")), startIndex=0, stopIndex=14)


def docs(spark, **payloads):
    return spark.createDataFrame(
        [(k, v if isinstance(v, str) else json.dumps(v)) for k, v in payloads.items()], "file string, payload string")


def walk(node, path=()):
    yield path, node
    for i, c in enumerate(node.get("children", [])):
        yield from walk(c, (*path, i))


def text_form(node):
    name = node["nodeType"]
    if name.startswith("Terminal"):
        return f'"{node["text"]}"'
    inner = " ".join(text_form(c) for c in node.get("children", []))
    return f"({name[13:]}{' ' if inner else ''}{inner})"


@pytest.mark.parametrize("layout", ["bare", "parseTree", "full", "list"])
def test_layouts(spark, layout):
    payload = {"bare": SAMPLE, "parseTree": {"parseTree": SAMPLE}, "list": [SAMPLE, term("X", "x")],
               "full": {"metadata": {}, "tokenStream": [], "parseTree": SAMPLE}}[layout]
    nodes = tr.flatten(docs(spark, f=payload))
    first = nodes.filter("tree_no = 0").orderBy("node_id").collect()
    order = list(walk(SAMPLE))
    assert [r.node_type for r in first] == [n["nodeType"] for _, n in order]
    ids = {p: i for i, (p, _) in enumerate(order)}
    for r, (p, n) in zip(first, order, strict=True):
        assert r.parent_id == (ids[p[:-1]] if p else None)
        assert r.end_id == max(i for q, i in ids.items() if q[:len(p)] == p)
        assert (r.depth, r.ordinal, r.child_count) == (len(p), p[-1] if p else 0, len(n.get("children", [])))
        assert (r.text, r.start, r.stop) == (n.get("text", ""), n.get("startIndex", -1), n.get("stopIndex", -1))
    assert nodes.filter("tree_no = 1").count() == (1 if layout == "list" else 0)
    strings = {r.tree_no: r.tree for r in tr.tree_strings(nodes).collect()}
    assert strings[0] == text_form(SAMPLE)


def test_bad_documents_are_reported_not_fatal(spark):
    read = tr.read_nodes(docs(
        spark, ok=SAMPLE, broken="{", number="7", text='"x"', wrong=rule("a", startIndex="1"),
        bad_child=rule("a", 5), none="null", nothing="[]", big=rule("a", startIndex=1 << 40)))
    assert {r.file for r in tr.rejected_documents(read).collect()} == {
        "broken", "number", "text", "wrong", "bad_child", "none", "big"}
    assert {r.file for r in tr.nodes_of(read).collect()} == {"ok"}


def test_deep_trees_and_their_tokens(spark):
    tree = term("X", "x")
    for _ in range(600):
        tree = rule("r", tree)
    payload = json.dumps({"tokenStream": [{"index": 0, "text": "x"}], "parseTree": tree, "metadata": {"filename": "f"}})
    d = docs(spark, f=payload)
    nodes = tr.flatten(d)
    assert nodes.agg(F.max("depth"), F.count("*")).first() == (600, 601)
    assert tr.tree_strings(nodes).first().tree == "(r " * 600 + '"x"' + ")" * 600
    assert tk.read_tokens(d).count() == 1
    assert texts.file_metadata(d).first().filename == "f"


def test_navigation(spark, rows):
    nodes = tr.flatten(docs(spark, f=SAMPLE))
    ids = {(r.node_type, r.text, r.node_id): r.node_id for r in nodes.collect()}
    assert len(ids) == 11
    assert rows(tr.children_named(nodes, "item_list").select("parent_id", "ordinal", "node_id")) == [
        (1, 1, 3), (1, 2, 5), (7, 0, 8)]
    assert rows(tr.children_named(nodes, "itemList")) == rows(tr.children_named(nodes, "item"))
    first = {r.node_id: r.child_id for r in tr.first_child_named(nodes, "item").collect()}
    assert first == {i: {1: 3, 7: 8}.get(i) for i in range(11)}
    second = {r.node_id: r.child_id for r in tr.ith_child(nodes, 1).collect()}
    assert second == {i: {0: 7, 1: 3, 7: 10}.get(i) for i in range(11)}
    assert {r.node_id: r.child_id for r in tr.first_child_named(nodes, "ID").collect()}[3] == 4
    assert {r.rule_index for r in tr.rule_index(nodes, ["query", "item", "item"]).collect()} == {0, 1, -1}
    parents = {r.node_id: (r.parent_id, r.parent_type) for r in tr.parents(nodes).collect()}
    assert parents[0] == (None, None) and parents[10] == (7, "RuleContext: from")


def test_visits_stop_at_a_match(spark, rows):
    nodes = tr.flatten(docs(spark, f=SAMPLE, g=rule("item", rule("item"))))
    assert rows(tr.visited(nodes, ["item", "from"]).select("file", "node_id")) == [
        ("f", 3), ("f", 5), ("f", 7), ("g", 0)]
    value = F.when(F.col("rule_name") == "item", F.col("node_id"))
    assert rows(tr.visit(nodes, ["item", "from"], value)) == [("f", 0, 5), ("g", 0, 0)]


def test_combined_trees(spark):
    nodes = tr.flatten(docs(spark, f=[SAMPLE, term("X", "x"), rule("z")]))
    kept = nodes.filter("tree_no <> 1")  # the middle statement failed
    lengths = spark.createDataFrame([("f", 77)], "file string, length int")
    both = tr.combine_trees(kept, lengths)
    assert tr.tree_strings(both).first().tree == f"(unknown {text_form(SAMPLE)} (z))"
    root = both.filter("parent_id is null").first()
    assert (root.node_type, root.text, root.start, root.stop, root.child_count) == (
        "CombinedQueries", "Multiple queries", 0, 77, 2)
    tops = both.filter("parent_id = 0").orderBy("ordinal").collect()
    assert [(r.ordinal, r.depth, r.parent_type) for r in tops] == [(0, 1, "CombinedQueries"), (1, 1, "CombinedQueries")]
    assert both.filter(F.col("end_id") > root.end_id).isEmpty()


def test_detailed_form(spark):
    stream = [{"index": i, "type": 3, "text": t, "startIndex": a, "stopIndex": b}
              for i, (t, a, b) in enumerate([("select", 0, 5), (" ", 6, 6), ("a", 7, 7), ("b", 9, 9), ("t", 14, 14)])]
    d = docs(spark, f={"tokenStream": stream, "parseTree": SAMPLE})
    got = {r.node_id: r for r in tr.detailed(tr.flatten(d), tk.read_tokens(d), ["query", "item"]).collect()}
    assert (got[0].type, got[0].rule_index, got[0].start_token.text, got[0].stop_token.text) == ("rule", 0, "select", "t")
    assert (got[2].type, got[2].token_type, got[2].token_index, got[2].stop_token) == ("terminal", "SELECT", 0, None)
    assert (got[10].rule_index, got[10].start_token) == (-1, None)


def test_detailed_form_with_end_of_file_and_empty_tokens(spark):
    tree = rule("file", rule("word", dict(term("W", "ab"), startIndex=0, stopIndex=1)),
                dict(term("EOF", "<EOF>"), startIndex=2, stopIndex=1))
    tree.update(startIndex=0, stopIndex=1)
    tree["children"][0].update(startIndex=0, stopIndex=1)
    tokens = [("", 0, -1, 5), ("ab", 0, 1, 1), ("", 2, 1, 5), ("<EOF>", 2, 1, -1)]
    listed = [{"index": i, "type": k, "typeName": "EOF" if k == -1 else "T", "text": t, "startIndex": a, "stopIndex": b}
              for i, (t, a, b, k) in enumerate(tokens)]
    d = docs(spark, f={"tokenStream": listed, "parseTree": tree})
    got = {r.node_id: r for r in tr.detailed(tr.flatten(d), tk.read_tokens(d), ["file"]).collect()}
    assert len(got) == 4 and tr.detailed(tr.flatten(d), tk.read_tokens(d), []).count() == 4
    assert got[0].stop_token.text == "<EOF>" and got[1].stop_token.text == "ab"
    assert (got[3].token_type, got[3].token_index, got[2].token_index) == ("EOF", 3, 0)


def test_visitor_also_serves_the_context_name(spark, rows):
    nodes = tr.flatten(docs(spark, f=rule("itemContext", rule("item"))))
    assert rows(tr.visited(nodes, ["item"]).select("node_id")) == [(0,)]


def test_caller_visitor(spark, rows):
    def leaves(tree: pa.Table) -> pa.Table:
        n = sum(c == 0 for c in tree["child_count"].to_pylist())
        return pa.table({"file": tree["file"][:1], "n": [n]})

    nodes = tr.flatten(docs(spark, f=SAMPLE, g=term("X", "x")))
    assert rows(tr.visit_with(nodes, leaves, "file string, n bigint")) == [("f", 5), ("g", 1)]


# --- tokens ------------------------------------------------------------------------------------

def stream(spark, n=12):
    words = [{"index": i, "type": i % 3, "typeName": f"T{i % 3}", "text": f"w{i}", "startIndex": i * 4,
              "stopIndex": i * 4 + 2, "line": i // 5 + 1, "column": i % 5} for i in range(n)]
    return tk.read_tokens(docs(spark, f={"tokenStream": words}, g={"tokenStream": []}, h="{", i={"parseTree": {}}))


def test_token_defaults(spark):
    t = tk.read_tokens(docs(spark, f='{"tokenStream":[{}, {"text": null, "type": 4}]}')).orderBy("pos").collect()
    assert tuple(t[0]) == ("f", 0, 0, -1, "", "", 0, 0, 1, 0, 0)
    assert (t[1].text, t[1].type) == ("", 4)


@pytest.mark.parametrize("start,stop,types,expected", [
    (None, None, None, range(12)), (-5, 3, None, range(4)), (9, 99, None, range(9, 12)), (5, 2, None, []),
    (0, -1, None, []), (2, 8, [1], [4, 7]), (None, 4, [], range(5)),
])
def test_position_ranges(spark, start, stop, types, expected):
    got = sorted(r.pos for r in tk.in_positions(stream(spark), start, stop, types).collect())
    assert got == list(expected)


def test_character_and_point_ranges(spark):
    t = stream(spark)
    assert sorted(r.pos for r in tk.inside(t, 4, 14).collect()) == [1, 2, 3]
    points = sorted(r.pos for r in tk.between_points(t, (1, 3), (3, 0)).collect())
    assert points == list(range(3, 11))
    assert tk.range_text(t, 2, 4).first().text == "w2w3w4"
    assert tk.display(t).filter("pos = 3").first().display == "[@3,12:14='w3',<T0>,1:3]"


def test_many_ranges_against_a_plain_scan(spark):
    t = stream(spark, 60)
    spans = [(0, 300), (10, 12), (11, 40), (100, 90), (33, 34), (-20, 5), (236, 238)]
    ranges = spark.createDataFrame([("f", a, b) for a, b in spans], "file string, range_start int, range_stop int")
    got = sorted((r.range_start, r.range_stop, r.pos) for r in tk.inside_ranges(t, ranges, bits=3).collect())
    want = sorted((a, b, i) for a, b in spans for i in range(60) if i * 4 >= a and i * 4 + 2 <= b)
    assert got == want


def test_empty_token_at_the_end_of_a_range(spark):
    t = tk.read_tokens(docs(spark, f={"tokenStream": [{"text": "<EOF>", "startIndex": 16, "stopIndex": 15}]}))
    ranges = spark.createDataFrame([("f", 0, 15)], "file string, range_start int, range_stop int")
    assert tk.inside_ranges(t, ranges, bits=4).count() == 1


def test_look_ahead(spark):
    got = {r.pos: r for r in tk.look_ahead(stream(spark), [1, 2, 0, 9], bits=4).collect()}
    for i in range(12):
        assert (got[i].la_1, got[i].lt_1) == (i % 3, f"w{i}")
        assert (got[i].la_2, got[i].lt_2) == (((i + 1) % 3, f"w{i + 1}") if i < 11 else (-1, None))
        assert got[i].la_0 == ((i - 1) % 3 if i else -1)
        assert got[i].la_9 == ((i + 8) % 3 if i < 4 else -1)


def test_distribution(spark, rows):
    d = tk.type_distribution(stream(spark))
    assert rows(d) == [("f", f"T{i}", 4) for i in range(3)]
    assert rows(tk.sizes(d)) == [("f", 12)]
    assert tk.of_type(stream(spark), 1).count() == tk.of_type_name(stream(spark), "T1").count() == 4


def test_rejected_token_lists(spark, rows):
    d = docs(spark, a={"tokenStream": [{"index": 0}]}, b="{", c={"parseTree": {}}, d={"tokenStream": 5}, e=[{}])
    assert rows(tk.rejected_token_lists(d)) == [("b", "not readable"), ("d", "token list of another shape")]
