"""The detailed form takes the tokens of a document where the document is: nothing is stored or shuffled for it."""

from __future__ import annotations

import json
import os
import random

import pyarrow as pa
from pyspark.sql import functions as F

from querytrail.functions import documents as docs
from querytrail.operators import tokens as tk
from querytrail.operators import trees as tr
from querytrail.plans import queries, standins

LINES = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string, l_linestatus string"


def tree(random_, depth):
    """Offsets collide, terminals may have children, end-of-file terminals stand anywhere."""
    kind = random_.choice(["RuleContext: script", "RuleContext: x", "Terminal: T", "Terminal: EOF", "odd"])
    node = {"nodeType": kind, "text": f"t{random_.random():.3f}"}
    for name in ("startIndex", "stopIndex"):
        if random_.random() < 0.9:
            node[name] = random_.randint(-2, 6)
    if depth:
        node["children"] = [tree(random_, depth - 1) for _ in range(random_.randint(0, 3))]
    return node


def token(random_):
    if random_.random() < 0.05:
        return None
    full = {"index": random_.randint(0, 5), "type": random_.choice([-1, 1, 2]), "typeName": random_.choice(["EOF", "A", None]),
            "text": random_.choice(["", "w", "<EOF>"]), "startIndex": random_.randint(-2, 6),
            "stopIndex": random_.randint(-2, 6), "line": random_.randint(1, 9), "column": random_.randint(0, 9)}
    return {k: v for k, v in full.items() if random_.random() < 0.9}


def document(random_):
    body = tree(random_, 3)
    kind = random_.randint(0, 6)
    if kind == 0:
        return [body, tree(random_, 2)]
    if kind == 1:
        return {"parseTree": body}
    return {"tokenStream": [token(random_) for _ in range(random_.randint(0, 12))], "parseTree": body}


def both_forms(spark, payloads):
    frame = spark.createDataFrame(payloads, "file string, payload string")
    listed = tk.read_tokens(frame, nested=True)
    placed = tr.detailed(tr.flatten(listed, tr.READ_WITH_TOKENS, with_tokens=True), None, ["script", "x"])
    return placed, tr.detailed(tr.flatten(frame), tk.read_tokens(frame), ["script", "x"])


def test_as_with_a_table_of_tokens(spark, rows):
    random_ = random.Random(7)
    payloads = [(f"f{i}", json.dumps(document(random_))) for i in range(120)]
    payloads += [("bad", '{"tokenStream": [{"index": 1}], "parseTree": 5}'), ("worse", "{"), ("none", None),
                 (None, json.dumps({"tokenStream": [{"startIndex": 0, "type": 1}], "parseTree": {"nodeType": "RuleContext: x", "startIndex": 0}}))]
    placed, joined = both_forms(spark, payloads)
    assert placed.columns == joined.columns
    assert rows(placed) == rows(joined)
    assert placed.filter("start_token is not null").count() > 100
    assert placed.filter("stop_token.type = -1").count() > 5


def test_documents_without_any_tokens(spark, rows):
    placed, joined = both_forms(spark, [("f", json.dumps({"parseTree": {"nodeType": "RuleContext: x", "startIndex": 0}}))])
    assert rows(placed) == rows(joined) and placed.first().start_token is None


def test_tokens_across_batches(spark, rows, monkeypatch):
    """Batches of nodes are cut between documents, also where lists are long and trees are short."""
    monkeypatch.setattr(docs, "CHUNK", 3)
    random_ = random.Random(3)
    frame = spark.createDataFrame([(f"f{i}", json.dumps(document(random_))) for i in range(20)], "file string, payload string")
    given = tk.read_tokens(frame, nested=True).toArrow().to_batches(max_chunksize=4)
    names = [*tr.READ_WITH_TOKENS]
    small = [r for b in docs.some_columns(names, True)(iter(given)) for r in b.to_pylist()]
    monkeypatch.setattr(docs, "CHUNK", 50_000)
    whole = [r for b in docs.some_columns(names, True)(iter(given)) for r in b.to_pylist()]
    assert small == whole and any(r["start_token"] for r in small)


def test_the_query_stores_nothing_and_shuffles_the_lines_only(spark, tmp_path):
    lines = [(k, p, s, n, "A", "O") for n, (k, p, s) in enumerate([(2, 5, 7), (2, 6, 8), (6, 1, 1), (None, 1, 1)])]
    spark.createDataFrame(lines, LINES).write.parquet(f"{tmp_path}/lineitem.parquet")
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    full = queries()["tr11_detailed_flat_form"](spark, str(tmp_path))
    plan = full._jdf.queryExecution().executedPlan().toString()
    assert set(os.listdir(shared)) == before
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1
    found = {(r.file, r.node_id): (r.start_index, r.start_text, r.stop_text) for r in full.filter("file is not null").collect()}
    # s2: script, line, PART, SUPP, line, ...
    assert found["s2.txt", 2] == (0, "5", None) and found["s2.txt", 3] == (1, "7", None)
    assert found["s2.txt", 4] == (2, "6", None) and found["s6.txt", 2] == (0, "1", None)


def test_texts_of_a_script_are_neither_sorted_nor_aggregated(spark, tmp_path):
    lines = [(k, 10 - n, n, n, None if n == 2 else "A", "F") for k in (1, 2, 3, None) for n in range(1, 5)]
    spark.createDataFrame(lines, LINES).write.parquet(f"{tmp_path}/lineitem.parquet")
    found = standins.Tables(spark, str(tmp_path)).tree_documents()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and plan.count("Sort [") == 1 and plan.count("Exchange hashpartitioning") == 1
    texts = tr.flatten(found).filter("token_name = 'PART'").groupBy("file").agg(
        F.sort_array(F.collect_list(F.struct("tree_no", "node_id", "text"))).alias("t")).select("file", "t.text")
    assert {r.file: r.text for r in texts.collect()} == {f: ["9", "8", "7", "6"] for f in ("s1.txt", "s2.txt", "s3.txt", None)}


def test_lines_are_joined_as_they_pass():
    """A script's lines may cross batches; missing texts are left out; each row is read once."""
    lines = [(None, 1, "n", "a"), (None, 2, "n", None), (3, 2, "x", "c"), (3, 1, "x", "b"), (3, 3, "x", "d"), (5, 1, "y", None)]
    table = pa.table(dict(zip(("key", "n", "file", "text"), map(list, zip(*lines, strict=True)), strict=True)))
    join = docs.joined_texts("key", "n", ["file"], ["text"])
    for size in (1, 2, 3, 6):
        batches = [pa.RecordBatch.from_pylist([], schema=table.schema), *table.to_batches(max_chunksize=size)]
        assert [tuple(r.values()) for b in join(iter(batches)) for r in b.to_pylist()] == [
            ("n", "a", 2, 2), ("x", "b,c,d", 3, 3), ("y", "", 1, 1)]


def test_one_script_with_many_lines(spark, tmp_path):
    """Its lines are written once, not once for each line: 40 000 lines of 300 characters."""
    spark.range(40_000).selectExpr(
        "4L l_orderkey", "id l_partkey", "1L l_suppkey", "cast(id % 7 as int) l_linenumber", "'A' l_returnflag",
        "'F' l_linestatus").write.parquet(f"{tmp_path}/lineitem.parquet")
    found = standins.Tables(spark, str(tmp_path)).tree_documents().collect()
    assert len(found) == 1 and len(json.loads(found[0].payload)["children"]) == 40_000
