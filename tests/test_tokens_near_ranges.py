"""Tokens that no range can hold are neither stored nor shuffled, and none that one holds is lost."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from querytrail.operators import tokens as tk
from querytrail.plans import queries

RANGES = "file string, range_start long, range_stop long"


def token_table(spark, rows):
    return spark.createDataFrame(rows, "file string, pos int, start_index int, stop_index int")


@pytest.fixture
def many(spark):
    """Tokens, some empty, negative or without a file; ranges of every kind, of one file only half as many."""
    random_ = random.Random(5)
    starts = [(f, random_.randint(-50, 20_000)) for f in ("a", "b", "c", None) for _ in range(400)]
    listed = [(f, i, s, s + random_.randint(-1, 6)) for i, (f, s) in enumerate(starts)]
    spans = [(random_.choice(["a", "b", None]), s, s + random_.randint(-3, 60))
             for s in (random_.randint(-60, 20_000) for _ in range(500))]
    spans += [("a", 5_000, 9_000), ("a", 5_000, 9_000), ("b", None, 5), ("b", 5, None), ("z", 0, 20_000)]
    return listed, spans


def brute(listed, spans):
    return sorted((f, p, a, b) for f, p, s, e in listed for g, a, b in spans
                  if None not in (f, a, b) and f == g and s >= a and e <= b)


@pytest.mark.parametrize("broadcast_blocks", [0, 1_000_000])
def test_against_a_plain_scan(spark, many, monkeypatch, broadcast_blocks):
    monkeypatch.setattr(tk, "BROADCAST_BLOCKS", broadcast_blocks)
    listed, spans = many
    tokens, ranges = token_table(spark, listed), spark.createDataFrame(spans, RANGES)
    found = tk.inside_ranges(tokens, ranges, bits=3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert ("SortMergeJoin" in plan) == (broadcast_blocks == 0)
    want = brute(listed, spans)
    assert sorted((r.file, r.pos, r.range_start, r.range_stop) for r in found.collect()) == want and len(want) > 200
    marked = tk.inside_ranges(tk.mark_near(tokens, ranges, 3), ranges, 3)
    assert sorted((r.file, r.pos, r.range_start, r.range_stop) for r in marked.collect()) == want


def test_far_tokens_are_not_marked(spark, many):
    """The filter has several parts here, and few tokens pass by chance."""
    listed, _ = many
    assert 16 * 3_200 > 1 << tk.PART_BITS
    ranges = spark.createDataFrame([("a", 8 * i, 8 * i) for i in range(800)] + [("b", 0, 12_800)], RANGES)
    marked = tk.mark_near(token_table(spark, listed), ranges, 3).collect()
    near = {r.pos for r in marked if r[tk.NEAR]}
    reach = {p for f, p, s, _ in listed if (f == "a" and 0 <= s >> 3 <= 800) or (f == "b" and 0 <= s >> 3 <= 1_601)}
    assert len(marked) == len(listed) and reach <= near
    assert len(near - reach) < 0.05 * len(listed)
    assert not any(r[tk.NEAR] for r in marked if r.file is None)


def test_without_ranges(spark, many):
    listed, _ = many
    none = spark.createDataFrame([("a", 9, 1), ("a", None, 5)], RANGES)
    tokens = token_table(spark, listed)
    assert tk.mark_near(tokens, none).filter(tk.NEAR).isEmpty() and tk.inside_ranges(tokens, none).isEmpty()


def test_the_query_stores_what_a_range_can_hold_only(spark, tmp_path):
    texts = [(i, " ".join(f"w{j}" for j in range(400)), 300 + i) for i in range(30)]
    spark.createDataFrame(texts, "doc_id long, text string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    found = queries()["tk5_tokens_in_character_range"](spark, str(tmp_path))
    made = set(os.listdir(shared)) - before
    stored = [spark.read.parquet(f"{shared}/{name}") for name in made if name.startswith("querytrail-tokens-")]
    assert len(stored) == 1 and stored[0].count() < 30 * 60
    # words begin at 0, 100, ...: of the fixed range those from 300 to 2 100
    got = {r.doc: r.n for r in found.groupBy(F.col("file").alias("doc")).agg(F.count("*").alias("n")).collect()}
    want = {f"d{i}": sum(250 <= 100 * j and 100 * j + len(f"w{j}") - 1 <= 2200 for j in range(400))
            + sum(300 + i <= 100 * j and 100 * j + len(f"w{j}") - 1 <= 600 + 2 * i for j in range(400)) for i in range(30)}
    assert got == want
