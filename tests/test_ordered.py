"""Order-dependent helpers against plain Python, with tiny buckets."""

from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from querytrail.functions.ordered import look_around, number_rows, odd_of_runs


def test_number_rows_crosses_buckets_and_keeps_null_groups(spark):
    random.seed(3)
    data = [(random.choice(["a", "b", None]), p) for p in random.sample(range(-500, 5000), 400)]
    out = number_rows(spark.createDataFrame(data, "g string, p long"), ["g"], "p", "n")
    expected = {}
    for g in {x for x, _ in data}:
        for n, p in enumerate(sorted(p for x, p in data if x == g), 1):
            expected[(g, p)] = n
    assert {(r.g, r.p): r.n for r in out.collect()} == expected


def test_number_rows_with_one_hot_group(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("g"),
        F.col("id").alias("p"))
    out = number_rows(df, ["g"], "p", "n").filter("g = 'hot'").orderBy("p").collect()
    assert [r.n for r in out] == list(range(1, 1668))


def test_number_rows_with_sparse_positions_in_one_group(spark):
    df = spark.range(4000).select(F.lit("g").alias("g"), (F.col("id") * (1 << 45) - (1 << 50)).alias("p")).repartition(8)
    out = number_rows(df, ["g"], "p", "n").orderBy("p").collect()
    assert [r.n for r in out] == list(range(1, 4001))


def test_look_around_beyond_a_bucket(spark):
    df = spark.range(300).select(F.lit("f").alias("f"), F.col("id").alias("pos"))
    out = look_around(df, ["f"], "pos", {100: [("far", F.col("pos"))]}, bits=3)
    assert {r.pos: r.far for r in out.collect()} == {i: i + 100 if i < 200 else None for i in range(300)}


def test_look_around(spark):
    data = [(f, i, f"{f}{i}") for f in "xy" for i in range(37 if f == "x" else 3)]
    df = spark.createDataFrame(data, "f string, pos int, v string")
    out = look_around(df, ["f"], "pos", {
        3: [("ahead", F.col("v"))], -2: [("behind", F.col("v"))], 0: [("same", F.col("v"))]}, bits=2)
    have = {(f, i): v for f, i, v in data}
    for r in out.collect():
        assert r.ahead == have.get((r.f, r.pos + 3))
        assert r.behind == have.get((r.f, r.pos - 2))
        assert r.same == r.v
    assert out.count() == len(data)


@settings(max_examples=8, deadline=None)
@given(st.sets(st.integers(0, 60), min_size=1), st.sets(st.integers(0, 60)))
def test_odd_of_runs(spark, a, b):
    data = [("a", p) for p in a] + [("b", p) for p in b]
    out = odd_of_runs(spark.createDataFrame(data, "f string, p long"), ["f"], "p", bits=2)
    expected = set()
    for f, positions in (("a", a), ("b", b)):
        used = None
        for p in sorted(positions):
            if used != p:
                expected.add((f, p))
                used = p + 1
    assert {(r.f, r.p) for r in out.collect()} == expected
