"""Comparing mappings by hashes and positions, rows fetched afterwards."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from querytrail.operators import mapping as mp

SIX = "target_db string, target_table string, target_column string, source_db string, source_table string, source_column string"


def some_rows(seed, n):
    rng = random.Random(seed)
    return [tuple(rng.choice([None, "nan", "A", "a ", f"x{rng.randrange(4)}"]) for _ in range(6)) for _ in range(n)]


def frame(spark, rows, name="pos"):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"{name} long, {SIX}")


def key(row):
    return "|".join((c if c is not None else "nan").strip().lower() for c in row)


def firsts(rows):
    found = {}
    for row in rows:
        found.setdefault(key(row), row)
    return found


def expected(a, b):
    one, two = firsts(a), firsts(b)
    return sorted([("12", *r) for k, r in one.items() if k not in two] + [("21", *r) for k, r in two.items() if k not in one], key=repr)


def got(report):
    return sorted((tuple(r)[:-1] for r in report.collect()), key=repr)


@pytest.mark.parametrize("classes", [None, 1, 5, 60])
def test_keys_that_share_a_hash(spark, monkeypatch, classes):
    if classes:
        monkeypatch.setattr(mp, "_key_hash", lambda: F.pmod(F.xxhash64("comparison_key"), F.lit(classes)))
    a, b = some_rows(1, 300), some_rows(2, 200) + some_rows(1, 100)
    assert got(mp.compare_mappings(frame(spark, a), frame(spark, b), ["pos"])) == expected(a, b) != []
    unique = mp.unique_mapping(frame(spark, a), ["pos"]).collect()
    assert sorted((tuple(r)[:6] for r in unique), key=repr) == sorted(firsts(a).values(), key=repr)


def test_other_orders_give_the_same_rows(spark):
    a, b = some_rows(3, 300), some_rows(4, 300)
    place = F.struct(F.lit("f").alias("path"), F.col("pos").alias("at"))
    one, two = (frame(spark, r).withColumn("place", place) for r in (a, b))
    assert got(mp.compare_mappings(one, two, ["place"])) == expected(a, b)


def test_rows_that_share_a_position(spark):
    a = frame(spark, [("A", "t", "c", "e", "s", "x")] * 3 + [("b", "t", "c", "e", "s", "x")]).withColumn("pos", F.lit(7))
    more = a.union(a.withColumn("target_db", F.lower("target_db")))
    unique = mp.unique_mapping(more, ["pos"]).collect()
    assert len(unique) == 2 and {r.comparison_key for r in unique} == {"a|t|c|e|s|x", "b|t|c|e|s|x"}
    assert mp.compare_mappings(more, more.limit(0), ["pos"]).count() == 2


def test_no_sort_aggregate_in_the_plan(spark):
    plans = []
    store = mp.store

    def seen(df, purpose):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df, purpose)

    a, b = frame(spark, some_rows(5, 200)), frame(spark, some_rows(6, 200))
    mp.store = seen
    try:
        report, unique = mp.compare_mappings(a, b, ["pos"]), mp.unique_mapping(a, ["pos"])
    finally:
        mp.store = store
    plans += [df._jdf.queryExecution().executedPlan().toString() for df in (report, unique)]
    assert len(plans) == 4 and not any("SortAggregate" in p for p in plans)
    assert all("HashAggregate" in p for p in plans[:2])
