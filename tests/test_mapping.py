from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from querytrail.operators import databases as db
from querytrail.operators import mapping as mp
from querytrail.operators import merge, pairs

SIX = "target_db string, target_table string, target_column string, source_db string, source_table string, source_column string"


def mapping(spark, data):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "pos int, " + SIX)


def test_keys_ignore_case_blanks_and_treat_null_as_text(spark, rows):
    a = mapping(spark, [("D", "T ", "c", None, "s", "x"), ("d", "t", "C", "nan", "S", " x"), ("d", "u", "c", "e", "s", "x")])
    b = mapping(spark, [(" d", "t", "c", "NaN", "s", "x"), ("d", "v", None, "e", "s", "x")])
    got = rows(mp.compare_mappings(a, b, ["pos"]))
    assert got == [
        ("12", "d", "u", "c", "e", "s", "x", "Present in File 1 but not in File 2"),
        ("21", "d", "v", None, "e", "s", "x", "Present in File 2 but not in File 1")]
    first = rows(mp.unique_mapping(a, ["pos"]).select("target_db", "target_table", "source_db"))
    assert first == [("D", "T ", None), ("d", "u", "e")]


def test_other_headers_and_missing_column(spark):
    a = mapping(spark, [("d", "t", "c", "e", "s", "x")])
    other = a.withColumnsRenamed({"target_db": " Target Database", "source_table": "SourceTable"})
    assert mp.compare_mappings(a, other, ["pos"]).isEmpty()
    with pytest.raises(ValueError, match="source_db"):
        mp.compare_mappings(a.drop("source_db"), a, ["pos"])
    with pytest.raises(ValueError, match="order"):
        mp.compare_mappings(a, a, [])


def test_report_order_and_sample(spark):
    a = mapping(spark, [(None, "t", "c", "e", "s", str(i)) for i in range(7)] + [("b", "t", "c", "e", "s", str(i)) for i in range(7)])
    diff = mp.compare_mappings(a, a.limit(0), ["pos"])
    assert [r.target_db for r in mp.ordered_report(diff).collect()] == ["b"] * 7 + [None] * 7
    sample = mp.sample_report(diff, mp.REPORT_ORDER, 10).collect()
    assert len(sample) == 10 and {r.more_rows for r in sample} == {4}
    assert {r.more_rows for r in mp.sample_report(diff, mp.REPORT_ORDER, 20).collect()} == {0}


# --- databases: plain-Python model -----------------------------------------------------------

def model(lineage, saved, catalog):
    """The wanted result, written as loops over a handful of rows."""
    unique = list(dict.fromkeys(lineage))
    src, tgt = {}, {}
    for table, base in dict.fromkeys((r[0], r[1]) for r in unique if r[0] and r[1]):
        src[table] = base
    for table, base in dict.fromkeys((r[2], r[3]) for r in unique if r[2] and r[3]):
        tgt[table] = base
    for table, base in saved:
        if table and base:
            src.setdefault(table, base)
            tgt.setdefault(table, base)
    need_s = {r[0] for r in unique if r[0] and r[0] not in src}
    need_t = {r[2] for r in unique if r[2] and r[2] not in tgt}
    found = {}
    for table in need_s | need_t:
        hits = [(at, base) for name, base, at in catalog if name == table and at is not None]
        found[table] = max(hits)[1] if hits else "Unknown"
        if table in need_s:
            src[table] = found[table]
        if table in need_t:
            tgt[table] = found[table]
    filled = sorted(
        ((s, src.get(s, sd) if s else sd, t, tgt.get(t, td) if t else td) for s, sd, t, td in unique), key=repr)
    return filled, found


@pytest.mark.parametrize("seed", range(4))
def test_resolution_agrees_with_the_model(spark, seed):
    random.seed(seed)
    pick = lambda *v: random.choice(v)
    lineage = [(pick("s1", "s2", "s3", "x", None), pick("A", "B", None, None), pick("t1", "t2", "x", None), pick("A", "C", None))
               for _ in range(40)]
    saved = [(pick("s1", "s3", "t2", "x"), pick("M1", "M2", None)) for _ in range(3)]
    catalog = [(pick("s1", "s2", "t1", "x"), pick("K1", "K2"), pick(1, 2, 3, None)) for _ in range(8)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(lineage)],
                               "pos int, source_table string, source_db string, target_table string, target_db string")
    maps = spark.createDataFrame([(i, *r) for i, r in enumerate(saved)], "map_pos int, table_name string, database_name string")
    cat = spark.createDataFrame(catalog, "tablename string, DatabaseName string, LastAccessTimeStamp int")
    out, found = db.resolve_databases(df, maps, cat, "pos", "map_pos")
    filled, expected = model(lineage, saved, catalog)
    got = sorted(((r.source_table, r.source_db, r.target_table, r.target_db) for r in out.collect()), key=repr)
    assert got == filled
    assert {r.table_name: r.database_name for r in found.collect()} == expected


def test_last_new_pair_wins_not_the_last_row(spark):
    df = spark.createDataFrame([(1, "t", "A"), (2, "t", "B"), (3, "t", "A")], "pos int, source_table string, source_db string")
    df = df.withColumn("target_table", F.lit(None).cast("string"))
    got = db.lineage_databases(df, "pos").collect()
    assert [(r.side, r.lineage_db) for r in got] == [("source", "B")]


def test_missing_db_columns_are_created(spark):
    df = spark.createDataFrame([(1, "t", "u")], "pos int, source_table string, target_table string")
    none = spark.createDataFrame([], "map_pos int, table_name string, database_name string")
    cat = spark.createDataFrame([("t", "K", 1)], "tablename string, DatabaseName string, LastAccessTimeStamp int")
    out, _ = db.resolve_databases(df, none, cat, "pos", "map_pos")
    assert out.select("source_db", "target_db").first() == ("K", "Unknown")


def test_global_map(spark, rows):
    current = spark.createDataFrame([("d", "a"), ("d", "a"), ("d", "b")], "db string, `table` string")
    assert rows(db.new_pairs(current, spark.createDataFrame([("d", "b")], "db string, `table` string"))) == [("d", "a")]
    merged = spark.createDataFrame([("a", None), ("b", "c")], "source_db string, target_db string")
    mapped = spark.createDataFrame([("b",)], "db string")
    assert rows(db.unmapped_databases(merged, mapped)) == [("a",), ("c",)]
    assert rows(db.unmapped_databases(merged.drop("target_db"), mapped)) == [("a",)]


# --- pairs and unions --------------------------------------------------------------------------

def test_null_pairs(spark, rows):
    df = spark.createDataFrame([(1, None, "t"), (2, "nan", "t"), (3, "d", "t"), (4, "d", "t")], "n int, db string, `table` string")
    wanted = pairs.pair_frame(spark, [("nan", "t"), ("d", "t"), ("d", "t")])
    assert [r[0] for r in rows(pairs.semi_join_pairs(df, wanted))] == [1, 2, 3, 4]
    assert [r[0] for r in rows(pairs.filter_pairs(df, [("nan", "t")]))] == [2]
    assert [r[0] for r in rows(pairs.filter_pair(df, "nan", "t"))] == [1, 2]
    assert rows(pairs.filter_pairs(df, [])) == []
    many = [("d", "t")] + [(f"x'{i}", "y") for i in range(200)]
    assert [r[0] for r in rows(pairs.filter_pairs(df, many))] == [3, 4]
    with pytest.raises(ValueError):
        pairs.semi_join_pairs(df.drop("db"), wanted)


def test_match_metrics(spark):
    df = spark.createDataFrame([("d", "t")] * 2 + [(None, "t")], "db string, `table` string")
    wanted = pairs.pair_frame(spark, [("d", "t")])
    assert pairs.match_metrics(df, wanted).first() == (3, 2, 66.67)
    assert pairs.match_metrics(df.limit(0), wanted).first() == (0, 0, None)


def test_unions(spark, rows):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    with pytest.raises(ValueError):
        merge.concat_checked(a, a.select("y", "x"))
    assert rows(merge.concat_checked(a, a)) == [(1, 2)] * 2
    assert rows(merge.concat_positional(a, a.select("y", "x"))) == [(1, 2), (2, 1)]
    assert rows(merge.combine_extracts([a, a.select("y")])) == [(1, 2), (None, 2)]
