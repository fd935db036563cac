from __future__ import annotations

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from querytrail.operators import scripts as sc
from querytrail.operators import usage
from querytrail.sources import sinks


def script(spark, **texts):
    return spark.createDataFrame([(k + ".txt", v) for k, v in texts.items()], "file string, script string")


def test_numbers_count_blank_parts(spark, rows):
    df = script(spark, a="\x01 ;SELECT 1;\t\n;INSERT;;", b=" ; ")
    assert rows(sc.split_statements(df)) == [("a.txt", 2, "SELECT 1"), ("a.txt", 4, "INSERT")]


@pytest.mark.parametrize("text,ok", [
    ("select 1", False), ("SELECT", True), ("xINSERTx", True), ("create", False), ("CREATE", True), ("\n", False),
])
def test_validity(spark, text, ok):
    df = spark.createDataFrame([("f", 1, text)], "file string, stmt_no int, stmt string")
    row = sc.check_statements(df).first()
    assert row.ok is ok
    assert (row.message, row.error) == ((None, None) if ok else ("Line 1:0 - Invalid SQL syntax", "Line 1:0"))


def test_stats_per_script(spark):
    df = script(spark, a="SELECT 1;x;UPDATE", b=" ; ;", c="x;y\r\n;SELECT;x;x;x;x;x")
    got = {r.file_name: tuple(r)[1:] for r in sc.script_stats(df).collect()}
    assert got == {"a.txt": (3, 1, 0, 33.33), "b.txt": (0, 0, 0, 0.0), "c.txt": (8, 7, 0, 87.5)}
    grouped = sc.statement_stats(sc.check_statements(sc.split_statements(df, clean=True)))
    assert {r.file_name: tuple(r)[1:] for r in grouped.collect()} == {k: v for k, v in got.items() if k != "b.txt"}


def test_caller_check_as_udf_and_uncheckable_statements(spark):
    @F.pandas_udf("boolean")
    def check(s: pd.Series) -> pd.Series:
        return s.map({"good": True, "bad": False}).astype("boolean")

    df = sc.check_statements(sc.split_statements(script(spark, a="good;bad;odd")), check)
    assert sc.statement_stats(df).first() == ("a.txt", 3, 1, 1, 33.33)


def test_good_text_and_labels(spark, rows):
    df = sc.check_statements(sc.split_statements(script(spark, a="SELECT 2; ;x" + "y" * 120 + ";INSERT", b="no")))
    assert rows(sc.good_text(df)) == [("a.txt", "SELECT 2; INSERT"), ("b.txt", None)]
    assert rows(sc.failed_statements(df).select("label")) == [
        ("a.txt_query_3: x" + "y" * 99 + "...",), ("b.txt_query_1: no...",)]


def test_status(spark):
    files = spark.createDataFrame(
        [("a.txt", 1, True, None, None), ("b.txt", 1, False, True, None), ("c.txt", 1, False, False, None),
         ("d.txt", 1, False, None, None), ("e.txt", 1, False, None, "x")],
        "file string, duration long, file_ok boolean, reparse_ok boolean, error string")
    checked = spark.createDataFrame([(f + ".txt", f != "d") for f in "bcde"], "file string, ok boolean")
    got = {r.FileName[0]: (r.JsonFile, r.Status) for r in sc.script_status(files, checked).collect()}
    assert got == {
        "a": ("a.json", "SUCCESS"), "b": ("b.json", "PARTIAL"), "c": ("FAILED", "REPARSE_FAILURE"),
        "d": ("FAILED", "NO_SUCCESSFUL_QUERIES"), "e": ("FAILED", "EXCEPTION")}
    old = {r.FileName[0]: (r.JsonFile, r.Status) for r in sc.script_status(files, checked, reparse=False).collect()}
    assert old["b"] == ("b_partial.json", "PARTIAL") and old["d"] == ("FAILED", "COMPLETE_FAILURE")


def test_invalid_dump_text(spark, tmp_path):
    df = sc.check_statements(sc.split_statements(script(spark, a="bad one;SELECT 1;bad two", b="SELECT 1")))
    sinks.write_invalid_statements(df, str(tmp_path / "dump"), per_file=True)
    parts = sorted((tmp_path / "dump").glob("file_name=*/*.txt"))
    assert {p.parent.name for p in parts} == {"file_name=a_errors"}
    text = "".join(p.read_text() for p in parts)
    entry = "--- INVALID QUERY ---\n{}\n\n\n" + "+ - " * 50 + "\n\n"
    assert text == entry.format("bad one") + entry.format("bad two")


def test_failure_report_file(spark, tmp_path):
    files = spark.createDataFrame([("b",), ("a",)], "x string")
    sinks.write_failure_report(files, files.limit(0), str(tmp_path / "r"))
    lines = [x for p in sorted((tmp_path / "r").glob("part*")) for x in p.read_text().splitlines()]
    assert lines == ["FILES THAT TIMED OUT (2):", "- a", "- b", "QUERIES THAT TIMED OUT (0):"]


# --- usage -------------------------------------------------------------------------------------

COLUMNS = "ObjectTableName string, logdate string, ProcID long, QueryID long, SessionID long, SQLTEXTINFO string"


def brute(data):
    out = {}
    for table in {r[0] for r in data if r[0] is not None}:
        mine = [r for r in data if r[0] == table]
        last = [r for r in mine if r[1] == max(x[1] for x in mine)]
        low = lambda r: (r[5] or "").lower()
        creates = [r for r in last if "create " in low(r)]
        mods = [r for r in last if "drop" in low(r) or "rename" in low(r)]
        later = any((c[2] == m[2] and m[3] > c[3]) or m[4] > c[4] for c in creates for m in mods)
        if all(not (r[5] or "").strip() for r in mine):
            out[table] = "Active Table"
        elif mods and not creates:
            out[table] = "Isolated Drop/Rename"
        else:
            out[table] = "Temporary" if mods and creates and later else "Active Table"
    return out


@pytest.mark.parametrize("seed", range(4))
def test_classes_against_pairs(spark, seed):
    random.seed(seed)
    texts = ["CREATE table", "drop x", "create t; rename", "select", " ", None, "Create\ttable"]
    data = [(random.choice([f"t{i}" for i in range(40)] + [None]), random.choice(["2024-01-01", "2024-01-02"]),
             random.randint(0, 2), random.randint(0, 5), random.randint(0, 2), random.choice(texts)) for _ in range(200)]
    got = usage.classify_tables(spark.createDataFrame(data, COLUMNS)).collect()
    want = brute(data)
    assert len(got) == len(data)
    assert all(r.Table_Classification == want.get(r.ObjectTableName, "Active Table") for r in got)
    assert {r[0] for r in usage.temporary_tables(spark.createDataFrame(data, COLUMNS)).collect()} >= {
        t for t, c in want.items() if c == "Temporary"}
