from __future__ import annotations

import random
import re

import pytest

from querytrail.operators import logmine

SPOOL = "2024 WARNING  ⚠ Spool error for {db} tables {tables}... [x]: skip"
SKIP = "2024 WARNING  ⚠ Skipping date range 2024-01-01 {arrow} 2024-01-30 for {db} Batch {n} due to error"


def frame(spark, lines, file="f"):
    return spark.createDataFrame([(file, i + 1, x) for i, x in enumerate(lines)], "file string, line_no long, line string")


@pytest.mark.parametrize("arrow", ["->", "→"])
def test_both_arrows(spark, rows, arrow):
    lines = [SPOOL.format(db="d_ü", tables="['a', 'b']"), "\t" + SKIP.format(db="d_ü", arrow=arrow, n=12)]
    assert rows(logmine.skipped_tables(frame(spark, lines))) == [
        ("d_ü", t, "2024-01-01", "2024-01-30", "12") for t in "ab"]


def test_problems_are_counted(spark, rows):
    lines = [
        SPOOL.format(db="d", tables="[a]"), SKIP.format(db="d", arrow="->", n=1),
        SPOOL.format(db="d", tables="['a']"), SKIP.format(db="e", arrow="->", n=1),
        SPOOL.format(db="d", tables="[]"), SKIP.format(db="d", arrow="->", n=1),
        SPOOL.format(db="d", tables="['a']"), "other", SKIP.format(db="d", arrow="->", n=1),
    ]
    assert rows(logmine.skipped_tables(frame(spark, lines))) == []
    assert rows(logmine.mining_summary(frame(spark, lines))) == [("f", 1, 0, 2)]


def brute(lines):
    """Left to right over the lines of one file."""
    entries, done, problems, i = [], 0, 0, 0
    while i < len(lines) - 1:
        a = re.search(r"Spool error for (\w+) tables (\[.*?\])", lines[i])
        b = re.search(r"Skipping date range (\S+) -> (\S+) for (\w+) Batch (\d+)", lines[i + 1])
        step = 1
        if a and b:
            if a[1] == b[3] and "'" in a[2]:
                entries += [(a[1], t, b[1], b[2], b[4]) for t in re.findall("'(.)'", a[2])]
                done, step = done + 1, 2
            else:
                problems += 1
        i += step
    return entries, done, problems


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force_with_double_lines(spark, rows, seed):
    random.seed(seed)
    lines = []
    for _ in range(150):
        spool = SPOOL.format(db=random.choice("de"), tables=random.choice(["['a']", "['a', 'b']", "[a]"]))
        skip = SKIP.format(db=random.choice("de"), arrow="->", n=random.randint(1, 3))
        lines.append(random.choice([spool, skip, skip + " " + spool, skip + " " + spool, "noise"]))
    entries, done, problems = brute(lines)
    df = frame(spark, lines)
    assert rows(logmine.skipped_tables(df, bits=2)) == sorted(entries, key=repr)
    assert rows(logmine.mining_summary(df, bits=2)) == [("f", done, len(entries), problems)]


def test_windows_to_repeat_name_all_tables_of_the_batch(spark, rows):
    skipped = spark.createDataFrame(
        [("d", "t1", "s", "e", "1"), ("d", "t2", "s", "e", "1"), ("d", "zz", "s2", "e2", "1")],
        "Database string, `Table` string, Start_Date string, End_Date string, Batch string")
    batches = spark.createDataFrame(
        [("d", 1, ["t1", "t2", "t3", "t4"]), ("d", 2, ["t9"])], "db string, batch_number int, tables array<string>")
    assert rows(logmine.windows_to_repeat(skipped, batches)) == [("d", f"t{i}", 1, "s", "e") for i in range(1, 5)]
