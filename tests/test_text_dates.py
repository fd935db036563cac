from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from querytrail.functions import dates
from querytrail.functions import text as tx


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column.alias("x")).first().x


def test_trims(spark):
    assert one(spark, tx.trim_control(F.col("a")), a="\t\x01 \x1fa b\x00\r\n") == "a b"
    assert one(spark, tx.trim_control(F.col("a")), a="\xa0a　") == "\xa0a　"
    assert one(spark, tx.trim_blank(F.col("a")), a="　\xa0\x1c a\x01   ") == "a\x01"
    assert "".join(tx.UNICODE_BLANK).strip() == ""
    for c in range(0x3100):
        assert (chr(c).strip() == "") == (chr(c) in tx.UNICODE_BLANK), hex(c)


def test_line_ends(spark):
    assert one(spark, tx.clean_line_ends(F.col("a")), a="\r\na\r\nb\rc\n\n") == "a\nb\nc"


@pytest.mark.parametrize("x,expected", [(1.005, 1.0), (12.5, 12.5), (0.125, 0.13), (66.66666666666667, 66.67)])
def test_half_up(spark, x, expected):
    assert one(spark, tx.half_up_2(F.col("a")), a=x) == expected


def test_percentage(spark):
    assert one(spark, tx.percentage(F.col("a"), F.col("b")), a=1, b=8) == 12.5
    assert one(spark, tx.percentage(F.col("a"), F.col("b")), a=0, b=0) == 0.0


@pytest.mark.parametrize("text,expected", [
    ("['a', 'b']", ["a", "b"]), ("[]", []), ("['it\\'s', \"x'y\"]", ["it's", "x'y"]), ("[1, 2]", ["1", "2"]),
    ("[a]", None), ("['a'", None),
])
def test_quoted_list(spark, text, expected):
    assert one(spark, tx.quoted_list(F.col("a")), a=text) == expected


@pytest.mark.parametrize("node_type,labels", [
    ("RuleContext: select", ("rule", "select", "unknown", "selectContext")),
    ("Terminal: 'FROM'", ("terminal", "unknown", "'FROM'", "TerminalNodeImpl")),
    ("CombinedQueries", ("other", "unknown", "unknown", "UnknownContext")),
    ("Unknown: X", ("other", "unknown", "unknown", "UnknownContext")),
])
def test_node_labels(spark, node_type, labels):
    a = F.col("a")
    got = one(spark, F.array(tx.node_kind(a), tx.rule_name(a), tx.token_name(a), tx.class_name(a)), a=node_type)
    assert tuple(got) == labels


def test_literal_names(spark):
    assert one(spark, tx.literal_name(F.col("a")), a="'SELECT'") == "SELECT"
    assert one(spark, tx.literal_name(F.col("a")), a="ID") == "ID"
    assert one(spark, tx.literal_name(F.col("a")), a="'a\n'") == "a\n"


def windows(start, end, days=30):
    out, at = [], start
    while at < end:
        last = min(at + dt.timedelta(days - 1), end)
        out.append((at, last))
        at = last + dt.timedelta(1)
    return out


@pytest.mark.parametrize("span,count", [(180, 6), (185, 7), (0, 0), (1, 1), (29, 1), (30, 1), (31, 2), (-4, 0)])
def test_windows(spark, span, count):
    start = dt.date(2024, 1, 5)
    end = start + dt.timedelta(span)
    df = spark.createDataFrame([(start, end)], "s date, e date")
    got = [(r.window_start, r.window_end) for r in
           dates.windows_between(df, "s", "e").orderBy("window_no").collect()]
    assert got == windows(start, end) and len(got) == count


@pytest.mark.parametrize("span", [180, 185, 31, 30, 1, 0])
def test_window_of_a_day_agrees_with_the_list(spark, span):
    start = dt.date(2024, 1, 5)
    end = start + dt.timedelta(span)
    days = spark.createDataFrame([(start + dt.timedelta(i),) for i in range(-2, span + 3)], "d date")
    w = dates.window_of(F.col("d"), F.lit(start), F.lit(end))
    expected = windows(start, end)
    for r in days.select("d", w.alias("w")).collect():
        hit = [x for x in expected if x[0] <= r.d <= x[1]]
        assert (hit[0] if hit else None) == ((r.w.window_start, r.w.window_end) if r.w else None)
