"""Validators of the caller: several messages a statement, and some that raise."""

from __future__ import annotations

from querytrail import jobs
from querytrail.operators import scripts as sc


def validator():
    """A function of its own, as workers can't import the tests."""
    def validate(statement):
        if "boom" in statement:
            raise KeyError("no such rule")
        if "two" in statement:
            yield "Line 1:0 - first - more"
            yield "Line 2:5 - second"
        elif "plain" in statement:
            yield "no dash"

    return validate


def test_messages_and_corrupted_statements(spark, rows):
    scripts = spark.createDataFrame(
        [("a.txt", "fine;two;boom;plain;two"), ("b.txt", "boom"), ("c.txt", " ;")], "file string, script string")
    found = sc.validate_statements(sc.split_statements(scripts), validator())
    assert rows(found.select("file", "stmt_no", "ok", "messages", "problem", "message", "error")) == sorted([
        ("a.txt", 1, True, [], None, None, None),
        ("a.txt", 2, False, ["Line 1:0 - first - more", "Line 2:5 - second"], None, "Line 1:0 - first - more", "Line 1:0"),
        ("a.txt", 3, None, [], "KeyError: 'no such rule'", None, None),
        ("a.txt", 4, False, ["no dash"], None, "no dash", "no dash"),
        ("a.txt", 5, False, ["Line 1:0 - first - more", "Line 2:5 - second"], None, "Line 1:0 - first - more", "Line 1:0"),
        ("b.txt", 1, None, [], "KeyError: 'no such rule'", None, None)], key=repr)
    assert rows(sc.error_counts(found)) == [("a.txt", "Line 1:0", 2), ("a.txt", "no dash", 1)]
    assert rows(sc.message_counts(found)) == [("a.txt", "Line 1:0", 2), ("a.txt", "Line 2:5", 2), ("a.txt", "no dash", 1)]
    assert rows(sc.stats_of_all(scripts, found)) == [
        ("a.txt", 5, 3, 1, 60.0), ("b.txt", 1, 0, 1, 0.0), ("c.txt", 0, 0, 0, 0.0)]
    assert rows(sc.good_text(found)) == [("a.txt", "fine"), ("b.txt", None)]


def test_no_statements(spark):
    none = spark.createDataFrame([], "file string, stmt_no int, stmt string")
    assert sc.validate_statements(none, validator()).collect() == []


def test_a_job_with_a_validator(spark, rows, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.txt").write_text("fine;two;\nboom")
    (folder / "b.txt").write_text("\n")
    out = str(tmp_path / "out")
    stats = jobs.validate_scripts(spark, str(folder), out, validate=validator())
    assert rows(stats) == [("a.txt", 3, 1, 1, 33.33), ("b.txt", 0, 0, 0, 0.0)]
    assert rows(spark.read.parquet(f"{out}/messages")) == [
        ("a.txt", 2, ["Line 1:0 - first - more", "Line 2:5 - second"], None), ("a.txt", 3, [], "KeyError: 'no such rule'")]
    assert rows(spark.read.csv(f"{out}/errors", header=True)) == [("Line 1:0", "a")]
    assert rows(spark.read.parquet(f"{out}/invalid").select("stmt_no")) == [(2,)]
