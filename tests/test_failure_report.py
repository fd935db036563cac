"""The failure report as it is written and read."""

from __future__ import annotations

from querytrail.sources import sinks


def test_report_is_written_in_order(spark, tmp_path):
    files = spark.createDataFrame([("b.txt",), ("a.txt",)], "file string")
    labels = spark.createDataFrame([("a.txt_query_2: x...",)], "label string")
    sinks.write_failure_report(files, labels, str(tmp_path / "report"))
    lines = [line for part in sorted((tmp_path / "report").glob("part-*")) for line in part.read_text().splitlines()]
    assert lines == [
        "FILES THAT TIMED OUT (2):", "- a.txt", "- b.txt", "QUERIES THAT TIMED OUT (1):", "- a.txt_query_2: x..."]
    sinks.write_failure_report(files.limit(0), labels.limit(0), str(tmp_path / "report"))
    again = spark.read.text(str(tmp_path / "report")).collect()
    assert sorted(r.value for r in again) == ["FILES THAT TIMED OUT (0):", "QUERIES THAT TIMED OUT (0):"]
