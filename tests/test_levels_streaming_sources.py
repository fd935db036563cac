from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from querytrail.operators import levels, logmine
from querytrail.sources import sinks, tables, texts
from querytrail.streaming import landing


def edges(spark, pairs):
    return spark.createDataFrame([("d", a, "d", b) for a, b in pairs], "db string, `table` string, target_db string, target_table string")


def seeds(spark, *names):
    return spark.createDataFrame([("d", n) for n in names], "db string, `table` string")


def brute(pairs, start, depth, every=False):
    out, now, seen = [sorted(start)], set(start), set(start)
    for _ in range(depth - 1):
        if not now:
            break
        now = {b for a, b in pairs if a in now} - (seen if every else now)
        seen |= now
        out.append(sorted(now))
    return [x for x in out if x]


@pytest.mark.parametrize("every", [False, True])
@pytest.mark.parametrize("depth", [1, 2, 7])
def test_levels_with_cycles(spark, every, depth):
    pairs = [(str(n), str((2 * n + 1) % 25)) for n in range(25)] + [(str(n), str((3 * n + 2) % 25)) for n in range(25)]
    got = levels.expand_levels(edges(spark, pairs * 2), seeds(spark, "0", "7"), depth, exclude_all=every)
    found = {}
    for r in got.collect():
        found.setdefault(r.level, []).append(r.table)
    want = brute(pairs, {"0", "7"}, depth, every)
    assert [sorted(found[k]) for k in sorted(found)] == want
    if not every and depth == 7:
        assert [len(x) for x in want] == [2, 4, 6, 8, 9, 9, 9]


def test_levels_end_on_an_empty_frontier(spark):
    got = levels.expand_levels(edges(spark, [("a", "b")]), seeds(spark, "a"), 50)
    assert sorted((r.level, r.table) for r in got.collect()) == [(1, "a"), (2, "b")]


def test_frontier_rules(spark, rows):
    out = edges(spark, [("a", "b"), ("a", "a")])
    assert rows(levels.next_frontier(out, seeds(spark, "a"))) == [("d", "b")]
    assert rows(levels.next_frontier(out, None)) == [("d", "a"), ("d", "b")]
    assert levels.next_frontier(out.drop("target_db"), seeds(spark, "a")).isEmpty()


# --- streaming -----------------------------------------------------------------------------------

FILES = {
    "object.json": ({"a": 1, "b": 2}, 2, False), "list.json": ([1, 2, 3], 3, False), "empty.json": ({}, 0, False),
    "data.json": ({"data": [1, 2, 3, 4], "x": 1}, 4, True), "inner.json": ({"data": {"k": 1}}, 1, True),
    "none.json": ([], 0, False), "number.json": (7, 0, False),
}


def test_landing_folder(spark, rows, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name, (value, _, _) in FILES.items():
        (folder / name).write_text(json.dumps(value, indent=2))
    (folder / "broken.json").write_text("{")
    (folder / "trailing.json").write_text('{"a": 1} {')
    (folder / "blank.json").write_text(" \n ")
    (folder / "other.txt").write_text("{}")

    def run():
        query = landing.start_ingest(
            landing.landing_stream(spark, str(folder)), str(tmp_path / "out"), str(tmp_path / "cp"))
        landing.drain(query, 120)
        return spark.read.parquet(str(tmp_path / "out"))

    want = sorted((n, c, d) for n, (_, c, d) in FILES.items())
    assert rows(landing.good_records(run()).drop("processed_at")) == want
    assert rows(landing.good_records(run()).drop("processed_at")) == want  # nothing is read twice
    (folder / "late.json").write_text("[1]")
    out = run()
    assert rows(landing.good_records(out).drop("processed_at")) == sorted([*want, ("late.json", 1, False)])
    bad = {r.source_file: r for r in landing.quarantined(out).collect()}
    assert set(bad) == {"broken.json", "trailing.json"}
    assert bad["broken.json"].error.startswith("JSONDecodeError") and bad["broken.json"].rejected_payload == "{"


def test_duplicate_keys_and_depth(spark, rows):
    deep = "[" * 1500 + "]" * 1500
    d = spark.createDataFrame([("a", '{"data": 1, "data": [1, 2], "b": 0}'), ("b", deep)], "file string, payload string")
    assert rows(landing.good_records(landing.extraction_records(d)).drop("processed_at")) == [
        ("a", 2, True), ("b", 1, False)]


def test_running_totals_over_two_runs(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    target = str(tmp_path / "totals")

    def run():
        landing.drain(landing.start_running_totals(
            landing.landing_stream(spark, str(folder)), target, str(tmp_path / "cp")), 120)
        return landing.latest_totals(spark, target).select("total_files_processed", "total_records_extracted").first()

    (folder / "a.json").write_text("[1, 2]")
    assert run() == (1, 2)
    (folder / "b.json").write_text('{"x": 1}')
    (folder / "c.json").write_text("{")
    assert run() == (2, 3)


def test_statistics(spark):
    d = spark.createDataFrame([("a", "[1, 2]"), ("b", "[1]")], "file string, payload string")
    got = landing.processing_stats(landing.good_records(landing.extraction_records(d))).first()
    assert (got.total_files_processed, got.total_records_extracted, got.average_records_per_file) == (2, 3, 1.5)
    assert landing.processing_stats(landing.good_records(landing.extraction_records(d.limit(0)))).count() == 0


def test_caller_extractor(spark, rows):
    schema = T.StructType([T.StructField("file", T.StringType()), T.StructField("n", T.LongType())])
    d = spark.createDataFrame([("a", "[1, 2]"), ("b", "{")], "file string, payload string")
    assert rows(landing.extract_with(d, lambda v, f: {"file": f, "n": len(v)}, schema)) == [("a", 2)]


# --- sources and sinks -----------------------------------------------------------------------------

def test_delimited_round_trip(spark, rows, tmp_path):
    data = [(" a", 'say "x", y', None), ("007", "NULL", "z ")]
    df = spark.createDataFrame(data, "x string, `y y` string, z string")
    sinks.write_table(df, str(tmp_path / "t"))
    back = tables.read_table(spark, str(tmp_path / "t"), position="pos")
    assert back.columns == ["x", "y y", "z", "pos"]
    assert rows(back.drop("pos")) == [(" a", 'say "x", y', None), ("007", None, "z ")]
    sinks.write_table(df.limit(0), str(tmp_path / "t"))
    files = list((tmp_path / "t").glob("part*"))
    assert [f.read_text().strip() for f in files] == ["x,y y,z"]


def test_position_follows_the_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n\n" + "\n".join(str(i) for i in range(500)) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        back = tables.read_table(spark, str(tmp_path / "a.csv"), position="pos")
        assert back.rdd.getNumPartitions() > 3
        assert [r.n for r in back.orderBy("pos").collect()] == [str(i) for i in range(500)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_position_follows_files_of_unequal_size(spark, tmp_path):
    n = 0
    for part, size in enumerate((3, 400, 90, 200)):  # Spark plans the longest first
        (tmp_path / f"part-{part}.csv").write_text("n\n" + "".join(f"{n + i}\n" for i in range(size)))
        n += size
    back = tables.read_table(spark, str(tmp_path), position="pos")
    assert [int(r.n) for r in back.orderBy("pos").collect()] == list(range(n))
    assert back.agg(F.min_by("n", "pos")).first()[0] == "0"


def test_a_stopped_stream_is_an_error(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"in{i}.json").write_text("[1, 2]")
    slow = F.udf(lambda x: __import__("time").sleep(20) or x)
    stream = landing.landing_stream(spark, str(tmp_path), files_per_trigger=1)
    started = landing.start_ingest(
        stream.withColumn("payload", slow("payload")), str(tmp_path / "out"), str(tmp_path / "check"))
    with pytest.raises(TimeoutError):
        landing.drain(started, max_wait_seconds=3)
    again = landing.start_ingest(stream, str(tmp_path / "out"), str(tmp_path / "check"))
    landing.drain(again)
    assert landing.good_records(spark.read.parquet(str(tmp_path / "out"))).count() == 3


def test_log_lines_are_numbered_across_splits(spark, tmp_path):
    wanted = {}
    for name, end in (("a", "\n"), ("b", "\r\n")):
        lines = [f"line {i}" if i % 7 else "" for i in range(300)]
        (tmp_path / f"{name}.log").write_bytes(end.join(lines).encode() + (end.encode() if name == "a" else b""))
        wanted.update({(name, i + 1): x for i, x in enumerate(lines)})
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        got = texts.read_log_lines(spark, str(tmp_path))
        found = {(r.file[-5], r.line_no): r.line for r in got.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert found == wanted


def test_log_file_to_skipped_tables(spark, rows, tmp_path):
    (tmp_path / "p.log").write_text(
        "x\n2024 WARNING  Spool error for d tables ['a']... [s→e]: skip\n"
        "2024 WARNING  Skipping date range 2024-01-01 → 2024-01-30 for d Batch 3 due to error\n", encoding="utf-8")
    assert rows(logmine.skipped_tables(texts.read_log_lines(spark, str(tmp_path / "p.log")))) == [
        ("d", "a", "2024-01-01", "2024-01-30", "3")]


def test_scripts_are_read_whole(spark, rows, tmp_path):
    text = "SELECT 1;\nx\r\n;y\n"
    (tmp_path / "a.txt").write_bytes(text.encode())
    (tmp_path / "b.sql").write_text("no")
    assert rows(texts.read_scripts(spark, str(tmp_path))) == [("a.txt", text)]


def test_metadata(spark):
    d = spark.createDataFrame([
        ("a", '{"metadata": {"filename": "f", "totalTokens": 3, "failedQueries": ["x"]}}'), ("b", '{"x": 1}'), ("c", "[1]")],
        "file string, payload string")
    got = {r.file: r for r in texts.file_metadata(d).collect()}
    assert (got["a"].filename, got["a"].totalTokens, got["a"].failedQueries, got["a"].status) == ("f", 3, ["x"], None)
    assert got["b"].filename is None and got["c"].failedQueries is None


def test_append_extracts_by_type(spark, tmp_path):
    rows_ = spark.createDataFrame([("Insert  ", 1), ("Select", 2)], "StatementType string, QueryID int")
    for fmt in ("parquet", "csv"):
        folder = str(tmp_path / fmt)
        sinks.append_extracts(rows_, folder, fmt)
        sinks.append_extracts(rows_.filter("QueryID = 1"), folder, fmt)
        back = spark.read.option("header", True).format(fmt).load(folder)
        assert {r.statement_type: r["count"] for r in back.groupBy("statement_type").count().collect()} == {
            "Insert": 2, "Select": 1}


def test_trees_are_written_per_script(spark, tmp_path):
    d = spark.createDataFrame([("a.txt", '{"nodeType": "x"}')], "file string, payload string")
    sinks.write_trees(d, str(tmp_path / "t"), per_file=True)
    files = list((tmp_path / "t").glob("file_name=a.json/part*"))
    assert [f.read_text().strip() for f in files] == ['{"nodeType": "x"}']
