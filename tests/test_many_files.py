"""Files that grow in number: a folder per task, not per file, and lists of paths dealt to few tasks."""

from __future__ import annotations

import json
from pathlib import Path

from querytrail.plans import script_queries, standins, stream_queries
from querytrail.sources import sinks

LINES = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string"


def found(folder) -> tuple[set[str], list[Path]]:
    files = [p for p in Path(folder).rglob("*") if p.is_file() and not p.name.startswith((".", "_"))]
    return {p.parent.name for p in files}, files


def test_conversations_land_in_a_folder_per_task(spark, tmp_path):
    turns = [(i, k, "user", f"{i}-{k}") for i in [*range(40), None] for k in (1, 0)]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(
        f"{tmp_path}/conversations.parquet")
    tables = standins.Tables(spark, str(tmp_path))
    stream_queries._drop_files(tables, f"{tmp_path}/in")
    folders, files = found(tmp_path / "in")
    assert len(files) == 41 and len(folders) <= 4
    texts = sorted([t["text"] for t in json.loads(p.read_text())["data"]] for p in files)
    assert texts == sorted([f"{i}-0", f"{i}-1"] for i in [*range(40), None])
    assert stream_queries.landing_folder_stream(tables).first() == (82, 41)


def test_scripts_are_written_in_a_folder_per_task(spark, tmp_path):
    # parts that are blank, missing throughout an order, and of no order
    lines = [(k * 100 + j, 5, 7, 1, q, f) for k in range(30) for j, q, f in ((0, 9.0, "A"), (1, 1.0, "N"), (2, 9.0, "R"))]
    spark.createDataFrame(
        [*lines, (3, None, 7, 1, 9.0, "A"), (None, 5, 7, 1, 9.0, "A"), (9900, None, 7, 1, 9.0, "A")], LINES,
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.glob("querytrail-scripts-*"))
    tables = standins.Tables(spark, str(tmp_path))
    got = script_queries.script_scan(tables).collect()
    folders, files = found((set(shared.glob("querytrail-scripts-*")) - before).pop())
    assert len(files) == len(got) == 32 and len(folders) <= 4
    part = {r.l_orderkey: r.part for r in tables["v_parts"].filter("l_orderkey < 3").collect()}
    whole = ";".join(part[i] for i in range(3)) + "\n"
    some = tables["v_parts"].filter("l_orderkey is null").first().part + "\n"
    assert sorted(p.read_bytes().decode() for p in files) == sorted(["\n", some, *_all_texts(tables)])
    assert whole in _all_texts(tables)
    assert sorted((r.is_txt, r.n, r.parts) for r in got) == sorted(
        (True, len(x), x.count(";") + 1) for x in ["\n", some, *_all_texts(tables)])


def _all_texts(tables) -> list[str]:
    scripts: dict[int, list] = {}
    for r in tables["v_parts"].filter("l_orderkey is not null and part is not null").orderBy("l_orderkey", "stmt_no").collect():
        scripts.setdefault(r.l_orderkey // 100, []).append(r.part)
    return [";".join(parts) + "\n" for parts in scripts.values()]


def test_small_files_need_no_checksum_files(spark, tmp_path):
    rows = spark.createDataFrame([(t,) for t in ("a;b", "", None, "ü\n")], "value string").repartition(3)
    sinks.write_files(rows, str(tmp_path / "out"), "text")
    _, files = found(tmp_path / "out")
    assert sorted(p.read_bytes().decode() for p in files) == ["\n", "\n", "a;b\n", "ü\n\n"]
    assert not list((tmp_path / "out").rglob(".part*.crc"))


def test_paths_are_listed_by_few_tasks(spark, tmp_path):
    for i in range(400):
        (tmp_path / f"{i}.txt").write_text("x")
    standins.Tables(spark, str(tmp_path))
    spark.sparkContext.setJobGroup("listing", "")
    try:
        frame = spark.read.text([f"{tmp_path}/{i}.txt" for i in range(400)])
        tracker = spark.sparkContext.statusTracker()
        stages = [s for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert stages and max(tracker.getStageInfo(s).numTasks for s in stages) <= 256
    assert frame.count() == 400
