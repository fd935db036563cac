"""Files that land twice, under one name or several."""

from __future__ import annotations

import os
import time

from querytrail import jobs
from querytrail.streaming import landing


def _put(folder, name, text):
    folder.mkdir(exist_ok=True)
    part = folder / f".{name}.part"
    part.write_text(text)
    part.rename(folder / f"{name}.json")


def _run(spark, base, within="30 days"):
    query = landing.start_ingest(
        landing.landing_stream(spark, str(base / "in")), str(base / "out"), str(base / "checkpoint"), once_within=within)
    landing.drain(query)
    return query


def test_copies_and_rewritten_files_give_one_record(spark, tmp_path):
    folder = tmp_path / "in"
    _put(folder, "a", '{"x": 1}')
    _put(folder, "b", '{"x": 1}')
    _run(spark, tmp_path)
    records = spark.read.parquet(str(tmp_path / "out"))
    assert [r.source_file for r in records.collect()] in (["a.json"], ["b.json"])
    _put(folder, "a", '{"x": 1}')  # written anew
    later = time.time() + 60
    os.utime(folder / "a.json", (later, later))
    _put(folder, "c", '{"x": 1}')
    _put(folder, "d", '{"x": 2, "y": 3}')
    os.utime(folder / "d.json", (later - 86400, later - 86400))  # an older time does not make it late
    _put(folder, "e", '{"x": ')
    _put(folder, "f", '{"x": ')
    _run(spark, tmp_path)
    spark.catalog.refreshByPath(str(tmp_path / "out"))
    records = spark.read.parquet(str(tmp_path / "out"))
    good = sorted((r.source_file, r.record_count) for r in landing.good_records(records).collect())
    assert [n for _, n in good] == [1, 2] and good[-1] == ("d.json", 2)
    assert landing.quarantined(records).count() == 1


def test_a_job_counts_contents_or_files(spark, tmp_path):
    for name in "ab":
        _put(tmp_path / "in", name, "[1, 2]")
    folder = str(tmp_path / "in")
    files = jobs.ingest_folder(spark, folder, str(tmp_path / "o1"), str(tmp_path / "c1")).first()
    contents = jobs.ingest_folder(spark, folder, str(tmp_path / "o2"), str(tmp_path / "c2"), once_within="1 day").first()
    assert files.total_files_processed == 2 and contents.total_files_processed == 1


def test_state_is_bounded_by_the_time(spark, tmp_path):
    kept = []
    for no in range(4):
        for i in range(25):
            _put(tmp_path / "in", f"r{no}-{i}", f'{{"run": {no}, "file": {i}}}')
        query = _run(spark, tmp_path, within="1 second")
        held = [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]]
        kept.append(held[-1])
        time.sleep(1.5)
    assert landing.good_records(spark.read.parquet(str(tmp_path / "out"))).count() == 100
    # A run's contents are forgotten as soon as a later batch shows that their time is over.
    assert max(kept) <= 50 and kept[-1] <= 50
