"""Batches that fail stay out of the ledger, are named, and are the only ones repeated."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from querytrail import batches, jobs

DAY = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def logs(spark):
    """Seven databases with three tables each; every table has an insert and an update."""
    at = [(q % 2, q, DAY + dt.timedelta(q % 20), f"d{q % 7}", f"t{q // 7 % 3}", "Insert " if q < 21 else "Update") for q in range(42)]
    key = "ProcID long, QueryID long, logdate date"
    objects = spark.createDataFrame([(*a[:5], dt.datetime(2024, 1, 1)) for a in at], key + ", ObjectDatabaseName string, ObjectTableName string, CollectTimeStamp timestamp_ntz")
    users = spark.createDataFrame([(*a[:3], 1, a[5], "u") for a in at], key + ", SessionID long, StatementType string, Username string")
    return objects, users, spark.createDataFrame([(*a[:3], "x") for a in at], key + ", SQLTEXTINFO string")


@pytest.fixture(scope="module")
def work(spark):
    return spark.createDataFrame([(f"d{d}", f"t{t}", 10 * d + t) for d in range(7) for t in range(3)], "db string, `table` string, pos long")


def refusing(*databases, statement="Update"):
    """A check that meets an error in some databases."""
    def check(rows):
        bad = F.col("ObjectDatabaseName").isin(*databases) & (F.trim("StatementType") == statement)
        return rows.withColumn("SQLTEXTINFO", F.when(bad, F.raise_error(F.lit("no more spool space"))).otherwise(F.col("SQLTEXTINFO")))

    return check


def run(spark, work, logs, base, **how):
    return jobs.extract_statements(
        spark, work, logs, ["Insert", "Update"], F.lit(DAY), F.lit(DAY + dt.timedelta(40)),
        str(base / "extract"), str(base / "ledger"), F.lit(DAY), **how)


def done(spark, base):
    return sorted({(r.target_db, r.target_table) for r in batches.read_ledger(spark, str(base / "ledger")).collect()})


def test_only_failed_batches_are_repeated(spark, work, logs, tmp_path):
    failed = str(tmp_path / "failed")
    totals = run(spark, work, logs, tmp_path, check=refusing("d2", "d5"), failed=failed)
    assert {r.db: r.rows for r in totals.filter("level = 3").collect()} == {f"d{d}": 6 for d in (0, 1, 3, 4, 6)}
    assert done(spark, tmp_path) == [(f"d{d}", f"t{t}") for d in (0, 1, 3, 4, 6) for t in range(3)]
    found = sorted(batches.read_failed(spark, failed).collect())
    assert [(r.db, r.batch_number, sorted(r.tables), r.batch_size, r.statement) for r in found] == [
        (d, 1, ["t0", "t1", "t2"], 3, "Update") for d in ("d2", "d5")]
    assert all("no more spool space" in r.error for r in found)

    extracted = []

    def watch(rows):
        extracted.append({r.ObjectDatabaseName for r in rows.collect()})
        return rows

    run(spark, work, logs, tmp_path, check=watch, failed=failed)
    assert extracted == [{"d2", "d5"}]
    assert len(done(spark, tmp_path)) == 21 and batches.read_failed(spark, failed).count() == 0
    kept = batches.read_extract(spark, str(tmp_path / "extract"), str(tmp_path / "ledger"))
    assert kept.count() == kept.distinct().count() == 42


def test_without_a_list_of_failures_an_error_ends_the_run(spark, work, logs, tmp_path):
    with pytest.raises(Exception, match="no more spool space"):
        run(spark, work, logs, tmp_path, check=refusing("d2"))
    assert done(spark, tmp_path) == []
    run(spark, work, logs, tmp_path)
    assert len(done(spark, tmp_path)) == 21


def test_a_log_that_fails_for_some_batches(spark, work, logs, tmp_path):
    """The error lies in the extraction itself, and only in the rows of one database."""
    objects, users, texts = logs
    poisoned = objects.withColumn("CollectTimeStamp", F.when(
        F.col("ObjectDatabaseName") == "d4", F.raise_error(F.lit("unreadable block")).cast("timestamp_ntz")).otherwise(F.col("CollectTimeStamp")))
    run(spark, work, (poisoned, users, texts), tmp_path, failed=str(tmp_path / "failed"))
    found = batches.read_failed(spark, str(tmp_path / "failed")).collect()
    assert {r.db for r in found} == {"d4"} and all("unreadable block" in r.error for r in found)
    assert len(done(spark, tmp_path)) == 18


def test_a_general_failure_stops_the_run(spark, work, logs, tmp_path):
    everything = refusing(*(f"d{d}" for d in range(7)), statement="Insert")
    with pytest.raises(batches.TooManyFailures, match="no more spool space"):
        run(spark, work, logs, tmp_path, check=everything, failed=str(tmp_path / "failed"), max_failures=2)
    assert done(spark, tmp_path) == []


def test_rows_without_a_ledger_entry_do_not_count(spark, work, logs, tmp_path, monkeypatch):
    """The driver is lost between the rows of a run and its ledger entry."""
    moves = []

    def stop_at_second(session, source, target):
        moves.append(target)
        if len(moves) == 2:
            raise KeyboardInterrupt
        from querytrail.session import move_into_place
        move_into_place(session, source, target)

    with monkeypatch.context() as patch:
        patch.setattr(batches, "move_into_place", stop_at_second)
        with pytest.raises(KeyboardInterrupt):
            run(spark, work.filter("db < 'd3'"), logs, tmp_path, failed=str(tmp_path / "failed"))
    assert done(spark, tmp_path) == []
    run(spark, work, logs, tmp_path, failed=str(tmp_path / "failed"))
    kept = batches.read_extract(spark, str(tmp_path / "extract"), str(tmp_path / "ledger"))
    assert kept.count() == 42 and len(done(spark, tmp_path)) == 21
