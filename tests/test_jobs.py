"""The file-to-file jobs end to end."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from querytrail import jobs

HEAD = "Source DB,source_table,source_column,target_db,target_table,target_column\n"


@pytest.fixture
def put(tmp_path):
    def write(name, text):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
        return str(path)

    return write


def test_compare(spark, rows, put, tmp_path):
    a = put("a.csv", HEAD + "S,t,c,T,u,c\ns,T ,c,t,u,c\n,t,c,T,v,c\nNULL,x,c,T,v,c\n")
    b = put("b.csv", HEAD.replace("Source DB", "source_database") + "s,t,c,t,u,C\nnan,x,c,T,v,c\n")
    got = rows(jobs.compare_files(spark, a, b, str(tmp_path / "out")))
    assert got == [("12", "T", "v", "c", None, "t", "c", "Present in File 1 but not in File 2")]
    assert rows(jobs.compare_files(spark, a, a, str(tmp_path / "out"))) == []


def test_filter_and_merge(spark, rows, put, tmp_path):
    a = put("a.csv", "db,table,n\nd,t,1\nd,u,2\n,t,3\n")
    metrics = jobs.filter_file_by_pairs(spark, a, str(tmp_path / "out"), [("d", "t"), ("nan", "t")])
    assert metrics.first() == (3, 2, 66.67)
    assert rows(spark.read.csv(str(tmp_path / "out"), header=True)) == [("d", "t", "1"), (None, "t", "3")]
    b = put("b.csv", "db,table,n\ne,t,9")
    jobs.merge_files(spark, a, b, str(tmp_path / "both"))
    assert spark.read.csv(str(tmp_path / "both"), header=True).count() == 4
    with pytest.raises(ValueError):
        jobs.merge_files(spark, a, put("c.csv", "db,n,table\n"), str(tmp_path / "both"))


def test_map_tables_remembers_lookups(spark, rows, put, tmp_path):
    a = put("a.csv", "source_col,source_table,target_table,target_col,source_db,target_db,Derivation_logic\n"
                     "c,s1,t1,c,,A,x\nc,s1,t1,c,,A,x\nc,s2,t2,c,B,,x\n")
    catalog = spark.createDataFrame([("s1", "K", 1), ("t2", "L", None)], "tablename string, DatabaseName string, LastAccessTimeStamp int")
    out, saved = str(tmp_path / "out"), str(tmp_path / "map")
    got = jobs.map_tables(spark, a, out, saved, catalog).select("source_table", "source_db", "target_table", "target_db")
    assert rows(got) == [("s1", "K", "t1", "A"), ("s2", "B", "t2", "Unknown")]
    assert rows(spark.read.csv(saved, header=True)) == [("s1", "K"), ("t2", "Unknown")]
    jobs.map_tables(spark, a, out, saved, catalog.limit(0))  # the second run needs no catalog
    assert rows(spark.read.csv(saved, header=True)) == [("s1", "K"), ("t2", "Unknown")]


def test_extraction_runs_once_per_table(spark, rows, tmp_path):
    day = dt.date(2024, 1, 1)
    at = [(q % 2, q, day + dt.timedelta(q)) for q in range(20)]
    objects = spark.createDataFrame([(*k, "d", f"t{k[1] % 4}", dt.datetime(2024, 1, 1)) for k in at], "ProcID long, QueryID long, logdate date, ObjectDatabaseName string, ObjectTableName string, CollectTimeStamp timestamp_ntz")
    users = spark.createDataFrame([(*k, 1, "Insert ", "u") for k in at], "ProcID long, QueryID long, logdate date, SessionID long, StatementType string, Username string")
    sql = spark.createDataFrame([(*k, "x") for k in at], "ProcID long, QueryID long, logdate date, SQLTEXTINFO string")
    work = spark.createDataFrame([("d", "t0", 0), ("d", "t1", 1)], "db string, `table` string, pos long")

    def run(w):
        return jobs.extract_statements(
            spark, w, (objects, users, sql), ["Insert"], F.lit(day), F.lit(day + dt.timedelta(40)),
            str(tmp_path / "extract"), str(tmp_path / "ledger"), F.lit(day))

    assert {(r.level, r.rows) for r in run(work).collect()} == {(0, 10), (1, 10), (3, 10), (7, 10)}
    more = work.union(spark.createDataFrame([("d", "t2", 2)], work.schema))
    assert [r.rows for r in run(more).filter("level = 7").collect()] == [5]
    assert spark.read.parquet(str(tmp_path / "extract")).count() == 15
    assert rows(spark.read.parquet(str(tmp_path / "ledger")).select("target_table")) == [("t0",), ("t1",), ("t2",)]


def test_log_scripts_usage(spark, rows, put, tmp_path):
    log = put("p.log", "2024 WARNING  Spool error for d tables ['a', 'b']... [s→e]: skip\n"
                       "2024 WARNING  Skipping date range 2024-01-01 → 2024-01-30 for d Batch 3 due to error\n")
    summary = jobs.mine_log(spark, log, str(tmp_path / "gaps"))
    assert tuple(summary.first())[1:] == (1, 2, 0)
    assert [r[1] for r in rows(spark.read.csv(str(tmp_path / "gaps"), header=True))] == ["a", "b"]
    put("s/a.txt", "SELECT 1;\nwrong;")
    put("s/b.txt", " ;\n")
    stats = {r.file_name: tuple(r)[1:] for r in jobs.validate_scripts(spark, str(tmp_path / "s"), str(tmp_path / "v")).collect()}
    assert stats == {"a.txt": (2, 1, 0, 50.0), "b.txt": (0, 0, 0, 0.0)}
    assert rows(spark.read.csv(str(tmp_path / "v/errors"), header=True)) == [("Line 1:0", "a")]
    use = put("u.csv", "ObjectTableName,logdate,ProcID,QueryID,SessionID,SQLTEXTINFO\n"
                       "t,2024-01-01,1,9,5,create t\nt,2024-01-01,1,10,5,drop t\nu,2024-01-01,1,1,1,\n")
    got = jobs.classify_file(spark, use, str(tmp_path / "c")).select("ObjectTableName", "Table_Classification")
    assert rows(got) == [("t", "Temporary"), ("t", "Temporary"), ("u", "Active Table")]


def test_trees_and_ingest(spark, put, tmp_path):
    put("j/a.json", json.dumps({"tokenStream": [{"text": "x"}], "parseTree": {"nodeType": "RuleContext: r"}}, indent=1))
    put("j/b.json", "{")
    nodes, tokens, rejected = jobs.load_trees(spark, str(tmp_path / "j"), str(tmp_path / "t"))
    assert (nodes.count(), tokens.count(), [r.file for r in rejected.collect()]) == (1, 1, ["b.json"])
    stats = jobs.ingest_folder(spark, str(tmp_path / "j"), str(tmp_path / "i"), str(tmp_path / "cp")).first()
    assert (stats.total_files_processed, stats.total_records_extracted) == (1, 2)


def test_levels_with_a_callback(spark):
    links = spark.createDataFrame([("d", "a", "d", "b"), ("d", "b", "d", "c"), ("d", "c", "d", "c")], "db string, `table` string, target_db string, target_table string")
    work = spark.createDataFrame([("d", "a")], "db string, `table` string")
    got = jobs.run_levels(work, lambda now: links.join(now, ["db", "table"], "left_semi"), 9)
    assert sorted((r.level, r.table) for r in got.collect()) == [(1, "a"), (2, "b"), (3, "c")]


def test_stored_tables_are_removed_at_the_end(spark, tmp_path):
    from querytrail.session import cleaned_up, store

    before = spark.conf.get("spark.checkpoint.dir")
    with cleaned_up(spark):
        kept = store(spark.range(3), "scratch")
        path = kept.inputFiles()[0].rpartition("/")[0]
        kept.write.parquet(str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3 and before
    import os

    assert not os.path.exists(path.removeprefix("file://"))


def test_map_tables_refuses_a_single_file(spark, put, tmp_path):
    import pytest

    a = put("a.csv", "source_col,source_table,target_table,target_col,source_db,target_db,Derivation_logic\nc,s1,t1,c,,A,x\n")
    saved = put("map.csv", "table_name,database_name\ns1,K\n")
    catalog = spark.createDataFrame([], "tablename string, DatabaseName string, LastAccessTimeStamp int")
    with pytest.raises(ValueError):
        jobs.map_tables(spark, a, str(tmp_path / "out"), saved, catalog)
    assert not (tmp_path / "out").exists()
