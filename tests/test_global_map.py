"""The versioned global map, and the mapping step of a level that uses it."""

from __future__ import annotations

import threading

from querytrail import jobs
from querytrail.sources import global_map

HEAD = "source_col,source_table,target_table,target_col,source_db,target_db,Derivation_logic\n"


def pairs(spark, *listed):
    return spark.createDataFrame(list(listed), global_map.PAIRS)


def held(spark, folder):
    return sorted(map(tuple, global_map.read_global_map(spark, folder).collect()))


def test_versions_hold_each_pair_once(spark, tmp_path):
    folder = str(tmp_path / "map")
    assert held(spark, folder) == [] and not global_map.map_exists(spark, folder)
    assert global_map.add_pairs(spark, folder, pairs(spark, ("d", "a"), ("d", "a"), ("e", "b"))) == 0
    assert global_map.add_pairs(spark, folder, pairs(spark, ("d", "a"))) == 0
    assert global_map.add_pairs(spark, folder, pairs(spark, ("d", "a"), ("d", "c"))) == 1
    assert held(spark, folder) == [("d", "a"), ("d", "c"), ("e", "b")]
    assert len(list((tmp_path / "map" / "parts").iterdir())) == 2
    empty = str(tmp_path / "empty")
    assert global_map.add_pairs(spark, empty, pairs(spark)) == 0 and held(spark, empty) == []
    assert global_map.map_exists(spark, empty)


def test_concurrent_runs_add_no_pair_twice(spark, tmp_path, monkeypatch):
    """All runs look at the same version before any of them claims the next one."""
    folder = str(tmp_path / "map")
    global_map.add_pairs(spark, folder, pairs(spark, ("d", "t0")))
    runs, together, claim = 4, threading.Barrier(4), global_map.claim_place
    first = threading.local()
    lost = []

    def wait_then_claim(session, source, target):
        if not getattr(first, "done", False):
            first.done = True
            together.wait(60)
        won = claim(session, source, target)
        lost.append(not won)
        return won

    monkeypatch.setattr(global_map, "claim_place", wait_then_claim)
    wanted = [[("d", f"t{i}") for i in range(no, no + 3)] for no in range(runs)]
    threads = [threading.Thread(target=global_map.add_pairs, args=(spark, folder, pairs(spark, *w))) for w in wanted]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join(120)
    assert held(spark, folder) == [("d", f"t{i}") for i in range(runs + 2)]
    assert sum(lost) >= runs - 1
    assert not list((tmp_path / "map").glob("staged-*")) and not list((tmp_path / "map").glob("versions/*/staged-*"))


def test_rows_are_kept_when_no_database_is_missing(spark, rows, tmp_path):
    first, second, third = (tmp_path / f"{n}.csv" for n in "abc")
    first.write_text(HEAD + "c,s1,t1,c,,A,x\nc,s2,t2,c,B,,x\n")
    second.write_text(HEAD + "c,s9,t9,c,,A,x\nc,s9,t9,c,,A,x\nc,s8,t8,c,B,K,x\n")
    third.write_text(HEAD + "c,s9,t9,c,NEW,A,x\n")
    catalog = spark.createDataFrame([("s1", "K", 1), ("t2", "L", 2), ("s9", "M", 3)], "tablename string, DatabaseName string, LastAccessTimeStamp int")
    folders = [str(tmp_path / n) for n in ("global", "map")]

    def level(path):
        return rows(jobs.map_level(spark, str(path), f"{path}.out", *folders, catalog).select("source_table", "source_db", "target_table", "target_db"))

    assert level(first) == [("s1", "K", "t1", "A"), ("s2", "B", "t2", "L")]
    assert held(spark, folders[0]) == [("A", "t1"), ("B", "s2"), ("K", "s1"), ("L", "t2")]
    # A, B and K are known: the rows stay as they are, copies and gaps included.
    assert level(second) == [("s8", "B", "t8", "K"), ("s9", None, "t9", "A"), ("s9", None, "t9", "A")]
    assert len(held(spark, folders[0])) == 4
    assert level(third) == [("s9", "NEW", "t9", "A")]
    assert held(spark, folders[0])[-1] == ("NEW", "s9") and ("A", "t9") in held(spark, folders[0])
