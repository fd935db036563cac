"""Every registered query against its check query, on the smallest given tables."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import pytest

from querytrail import plans

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN",
}
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no given tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else round(value, 9)
    return tuple(plain(v) for v in value) if isinstance(value, list | tuple) else value


def table(columns, records):
    order = sorted(columns)
    places = [columns.index(c) for c in order]
    return order, sorted((tuple(plain(r[i]) for i in places) for r in records), key=repr)


@pytest.mark.parametrize("name", sorted(plans.queries()))
def test_query(spark, duck, name):
    df = plans.queries()[name](spark, FOLDER)
    got = table(df.columns, df.collect())
    relation = duck.sql(plans.checks()[name])
    types = dict(zip(relation.columns, map(str, relation.types), strict=True))
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    assert got == table(relation.columns, relation.fetchall())


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
