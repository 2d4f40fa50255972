"""Every registered query against its SQL in DuckDB, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test tables here")
QUERIES, ORACLE = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def comparable(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR)
    rows = [tuple(r) for r in found.collect()]
    if name not in ORACLE:
        assert rows
        return
    wanted = duck.execute(ORACLE[name])
    names = [column[0] for column in wanted.description]
    assert sorted(found.columns) == sorted(names)
    assert comparable(found.columns, rows) == comparable(names, wanted.fetchall())


def test_registers_agree():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert {r.dataset for r in entry_points.entry(spark).collect()} == {
        "web_events", "ops_events", "all_events"}
