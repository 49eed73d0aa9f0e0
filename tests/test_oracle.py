"""Every registered query against its SQL in DuckDB."""

import datetime

import duckdb
import pytest

import __spark_entry__ as entry_point
from verification.oracle import ORACLES
from verification.runs import QUERIES

SF = "/root/testdata/sf0.001"
NAMES = """region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels
 conversations""".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(value):
        return value.date() if isinstance(value, datetime.datetime) else value

    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def test_each_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= entry_point.queries().items() and ORACLES.items() <= entry_point.oracle_sql().items()
    assert entry_point.oracle_sql().keys() <= entry_point.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    found = QUERIES[name](spark, SF)
    wanted = duck.execute(ORACLES[name])
    columns = [c[0] for c in wanted.description]
    assert sorted(found.columns) == sorted(columns)
    rows = _rows(found.columns, found.collect())
    assert rows and rows == _rows(columns, wanted.fetchall())


def test_entry(spark):
    result = entry_point.entry(spark)
    assert result.columns == ["stmt_id", "user_name", "message"]
    assert result.count() > 0
