"""The operators that SQL can express, against DuckDB on whole tables."""

import duckdb
import pytest

from wardline.llm.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14)) and ORACLES.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", ORACLES)
def test_query(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found, wanted = QUERIES[name](spark, SF), con.execute(ORACLES[name])
    columns = [c[0] for c in wanted.description]
    assert sorted(found.columns) == sorted(columns)
    rows = sorted(map(tuple, found.select(*columns).collect()), key=repr)
    assert rows and rows == sorted(wanted.fetchall(), key=repr)
