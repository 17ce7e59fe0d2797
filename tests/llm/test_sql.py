"""The corpus queries that SQL can express, against DuckDB."""

import duckdb
import pytest

from gridmill.llm import catalog

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.sql(catalog.ORACLES[name])
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    a = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    order = [want.columns.index(c) for c in columns]
    assert a == sorted((tuple(r[i] for i in order) for r in want.fetchall()), key=repr)
    kinds = dict(zip(want.columns, map(str, want.types)))
    loose = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    assert {c: kinds[c] for c, k in df.dtypes if loose.get(k) != kinds[c]} == {}
