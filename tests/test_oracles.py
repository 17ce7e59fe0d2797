"""Every registered query with an oracle, against DuckDB on the same tables."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

from gridmill.plans import catalog

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(x):
    if isinstance(x, (list, tuple)):
        return tuple(plain(v) for v in x)
    if isinstance(x, decimal.Decimal):
        return float(x)
    if isinstance(x, float):
        return "nan" if math.isnan(x) else x + 0.0
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None)
    return x


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    assert len(set(df.columns)) == len(df.columns)
    got = [tuple(r) for r in df.collect()]
    if name not in catalog.ORACLES:
        assert got
        return
    want = duck.sql(catalog.ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    a, b = rows_of(df.columns, got), rows_of(want.columns, want.fetchall())
    assert len(a) == len(b)
    assert [x for x, y in zip(a, b) if x != y][:3] == [y for x, y in zip(a, b) if x != y][:3]
    kinds = {c: str(t) for c, t in zip(want.columns, want.types)}
    loose = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}
    assert {c: kinds[c] for c, k in df.dtypes if k in loose and loose[k] != kinds[c]} == {}
