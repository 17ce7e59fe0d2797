"""User functions called from SQL."""

import pytest

from gridmill.functions.user import SqlFunctions


@pytest.fixture
def functions(spark):
    made = SqlFunctions(spark)
    yield made
    for name in list(made.names):
        made.drop(name)


@pytest.fixture
def pairs():
    """A parser that workers get by value: they cannot import the tests."""

    def parse(text):
        for part in (text or "").split(";"):
            if "=" in part:
                key, value = part.split("=", 1)
                yield {"value": float(value), "key": key}

    return parse


def test_a_parser_gives_none_one_or_many_rows(spark, functions, pairs):
    functions.parser("test_pairs", pairs, "key string, value double")
    spark.createDataFrame([(1, "a=1;b=2.5"), (2, ""), (3, None), (4, "c=-1")], "i int, t string").createOrReplaceTempView("test_pairs_in")
    rows = spark.sql("SELECT i, p.* FROM test_pairs_in, LATERAL test_pairs(t) p ORDER BY i, key").collect()
    assert [tuple(r) for r in rows] == [(1, "a", 1.0), (1, "b", 2.5), (4, "c", -1.0)]
    assert spark.sql("SELECT count(*) FROM test_pairs('x=1;y=2')").first()[0] == 2


def test_rows_that_do_not_fit_fail_the_query(spark, functions):
    functions.parser("test_other", lambda t: [{"key": t, "more": 1}], "key string")
    with pytest.raises(Exception, match="was declared"):
        spark.sql("SELECT * FROM test_other('x')").collect()


def test_aggregates_and_table_functions(spark, functions):
    functions.aggregate("test_span", lambda v: float(v.max() - v.min()), "double")
    spark.createDataFrame([("a", 1.0), ("a", 5.0), ("b", 2.0)], "k string, v double").createOrReplaceTempView("test_span_in")
    assert {r.k: r.s for r in spark.sql("SELECT k, test_span(v) AS s FROM test_span_in GROUP BY k").collect()} == {"a": 4.0, "b": 0.0}
    functions.table("test_above", "least DOUBLE", "k STRING, n BIGINT", "SELECT k, count(*) FROM test_span_in WHERE v > test_above.least GROUP BY k")
    assert {r.k: r.n for r in spark.sql("SELECT * FROM test_above(1.5D)").collect()} == {"a": 1, "b": 1}


def test_clashes_and_wrong_schemas_are_errors(spark, functions, pairs):
    functions.parser("test_once", pairs, "key string, value double")
    for name in ("test_once", "TEST_ONCE", "explode", "abs", "no name", "1st", ""):
        with pytest.raises(ValueError):
            functions.parser(name, pairs, "key string, value double")
    with pytest.raises(ValueError):
        SqlFunctions(spark).aggregate("test_once", lambda v: 1.0, "double")
    for schema in ("double", "key string, KEY double"):
        with pytest.raises(Exception):
            functions.parser("test_schema", pairs, schema)
    with pytest.raises(Exception):
        functions.parser("test_schema", pairs, "key strng")
    for kind in ("array<double>", "a int"):
        with pytest.raises(ValueError):
            functions.aggregate("test_kind", lambda v: 1.0, kind)
    with pytest.raises(Exception):
        functions.table("test_columns", "x INT", "a INT, b INT", "SELECT x")
    assert "test_columns" not in functions.names
    functions.drop("test_once")
    functions.parser("test_once", pairs, "key string, value double")
