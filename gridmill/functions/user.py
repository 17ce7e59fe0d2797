"""User functions under a name in SQL (row U01): parsers, aggregates and table functions, their schemas checked when they are registered."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import PandasUDFType


class SqlFunctions:
    """Functions of a session by name. A name that is taken, by a built-in or by another, is an error, and so is one that SQL cannot call without quotes."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.names: dict[str, str] = {}

    def _claim(self, name: str, kind: str) -> None:
        if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name):
            raise ValueError(f"no name for a function: {name!r}")
        if name.lower() in self.names or self.spark.catalog.functionExists(name):
            raise ValueError(f"there is a function {name!r} already")
        self.names[name.lower()] = kind

    def parser(self, name: str, function: Callable[..., Iterable[dict]], schema: str) -> None:
        """A parser of one row into none, one or many: ``SELECT ... FROM t, LATERAL name(t.c)``.

        The function takes the arguments of a row and gives dictionaries with the fields
        of the schema; other fields, or a field missing, fail the query. Rows go to and
        from Python in Arrow batches.
        """
        fields = T._parse_datatype_string(schema)
        if not isinstance(fields, T.StructType) or not fields.names:
            raise ValueError("a parser's schema has named columns")
        if len({n.lower() for n in fields.names}) < len(fields.names):
            raise ValueError("a parser's columns have names of their own")
        self._claim(name, "parser")
        wanted = set(fields.names)

        class Rows:
            def eval(self, *values):
                for row in function(*values):
                    if set(row) != wanted:
                        raise ValueError(f"a row of {sorted(row)} where {sorted(wanted)} was declared")
                    yield tuple(row[n] for n in fields.names)

        self.spark.udtf.register(name, F.udtf(Rows, returnType=fields, useArrow=True))

    def aggregate(self, name: str, function: Callable, returns: str) -> None:
        """An aggregate of whole columns, pandas Series to one value: ``SELECT name(c) ... GROUP BY``. A group's column comes together in one task, so for large groups write a table function."""
        if isinstance(T._parse_datatype_string(returns), (T.StructType, T.ArrayType, T.MapType)):
            raise ValueError("an aggregate gives one plain value")
        self._claim(name, "aggregate")
        self.spark.udf.register(name, F.pandas_udf(function, returns, PandasUDFType.GROUPED_AGG))

    def table(self, name: str, parameters: str, schema: str, query: str) -> None:
        """A feature builder as a query with parameters: ``SELECT ... FROM name(...)``. It is SQL all through, so the optimizer sees into it; columns that do not fit the schema are an error now, not at the first call."""
        fields = T._parse_datatype_string(schema)
        if not isinstance(fields, T.StructType):
            raise ValueError("a table function's schema has named columns")
        self._claim(name, "table")
        try:
            self.spark.sql(f"CREATE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE ({schema}) RETURN {query}")
        except Exception:
            del self.names[name.lower()]
            raise

    def drop(self, name: str) -> None:
        """Takes a function out of the session."""
        self.names.pop(name.lower())
        self.spark.sql(f"DROP TEMPORARY FUNCTION {name}")
