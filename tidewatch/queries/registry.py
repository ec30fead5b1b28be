"""Where queries and their SQL twins are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name``, with the SQL that must give the same rows."""

    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return add


def r6(column: str | Column, alias: str | None = None) -> Column:
    """Round to six digits, so engines agree."""
    value = F.col(column) if isinstance(column, str) else column
    named = F.round(value.cast("double"), 6)
    return named.alias(alias or column) if alias or isinstance(column, str) else named


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: r6(F.col(c)) for c in columns})
