"""The registry of queries and small helpers of the plans."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with the DuckDB SQL that gives the same rows."""

    def put(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return put


def dec(c: Column | str, digits: int = 6) -> Column:
    """A double as an exact decimal, so that engines can be compared by value.

    Spark's own cast rounds the digits that a double prints; DuckDB's multiplies the double and rounds that, half away from zero."""
    units = F.round((F.col(c) if isinstance(c, str) else c).cast("double") * float(10**digits))
    return (F.nanvl(units, F.lit(None).cast("double")).cast("long").cast("decimal(18,0)") * F.lit(Decimal(1).scaleb(-digits))).cast(f"decimal(18,{digits})")


def big(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("long")
