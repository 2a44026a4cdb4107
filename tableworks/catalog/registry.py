"""Name -> (Spark query, equivalent SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a query under its function's name; without SQL only its rows are checked."""

    def register(function: Query) -> Query:
        key = name or function.__name__
        if key in _queries:
            raise ValueError(f"query {key!r} is registered twice")
        _queries[key] = function
        if sql is not None:
            _oracles[key] = sql
        return function

    return register


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_oracles)


# Sums of doubles differ in the last bits with the order of the rows. Both sides of a
# comparison snap such values to a grid whose edges no short decimal number falls on.
_EDGE = 0.3711


def snap(column: Column | str, digits: int = 6) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return F.floor(value * float(10**digits) + _EDGE) / float(10**digits)


def snap_sql(expression: str, digits: int = 6) -> str:
    scale = float(10**digits)
    return f"floor(({expression}) * {scale} + {_EDGE}) / {scale}"


def snapped(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.withColumns({name: snap(name, places) for name, places in digits.items()})


def snapped_sql(digits: dict[str, int]) -> str:
    """Select-list items for ``SELECT * REPLACE (...)``."""
    return ", ".join(f"{snap_sql(name, places)} AS {name}" for name, places in digits.items())
