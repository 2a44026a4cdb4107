"""Registered queries: every operator over the driver tables, with equivalent SQL."""

from . import functions, quotes, reviews, shop, sources  # noqa: F401
from .registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
