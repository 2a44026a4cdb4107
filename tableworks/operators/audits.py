"""Counts, distinct counts and duplicate audits."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import null_safe_corr


def joined_key(keys: Sequence[str]) -> Column:
    """Keys glued without a separator, nulls skipped. Different keys may glue to one text."""
    return F.concat_ws("", *keys)


def count_by_year(df: DataFrame, date: str) -> DataFrame:
    return df.groupBy(F.year(date).alias("year")).agg(F.count("*").alias("rows")).orderBy("year")


def count_distinct_many(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Row count and the distinct count of each column, in one row and one pass."""
    return df.agg(
        F.count("*").alias("total"), *[F.countDistinct(name).alias(name) for name in columns]
    )


def duplicate_excess(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many rows exceed one per glued key."""
    surplus = F.count("*") - F.countDistinct(joined_key(keys))
    return df.agg(surplus.alias("duplicate_excess"))


def having_dups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def dup_audit(
    df: DataFrame,
    keys: Sequence[str],
    *,
    name: str = "glued_key",
    tie_break: Sequence[str] = (),
    limit: int = 1000,
) -> DataFrame:
    """First ``limit`` rows, by glued key, of the keys that occur more than once.

    Rows whose key holds a null are left out, as an equality join leaves them out.
    """
    repeated = having_dups(df, keys).drop("rows")
    return (
        df.join(repeated, list(keys), "left_semi")
        .select(joined_key(keys).alias(name), *df.columns)
        .orderBy(name, *tie_break)
        .limit(limit)
    )


def corr_group(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation, global or per group; null where a side is constant."""
    return df.groupBy(*by).agg(null_safe_corr(x, y).alias("correlation"))
