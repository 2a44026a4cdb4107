"""Column lists, wide-to-long, and per-key averages."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def columns_except(df: DataFrame, exclude: Iterable[str]) -> list[str]:
    left_out = set(exclude)
    return [name for name in df.columns if name not in left_out]


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    left_out = set(exclude)
    return [
        field.name
        for field in df.schema
        if isinstance(field.dataType, T.NumericType) and field.name not in left_out
    ]


def select_numeric(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """Only the numeric columns, minus the named ones."""
    return df.select(*numeric_columns(df, exclude))


def star_exclude(df: DataFrame, exclude: Iterable[str], aggregate=F.avg) -> DataFrame:
    """One aggregate over every column except the named ones, in one row."""
    return df.agg(*[aggregate(name).alias(name) for name in columns_except(df, exclude)])


def average_all(
    df: DataFrame, key: str, exclude: Iterable[str], count_name: str = "purchases"
) -> DataFrame:
    """Per key the row count and the average of every column that is not excluded."""
    measures = columns_except(df, [key, *exclude])
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias(count_name), *[F.avg(name).alias(name) for name in measures]
    )


def unpivot(
    df: DataFrame,
    ids: Sequence[str],
    name: str = "feature",
    value: str = "feature_value",
) -> DataFrame:
    """Wide to long over every column that is not an id; null values leave no row."""
    measures = columns_except(df, ids)
    return df.unpivot(list(ids), measures, name, value).where(F.col(value).isNotNull())
