"""Calendar resampling."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .reshape import numeric_columns


def resample_last(
    df: DataFrame, key: str, date: str, freq: str = "W", *, exclude: Iterable[str] = ()
) -> DataFrame:
    """Last non-null value of every numeric column per key and week or month.

    ``W`` labels a week by its Sunday, ``ME`` a month by its last day. A period in which
    every column is null has no row. One aggregation: each task keeps one value per column,
    key and period before the shuffle.
    """
    day = F.col(date)
    labels = {"W": F.next_day(F.date_sub(day, 1), "Sun"), "ME": F.last_day(day)}
    measures = numeric_columns(df, [key, date, *exclude])
    newest = [
        F.max_by(name, F.when(F.col(name).isNotNull(), day)).alias(name) for name in measures
    ]
    return (
        df.groupBy(key, labels[freq].alias("period")).agg(*newest).na.drop("all", subset=measures)
    )
