"""Review clean-up: projection and one row per id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def project_review(df: DataFrame) -> DataFrame:
    """The review columns downstream jobs use. ``timestamp`` arrives as epoch milliseconds.

    The id skips null parts. A null vote count is not zero votes, so its flag is true.
    """
    moment = F.timestamp_millis("timestamp")
    no_votes = F.col("helpful_vote") == 0
    return df.select(
        F.concat_ws("_", "user_id", "timestamp").alias("id"),
        "rating",
        "user_id",
        moment.alias("timestamp"),
        F.date_format(moment, "yyyy-MM").alias("year_month"),
        F.to_json(F.struct("title", "text")).alias("full_text"),
        "asin",
        "parent_asin",
        (~F.coalesce(no_votes, F.lit(False))).alias("helpful_vote"),
        "verified_purchase",
    )


def review_projection(df: DataFrame) -> DataFrame:
    """Drop rows that repeat in every raw column, then project."""
    return project_review(df.distinct())


def dedup_first(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """The first row of every key.

    The remaining columns break ties, so the result does not depend on row order. The rank
    filter is applied before the shuffle too: a task sends at most one row per key, however
    many rows a key has.
    """
    rest = [name for name in df.columns if name not in {key, *order_by}]
    first = Window.partitionBy(key).orderBy(*[F.asc_nulls_first(c) for c in [*order_by, *rest]])
    return (
        df.withColumn("_place", F.row_number().over(first))
        .where(F.col("_place") == 1)
        .drop("_place")
    )
