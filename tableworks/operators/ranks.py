"""Exact ranks without a single-task sort, and rank correlations built on them."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import null_safe_corr
from ..session import stored
from .reshape import average_all, unpivot

#: Rows of a part.
PART_ROWS = 100_000


def rank_by_value(
    df: DataFrame,
    value: str,
    name: str,
    *,
    within: Sequence[str] = (),
    tasks: int | None = None,
    number: str | None = None,
) -> DataFrame:
    """``rank()`` of ``value`` ascending, nulls last, per group of ``within`` or globally.

    ``value`` may have any orderable type. Rows are numbered and stored, dealt out by ranges of
    (group, value) and, among ties, of their numbers, and stored with their part; neither a group
    nor a value nor a row that repeats, however common, has to fit one part. There are ``tasks``
    parts, one for every ``PART_ROWS`` rows if not given. Parts are reduced to counts per value. A
    rank is one plus the rows of lower parts plus those of lower values inside the first part that
    holds the value. Rows meet their ranks part by part. ``number`` names a stored column that
    tells the rows of a group apart; with it they are not numbered here.
    """
    groups = list(within)
    # Stored with the numbers: a task that runs again must not deal its rows out another way.
    numbered = df if number else numbered_rows(df, "_number")
    tasks = tasks or max(1, -(-numbered.count() // PART_ROWS))
    ranges = [*groups, F.asc_nulls_last(value), number or "_number"]
    dealt = numbered.repartitionByRange(tasks, *ranges).withColumn("_part", F.spark_partition_id())
    placed = stored(dealt.select(*df.columns, "_part"), "ranges")

    counts = placed.groupBy("_part", *groups, value).agg(F.count(F.lit(1)).alias("_rows"))
    inside = Window.partitionBy("_part", *groups).orderBy(F.asc_nulls_last(value))
    # At most one row per part reaches each of the next two windows.
    lower = Window.partitionBy(*groups).orderBy("_part")
    earlier = (Window.unboundedPreceding, -1)
    totals = counts.groupBy("_part", *groups).agg(F.sum("_rows").alias("_total"))
    below = totals.select(
        F.col("_part").alias("_lower_part"),
        *_renamed(groups, "_lower"),
        F.coalesce(F.sum("_total").over(lower.rowsBetween(*earlier)), F.lit(0)).alias("_below"),
    )
    before = F.col("_below") + F.coalesce(F.sum("_rows").over(inside.rowsBetween(*earlier)), F.lit(0))
    found = counts.join(
        below, (F.col("_part") == F.col("_lower_part")) & _matching(groups, "_lower")
    ).withColumn("_before", before)
    ranks = found.select(
        F.col("_part").alias("_rank_part"),
        *_renamed(groups, "_rank"),
        F.col(value).alias("_rank_value"),
        (1 + F.min("_before").over(Window.partitionBy(*groups, value))).alias(name),
    )
    same = (F.col("_part") == F.col("_rank_part")) & F.col(value).eqNullSafe(F.col("_rank_value"))
    return placed.join(ranks, same & _matching(groups, "_rank")).select(*df.columns, name)


def numbered_rows(df: DataFrame, name: str) -> DataFrame:
    """The rows, stored with numbers of their own."""
    return stored(df.withColumn(name, F.monotonically_increasing_id()), "numbered")


def _renamed(groups: Sequence[str], prefix: str) -> list[Column]:
    return [F.col(group).alias(f"{prefix}_{group}") for group in groups]


def _matching(groups: Sequence[str], prefix: str) -> Column:
    same = F.lit(True)
    for group in groups:
        same = same & F.col(group).eqNullSafe(F.col(f"{prefix}_{group}"))
    return same


def spearman_pair(df: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Correlation of the rank of ``measure`` with the rank of the group size.

    Ties share the lowest rank. Groups are formed once: each rank stores what it has read.
    """
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    ranked = rank_by_value(rank_by_value(groups, measure, "_measure_rank"), "_size", "_size_rank")
    return ranked.agg(
        null_safe_corr("_measure_rank", "_size_rank").alias("spearman_correlation")
    )


def spearman_all(
    df: DataFrame,
    key: str,
    exclude: Iterable[str],
    *,
    digits: int = 4,
    count_name: str = "purchases",
) -> DataFrame:
    """Rank correlation of every averaged column with the row count per key, strongest first.

    The count is ranked once, beside the averages, for all columns without a null; a column with
    nulls is ranked against the counts of its own rows.
    """
    wide = numbered_rows(average_all(df, key, exclude, count_name).drop(key), "_number")
    features = [name for name in wide.columns if name not in (count_name, "_number")]
    filled = wide.agg(F.count(F.lit(1)), *[F.count(F.col(f"`{name}`")) for name in features]).first()
    gaps = [name for name, rows in zip(features, filled[1:], strict=True) if rows < filled[0]]
    number = {"number": "_number"}
    # Each rank reads its input several times, so what is ranked again is stored.
    counted = stored(rank_by_value(wide, count_name, "count_rank", **number), "counted")
    long = unpivot(counted, [count_name, "count_rank", "_number"])
    ranked = rank_by_value(long, "feature_value", "feature_rank", within=["feature"], **number)
    if gaps:
        ranked = stored(ranked, "feature-ranks")
        of_gap = F.col("feature").isin(gaps)
        own = ranked.where(of_gap).drop("count_rank")
        own = rank_by_value(own, count_name, "count_rank", within=["feature"], **number)
        ranked = ranked.where(~of_gap).unionByName(own)
    correlation = F.round(null_safe_corr("feature_rank", "count_rank"), digits)
    return (
        ranked.groupBy("feature")
        .agg(correlation.alias("spearman_correlation"))
        .orderBy(F.desc(F.abs("spearman_correlation")), "feature")
    )
