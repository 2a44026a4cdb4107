"""Exact distinct counts that merge: bitmaps of numbered values, stored by period.

A dictionary numbers the values of a column once. A period's values are then bits in blocks of 32,768,
and any union of periods is counted by merging blocks, without reading a row of the table again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored

#: A task numbers its own values from a multiple of this on.
_TASK_NUMBERS = 1 << 33


def number_values(
    df: DataFrame, column: str, known: DataFrame | None = None, *, along: str | None = None
) -> DataFrame:
    """The dictionary of ``column``: (value, number), stored. Nulls have no number.

    Each task numbers its own values without gaps, so bitmaps stay dense. With ``known``, an earlier
    dictionary, its numbers stay and only values that it lacks are numbered, above all of its own:
    bitmaps made with it remain valid. Unless some are
    known, a task numbers its values in the order of their least ``along``, the period: values that begin
    together share blocks, and a period has fewer of them.
    """
    held = df.where(F.col(column).isNotNull())
    values = held.select(F.col(column).alias("value")).distinct()
    if along is not None:
        firsts = held.groupBy(F.col(column).alias("value")).agg(F.min(along).alias("_first"))
        values = firsts.sortWithinPartitions("_first").select("value")
    if known is None:
        return stored(values.withColumn("number", F.monotonically_increasing_id()), "dictionary")
    last = known.agg(F.max("number")).first()[0]
    first = 0 if last is None else (last // _TASK_NUMBERS + 1) * _TASK_NUMBERS
    added = values.join(known, "value", "left_anti")
    numbered = added.withColumn("number", F.monotonically_increasing_id() + F.lit(first))
    return stored(known.unionByName(numbered), "dictionary")


def bitmaps_by(df: DataFrame, keys: Sequence[str], column: str, dictionary: DataFrame) -> DataFrame:
    """Per key the blocks of bits of its values of ``column``: (keys, block, bits).

    Equal values of a key become one row before they are shuffled or looked up, so a common value
    costs one row a task. Null values set no bit; a value that the dictionary lacks is an error.
    """
    own = df.select(*keys, F.col(column).alias("value")).where(F.col("value").isNotNull()).distinct()
    unknown = F.raise_error(F.lit(f"the dictionary of {column} lacks a value")).cast("long")
    number = F.coalesce("number", unknown)
    return (
        own.join(dictionary, "value", "left")
        .select(
            *keys,
            F.bitmap_bucket_number(number).alias("block"),
            F.bitmap_bit_position(number).alias("bit"),
        )
        # Places of bits travel, not blocks: a task has few bits of most blocks.
        .repartition(*keys, "block")
        .groupBy(*keys, "block")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
    )


def merged(bitmaps: DataFrame, keys: Sequence = ()) -> DataFrame:
    """Blocks of coarser keys, columns or expressions: the union of what they cover."""
    return bitmaps.groupBy(*keys, "block").agg(F.bitmap_or_agg("bits").alias("bits"))


def count_bits(bitmaps: DataFrame, keys: Sequence[str] = (), name: str = "distinct") -> DataFrame:
    """Distinct values per key. A key without a value has no blocks and no row; all keys together
    always have one row."""
    counted = F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias(name)
    return merged(bitmaps, keys).groupBy(*keys).agg(counted)
