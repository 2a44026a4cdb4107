import random

import pytest
from pyspark.sql import functions as F

from tableworks.operators import bitmaps
from tableworks.session import stored


@pytest.fixture(scope="module")
def rows(spark):
    """Days, a value that most rows hold, null values, and a day that has none else."""
    rng = random.Random(4)
    values = [None, "", *[f"v{n}" for n in range(400)]]
    data = [(n % 9, "common" if rng.random() < 0.5 else rng.choice(values)) for n in range(5000)]
    return spark.createDataFrame([*data, (9, None), (9, None)], "day int, v string").cache()


def counts(df, *keys):
    counted = df.groupBy(*keys).agg(F.countDistinct("v").alias("distinct")).where("distinct > 0")
    return sorted(map(tuple, counted.collect()))


def found(df):
    return sorted(map(tuple, df.collect()))


def test_counts_of_days_merge(spark, rows):
    days = bitmaps.bitmaps_by(rows, ["day"], "v", bitmaps.number_values(rows, "v"))
    assert found(bitmaps.count_bits(days, ["day"])) == counts(rows, "day")
    assert found(bitmaps.count_bits(days)) == counts(rows)
    weeks = bitmaps.merged(days, [F.floor(F.col("day") / 4).alias("week")])
    weekly = rows.withColumn("week", F.floor(F.col("day") / 4))
    assert found(bitmaps.count_bits(weeks, ["week"])) == counts(weekly, "week")


def test_many_values_take_several_blocks(spark):
    df = spark.range(0, 200_000, 1, 3).select(F.lit(1).alias("day"), (F.col("id") % 90_001).alias("v"))
    numbered = bitmaps.number_values(df, "v")
    days = bitmaps.bitmaps_by(df, ["day"], "v", numbered).cache()
    assert found(bitmaps.count_bits(days)) == [(90_001,)]
    parts = numbered.select(F.shiftright("number", 33)).distinct().count()
    # Numbers have no gaps within a task: at most two blocks of each task are part empty.
    assert days.count() <= 90_001 // 32_768 + 2 * parts


def test_day_by_day_with_a_growing_dictionary(spark, rows):
    kept, numbers = None, None
    for first in (0, 3, 6, 9):
        new = rows.where(F.col("day").between(first, first + 2))
        grown = bitmaps.number_values(new, "v", numbers)
        if numbers is not None:
            assert numbers.join(grown, ["value", "number"], "left_anti").count() == 0
        numbers = grown
        own = stored(bitmaps.bitmaps_by(new, ["day"], "v", numbers), "days")
        kept = own if kept is None else kept.unionByName(own)
    assert numbers.select("number").distinct().count() == numbers.count() == counts(rows)[0][0]
    assert found(bitmaps.count_bits(kept, ["day"])) == counts(rows, "day")
    assert found(bitmaps.count_bits(kept)) == counts(rows)


def test_rollups_read_the_bitmaps_alone(spark, rows, tmp_path):
    rows.write.parquet(f"{tmp_path}/rows")
    table = spark.read.parquet(f"{tmp_path}/rows")
    days = stored(bitmaps.bitmaps_by(table, ["day"], "v", bitmaps.number_values(table, "v")), "days")
    total = bitmaps.count_bits(days)
    assert found(total) == counts(rows)
    assert not any(str(tmp_path) in file for file in total.inputFiles())


def test_empty_tables_and_unknown_values(spark, rows):
    none = rows.limit(0)
    days = bitmaps.bitmaps_by(none, ["day"], "v", bitmaps.number_values(none, "v"))
    assert found(bitmaps.count_bits(days)) == [(0,)] and found(bitmaps.count_bits(days, ["day"])) == []
    some = bitmaps.number_values(rows.where("day < 1"), "v")
    with pytest.raises(Exception, match="lacks a value"):
        bitmaps.bitmaps_by(rows, ["day"], "v", some).collect()


def test_bits_travel_instead_of_blocks(spark):
    """A block of a period is made where its bits meet: no partial block is shuffled."""
    df = spark.range(0, 100, 1, 4).select((F.col("id") % 50).alias("day"), F.col("id").alias("v"))
    days = bitmaps.bitmaps_by(df, ["day"], "v", bitmaps.number_values(df, "v"))
    last = days._jdf.queryExecution().executedPlan().toString().split("Exchange")[0]
    assert "partial_bitmap_construct_agg" in last
    assert found(bitmaps.count_bits(days)) == [(100,)]


def test_values_of_a_period_share_blocks(spark):
    """Every value has one day: a day has few blocks, not a bit in each of them."""
    df = spark.range(0, 400_000, 1, 4).select(F.expr("CAST(xxhash64(id) % 40 AS INT)").alias("day"), F.col("id").alias("v"))
    numbered = bitmaps.number_values(df, "v", along="day")
    parts = numbered.select(F.shiftright("number", 33)).distinct().count()
    days = bitmaps.bitmaps_by(df, ["day"], "v", numbered).cache()
    every = df.select("day").distinct().count()
    blocks = days.select("block").distinct().count()
    assert days.count() <= parts * every + blocks
    assert found(bitmaps.count_bits(days, ["day"])) == counts(df, "day")
    plain = bitmaps.bitmaps_by(df, ["day"], "v", bitmaps.number_values(df, "v"))
    assert days.count() < plain.count()
