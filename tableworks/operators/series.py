"""Row-frame windows over series, whole or cut into runs.

An operator partitions its window by the key. All operators over the same key and order share
that partitioning and its sort, so a chain of them costs one shuffle and reads its input once.
A series whose order values are unique dates has a few hundred rows a year and stays whole.

Where one key can hold a large share of a table, ``cut_series`` cuts it first: rows are dealt out
by ranges of (key, order), and a run also receives copies of the last rows before it (the halo),
as many as the widest frame looks back, so every row of the run sees exactly the frame it would
see in the whole series. Operators notice the run column and go by (key, run); ``settle`` drops
the copies in the end. Cutting is done once per chain, and only when asked for.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rolling import add_medians
from ..session import stored

RUN, HALO = "_run", "_halo"
RUN_ROWS = 250_000


def cut_series(
    df: DataFrame,
    *,
    lookback: int,
    key: str = "ticker",
    order: str = "trade_date",
    run_rows: int = RUN_ROWS,
) -> DataFrame:
    """The rows with their run, halo copies included. Any orderable type of ``order`` will do.

    ``lookback`` is how many rows before the current one the chain of operators needs. Rows of
    equal key and order share a run, so a run is longer than ``run_rows`` only where such rows
    are. The rows are written once below the shared folder, which also fixes their runs.
    """
    runs = max(1, math.ceil(df.count() / run_rows))
    dealt = df.repartitionByRange(runs, key, order).withColumn(RUN, F.spark_partition_id())
    placed = stored(dealt, "runs")

    by_key = Window.partitionBy("_key").orderBy("_own")
    earlier = by_key.rowsBetween(Window.unboundedPreceding, -1)
    # A run has a row at least, so the halo reaches over ``lookback`` runs at most.
    later = by_key.rowsBetween(1, max(1, lookback))
    sizes = (
        placed.groupBy(F.col(key).alias("_key"), F.col(RUN).alias("_own"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_start", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .withColumn("_later", F.collect_list(F.struct("_own", "_start")).over(later))
        .where(F.size("_later") > 0)
    )
    place = F.col("_start") + F.row_number().over(Window.partitionBy(key, RUN).orderBy(order))
    needed_by = F.filter("_later", lambda run: F.col("_place") > run["_start"] - lookback)
    own = F.array(F.struct(F.col(RUN).alias(RUN), F.lit(False).alias(HALO)))
    copies = F.transform(
        needed_by, lambda run: F.struct(run["_own"].alias(RUN), F.lit(True).alias(HALO))
    )
    return (
        placed.join(sizes, F.col(key).eqNullSafe(F.col("_key")) & (F.col(RUN) == F.col("_own")), "left")
        .withColumn("_place", place)
        .select(
            *df.columns,
            F.inline(F.concat(own, F.coalesce(copies, F.array_except(own, own)))).alias(RUN, HALO),
        )
    )


def settle(framed: DataFrame) -> DataFrame:
    """Drop the halo copies and the helper columns of a cut series."""
    return framed.where(~F.col(HALO)).drop(RUN, HALO)


def is_cut(df: DataFrame) -> bool:
    return RUN in df.columns


def series_window(df: DataFrame, key: str, order: str) -> WindowSpec:
    return Window.partitionBy(*([key, RUN] if is_cut(df) else [key])).orderBy(order)


def last_rows(df: DataFrame, key: str, order: str, rows: int) -> WindowSpec:
    return series_window(df, key, order).rowsBetween(1 - rows, 0)


def running_sum(df: DataFrame, name: str, value: Column, *, key: str, order: str) -> DataFrame:
    """Sum of ``value`` from the start of the series; rows of equal order share the total.

    Runs of a cut series add up by themselves and then add the totals of the runs before them.
    """
    window = series_window(df, key, order)
    if not is_cut(df):
        return df.withColumn(name, F.sum(value).over(window))
    own = F.when(~F.col(HALO), value)
    before = Window.partitionBy("_key").orderBy("_own").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        df.groupBy(F.col(key).alias("_key"), F.col(RUN).alias("_own"))
        .agg(F.sum(own).alias("_total"))
        .select("_key", "_own", F.sum("_total").over(before).alias("_carried"))
    )
    same_run = F.col(key).eqNullSafe(F.col("_key")) & (F.col(RUN) == F.col("_own"))
    return df.join(carried, same_run, "left").select(
        *df.columns, (F.sum(own).over(window) + F.coalesce("_carried", F.lit(0))).alias(name)
    )


def rolling_medians(
    df: DataFrame, measures: Sequence[tuple[str, int, str]], *, key: str, order: str
) -> DataFrame:
    """``<prefix>_median`` and ``<prefix>_mad`` for each (column, rows, prefix).

    Spark's window functions would rebuild and sort every frame value by value; here the rows
    stream through Arrow batches and numpy sorts many frames at once. The row number asks for
    nothing but rows in the order of the window: after other operators over the series they are
    there already. Later windows would shuffle again, so call this last.
    """
    keys = [key, RUN] if is_cut(df) else [key]
    ordered = df.withColumn("_place", F.row_number().over(series_window(df, key, order)))
    added = [f"{prefix}_{name}" for _, _, prefix in measures for name in ("median", "mad")]
    schema = T.StructType(
        [*ordered.schema.fields, *[T.StructField(name, T.DoubleType()) for name in added]]
    )
    stream = partial(add_medians, keys=tuple(keys), measures=tuple(measures))
    return ordered.mapInArrow(stream, schema).drop("_place")
