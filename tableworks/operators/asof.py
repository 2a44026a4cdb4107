"""As-of joins: each row with the last (or the next) row of another table along an order.

Rows of a key lie in the order of the point, those of the other side among them, and the last value
seen is carried forward. A key of few rows, a part's at most, is one window: its rows are shuffled
once. A larger key is cut into parts by ranges of (key, point, row), and what a part ends with is
carried over its border. So neither a key nor a point, however common, has to fit one task, no row
meets more than one row of the other side, and nothing is multiplied by days, years or buckets.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from . import ranks


def asof_join(
    left: DataFrame,
    right: DataFrame,
    *,
    by: Sequence[str],
    on: tuple[str, str],
    values: Sequence[str],
    forward: bool = False,
    strict: bool = False,
    tasks: int | None = None,
    number: str | None = None,
) -> DataFrame:
    """Rows of ``left`` with ``values`` of the nearest row of ``right`` that has the same key.

    ``on`` names the points of left and right. The nearest row is the last one at or before the
    left point, or with ``forward`` the first one at or after it; ``strict`` leaves out a row at the
    same point. Of right rows of one key and point the one whose values are greatest counts, in
    the order of ``values``. A left row without such a row has nulls, and so have rows whose key or
    point is null: as in an equality join, nulls never meet, and these rows stay where they are.
    Values are orderable types, and none may be named like a left column. A part has at most
    ``ranks.PART_ROWS`` rows, or if ``tasks`` is given as many as ``tasks`` parts of all rows have;
    keys of more rows are cut. The left rows, the steps of the right and, of keys that are cut, all
    rows with their part are stored while this is called. ``number`` names a column of stored left
    rows that tells them apart; with it they are not stored here, and the result is without it.
    """
    keys, (own_point, other_point) = list(by), on
    columns = [name for name in left.columns if name != number]
    clashing = set(values) & set(columns)
    if clashing:
        raise ValueError(f"columns of both sides: {sorted(clashing)}")
    # Stored with numbers: a task that runs again must not deal its rows out another way.
    numbered = left if number else ranks.numbered_rows(left, "_number")
    known = right.where(_present([*keys, other_point]))
    steps = known.groupBy(*keys, F.col(other_point).alias("_point")).agg(
        F.max(F.struct(*values)).alias("_values")
    )
    steps = stored(steps, "steps")
    meeting = _present([*keys, own_point])
    own_rows = numbered.where(meeting)
    alone = numbered.where(~meeting)

    groups = [f"_by_{place}" for place in range(len(keys))]
    # A key or point of one type on both sides is laid in order as it is and moves once.
    types = {key: (group, steps.schema[key]) for key, group in zip(keys, groups)}
    types |= {own_point: ("_point", steps.schema["_point"])}
    laid_as = {
        name: place for name, (place, field) in types.items()
        if left.schema[name].dataType == field.dataType
    }
    packed = [name for name in columns if name not in laid_as] or columns
    # At one point the row that is taken comes first; a strict join looks before the point.
    right_side, left_side = (1, 0) if strict else (0, 1)

    def laid(own_rows: DataFrame, steps: DataFrame) -> DataFrame:
        own = own_rows.select(
            *[F.col(key).alias(group) for key, group in zip(keys, groups)],
            F.col(own_point).alias("_point"),
            F.lit(left_side).alias("_side"),
            F.col(number or "_number").alias("_number"),
            F.lit(None).cast(steps.schema["_values"].dataType).alias("_values"),
            F.struct(*packed).alias("_row"),
        )
        other = steps.select(
            *[F.col(key).alias(group) for key, group in zip(keys, groups)],
            "_point",
            F.lit(right_side).alias("_side"),
            F.lit(None).cast("long").alias("_number"),
            "_values",
            F.lit(None).cast(own.schema["_row"].dataType).alias("_row"),
        )
        return own.unionByName(other)

    def as_left(rows: DataFrame, found: Column) -> DataFrame:
        return rows.where(F.col("_side") == left_side).select(
            *[
                (F.col("_row")[name] if name in packed else F.col(laid_as[name])).alias(name)
                for name in columns
            ],
            *[found[name].alias(name) for name in values],
        )

    along = F.desc("_point") if forward else F.asc("_point")
    latest = F.last("_values", ignorenulls=True)
    so_far = (Window.unboundedPreceding, 0)
    nulls = [F.lit(None).cast(steps.schema["_values"].dataType[name].dataType).alias(name) for name in values]
    unmet = alone.select(*columns, *nulls)

    part_rows = ranks.PART_ROWS
    if tasks:
        part_rows = max(1, -(-(numbered.count() + steps.count()) // tasks))
    both = own_rows.select(*keys).unionByName(steps.select(*keys))
    sizes = both.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    # Fewer than there are parts.
    large = stored(sizes.where(F.col("_rows") > part_rows), "large-keys")
    large_rows = large.agg(F.sum("_rows")).first()[0]

    def apart(rows: DataFrame, how: str) -> DataFrame:
        return rows.join(F.broadcast(large.select(*keys)), keys, how) if large_rows else rows

    whole = laid(apart(own_rows, "left_anti"), apart(steps, "left_anti"))
    in_key = Window.partitionBy(*groups).orderBy(along, "_side").rowsBetween(*so_far)
    met = as_left(whole.drop("_number").withColumn("_seen", latest.over(in_key)), F.col("_seen"))
    if not large_rows:
        return met.unionByName(unmet)

    cut = laid(apart(own_rows, "left_semi"), apart(steps, "left_semi"))
    parts = -(-large_rows // part_rows)
    dealt = cut.repartitionByRange(parts, *groups, along, "_side", "_number").drop("_number")
    placed = stored(dealt.withColumn("_part", F.spark_partition_id()), "asof")
    inside = Window.partitionBy("_part", *groups).orderBy(along, "_side").rowsBetween(*so_far)
    seen = placed.withColumn("_seen", latest.over(inside))
    # One row for each part of a key: what the part ends with.
    step_point = F.when(F.col("_values").isNotNull(), F.col("_point"))
    end = (F.min_by if forward else F.max_by)("_values", step_point)
    borders = placed.groupBy("_part", *groups).agg(end.alias("_end"))
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = borders.select(
        F.col("_part").alias("_carried_part"),
        *[F.col(group).alias(f"_carried{group}") for group in groups],
        F.last("_end", ignorenulls=True).over(before).alias("_carried"),
    ).where(F.col("_carried").isNotNull())
    same = F.col("_part") == F.col("_carried_part")
    for group in groups:
        same = same & (F.col(group) == F.col(f"_carried{group}"))
    found = F.coalesce("_seen", "_carried")
    return met.unionByName(as_left(seen.join(carried, same, "left"), found)).unionByName(unmet)


def _present(names: Sequence[str]) -> Column:
    return reduce(and_, (F.col(name).isNotNull() for name in names))
