"""Column expressions shared by the operators. All of them are built-in Spark functions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The share ratios a corporate action is expected to use.
SPLIT_RATIOS = (1.5, 2.0, 3.0, 4.0, 5.0, 6.0, 8.0, 10.0, 20.0, 25.0, 50.0, 100.0, 1000.0)


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _middle_ranks(length: Column) -> tuple[Column, Column]:
    """1-based ranks of the two middle elements; they coincide when the length is odd."""
    return F.shiftright(length + 1, 1), F.shiftright(length + 2, 1)


def sorted_median(ordered: Column | str) -> Column:
    """Exact median of an array that is already ascending; null when it is empty."""
    ordered = _column(ordered)
    length = F.size(ordered)
    low, high = _middle_ranks(length)
    # get() is 0-based and null out of range, so the empty array needs no index guard.
    return F.when(length > 0, (F.get(ordered, low - 1) + F.get(ordered, high - 1)) / 2)


def array_median(values: Column | str) -> Column:
    """Exact median of a numeric array; null when it is empty."""
    return sorted_median(F.sort_array(_column(values)))


def sorted_mad(ordered: Column | str, center: Column | str) -> Column:
    """Median absolute deviation from ``center`` of an ascending array, without a second sort.

    The k elements nearest to the center are neighbours in an ascending array, so the k-th
    smallest deviation is the smallest radius among all runs of k neighbours.
    """
    ordered, center = _column(ordered), _column(center)
    length = F.size(ordered)

    def kth_deviation(k: Column) -> Column:
        runs = length - k + 1
        radii = F.zip_with(
            F.slice(ordered, F.lit(1), runs),
            F.slice(ordered, k, runs),
            lambda first, last: F.greatest(center - first, last - center),
        )
        return F.array_min(radii)

    low, high = _middle_ranks(length)
    return F.when(length > 0, (kth_deviation(low) + kth_deviation(high)) / 2)


def array_mad(values: Column | str) -> Column:
    """Median absolute deviation of a numeric array from its own median.

    The inner lambdas would sort again for every element if they captured the expression,
    so the sorted array and its median are bound to lambda variables first.
    """
    measured = F.transform(
        F.array(F.sort_array(_column(values))),
        lambda a: F.struct(a.alias("ordered"), sorted_median(a).alias("center")),
    )
    mads = F.transform(measured, lambda m: sorted_mad(m["ordered"], m["center"]))
    return F.get(mads, F.lit(0))


def signed_log(value: Column | str) -> Column:
    """Odd logarithm: ``sign(x) * ln(1 + |x|)``."""
    value = _column(value)
    return F.signum(value) * F.log1p(F.abs(value))


def match_ratio(
    raw: Column | str,
    ratios: tuple[float, ...] = SPLIT_RATIOS,
    tolerance: float = 0.03,
) -> Column:
    """Round ratio (or its inverse) within ``tolerance`` of ``raw`` on a log scale, else null.

    A ratio and its inverse have opposite logarithms, so one comparison covers both.
    """
    move = F.ln(_column(raw))
    size = F.abs(move)
    first, *others = ratios
    ratio = F.when(F.abs(size - math.log(first)) <= tolerance, F.lit(first))
    for candidate in others:
        ratio = ratio.when(F.abs(size - math.log(candidate)) <= tolerance, F.lit(candidate))
    return F.when(move < 0, 1 / ratio).otherwise(ratio)


def null_safe_corr(x: Column | str, y: Column | str) -> Column:
    """Pearson correlation aggregate that is null, not an error, when a side is constant."""
    x, y = _column(x), _column(y)
    both = x.isNotNull() & y.isNotNull()
    return F.try_divide(
        F.covar_pop(x, y),
        F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y)),
    )
