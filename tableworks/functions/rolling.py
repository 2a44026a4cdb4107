"""Rolling order statistics over Arrow batches of sorted series, vectorised with numpy."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_ROWS = 4096
#: Frames of more rows are searched by ranks instead of sorted one by one; frames searched at once.
WIDE, SEARCHED_ROWS = 256, 1 << 14


def _middle(ordered: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Median of each ascending row whose first ``counts`` entries are values."""
    low, high = np.maximum(counts - 1, 0) // 2, np.minimum(counts // 2, ordered.shape[1] - 1)
    each = np.arange(len(ordered))
    return np.where(counts > 0, (ordered[each, low] + ordered[each, high]) / 2, np.nan)


class Ranked:
    """Order statistics of any stretch of a sequence of finite numbers, for many stretches at once.

    A wavelet matrix: the ranks of the values bit by bit, from the highest; at each level those
    with a zero are moved to the front, in their order. How many zeros precede a place tells where
    a stretch goes on at the next level, so a search takes one step per bit, however long it is.
    """

    def __init__(self, values: np.ndarray):
        self.values, ranks = np.unique(values, return_inverse=True)
        self.levels = []
        for bit in reversed(range(max(len(self.values) - 1, 0).bit_length())):
            ones = (ranks >> bit & 1).astype(bool)
            zeros = np.concatenate([[0], np.cumsum(~ones)]).astype(np.int32)
            self.levels.append(zeros)
            ranks = np.concatenate([ranks[~ones], ranks[ones]])

    def smallest(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The value with ``k`` smaller or equal ones before it, in each [low, high)."""
        low, high, k = (places.astype(np.int32) for places in (low, high, k))
        rank = np.zeros(len(k), np.int32)
        for zeros in self.levels:
            low_zeros, high_zeros = zeros.take(low), zeros.take(high)
            inside = high_zeros - low_zeros
            one = k >= inside
            ones_from = zeros[-1]
            low = np.where(one, low - low_zeros + ones_from, low_zeros)
            high = np.where(one, high - high_zeros + ones_from, high_zeros)
            k -= inside * one
            rank += rank
            rank += one
        return self.values[rank]


def _searched(
    values: np.ndarray, depth: np.ndarray, rows: int
) -> tuple[np.ndarray, np.ndarray]:
    """``median_and_mad`` without sorting a frame; the work for a row grows with logarithms only.

    The k smallest distances from the median belong to k neighbours in the order of values, so
    one search finds the neighbours whose farther end is nearest.
    """
    size, known = len(depth), ~np.isnan(values)
    before = np.concatenate([[0], np.cumsum(known)])
    end = np.arange(len(values) - size, len(values)) + 1
    low, high = before[np.maximum(end - np.minimum(depth + 1, rows), 0)], before[end]
    median, mad = np.full(size, np.nan), np.full(size, np.nan)
    filled = np.flatnonzero(high > low)
    ranked = Ranked(values[known])
    for start in range(0, len(filled), SEARCHED_ROWS):
        own = filled[start : start + SEARCHED_ROWS]
        first, last = low[own], high[own]
        count = last - first

        def ordered(k: np.ndarray, first=first, last=last) -> np.ndarray:
            return ranked.smallest(first, last, k)

        reach, even = (count - 1) // 2, count % 2 == 0
        center = (ordered(reach) + ordered(count // 2)) / 2
        # The first of ``reach + 1`` neighbours: the least one whose upper end is the farther.
        least, most = np.zeros_like(count), count - 1 - reach
        while (least < most).any():
            middle = (least + most) // 2
            upper = ordered(middle + reach) - center >= center - ordered(middle)
            least, most = np.where(upper, least, middle + 1), np.where(upper, middle, most)

        def farthest(at: np.ndarray) -> np.ndarray:
            ends = np.abs(ordered(at) - center), np.abs(ordered(at + reach) - center)
            return np.maximum(*ends)

        lower = np.maximum(least - 1, 0)
        here, there = farthest(least), farthest(lower)
        begin, distance = np.where(there < here, lower, least), np.minimum(here, there)
        # Of an even count the next distance is beside them, or equal to the last.
        left = np.where(begin > 0, np.abs(ordered(np.maximum(begin - 1, 0)) - center), np.inf)
        after = np.minimum(begin + reach + 1, count - 1)
        right = np.where(begin + reach + 1 < count, np.abs(ordered(after) - center), np.inf)
        second = np.maximum(distance, np.minimum(left, right))
        median[own] = center
        mad[own] = (distance + np.where(even, second, distance)) / 2
    return median, mad


def median_and_mad(
    values: np.ndarray, depth: np.ndarray, rows: int
) -> tuple[np.ndarray, np.ndarray]:
    """Exact median and MAD of the last ``rows`` entries at the last ``len(depth)`` positions.

    ``depth`` is how many entries before a position belong to the same series. NaN marks a
    missing entry and is left out; a frame without entries gives NaN. The MAD measures
    every entry of the frame against the frame's own median. Wide frames are searched, not sorted.
    """
    if rows > WIDE and not np.isinf(values).any():
        return _searched(values, depth, rows)
    size = len(depth)
    padded = np.concatenate([np.full(rows - 1, np.nan), values])
    frames = np.lib.stride_tricks.sliding_window_view(padded, rows)[-size:]
    age = np.arange(rows - 1, -1, -1)
    median, mad = np.empty(size), np.empty(size)
    for start in range(0, size, BLOCK_ROWS):
        block = slice(start, start + BLOCK_ROWS)
        own = np.where(age <= depth[block, None], frames[block], np.nan)
        ordered = np.sort(own, axis=1)
        counts = rows - np.isnan(ordered).sum(axis=1)
        median[block] = _middle(ordered, counts)
        deviations = np.abs(ordered - median[block, None])
        mad[block] = _middle(np.sort(deviations, axis=1), counts)
    return median, mad


def _repeats(column: pa.Array) -> np.ndarray:
    """Whether each entry but the first equals the one before it; nulls equal each other."""
    before, after = column.slice(0, len(column) - 1), column.slice(1)
    equal = pc.fill_null(pc.equal(before, after), False)
    both_null = pc.and_(pc.is_null(before), pc.is_null(after))
    return pc.or_(equal, both_null).to_numpy(zero_copy_only=False)


def add_medians(
    batches: Iterator[pa.RecordBatch],
    keys: Sequence[str],
    measures: Sequence[tuple[str, int, str]],
) -> Iterator[pa.RecordBatch]:
    """Append ``<prefix>_median`` and ``<prefix>_mad`` for each (column, rows, prefix).

    The batches hold whole series, contiguous and in order. Between batches only the last
    key and the last ``rows - 1`` entries of each measure are kept.
    """
    last_keys: list[pa.Array] | None = None
    last_depth = -1
    tails = {prefix: np.empty(0) for _, _, prefix in measures}
    for batch in batches:
        size = batch.num_rows
        if size == 0:
            continue
        columns = [batch.column(key) for key in keys]
        if last_keys is None:
            last_keys = [column.slice(0, 1) for column in columns]
        joined = [pa.concat_arrays(pair) for pair in zip(last_keys, columns)]
        same = np.logical_and.reduce([_repeats(column) for column in joined])
        # Depth counts up inside a series and continues the one of the previous batch.
        position = np.arange(size)
        start = np.maximum.accumulate(np.where(same, -1 - last_depth, position))
        depth = position - start

        arrays, names = list(batch.columns), list(batch.schema.names)
        for column, rows, prefix in measures:
            values = batch.column(column).cast("double").to_numpy(zero_copy_only=False)
            known = np.concatenate([tails[prefix], values])
            for name, result in zip(("median", "mad"), median_and_mad(known, depth, rows)):
                arrays.append(pa.array(result, pa.float64(), from_pandas=True))
                names.append(f"{prefix}_{name}")
            tails[prefix] = known[len(known) - min(rows - 1, len(known)) :]
        last_keys = [column.slice(size - 1, 1) for column in columns]
        last_depth = int(depth[-1])
        yield pa.RecordBatch.from_arrays(arrays, names)
