"""Order statistics of wide frames against sorting."""

import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tableworks.functions import rolling


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.one_of(st.none(), st.integers(-3, 3), st.floats(-1e6, 1e6)), min_size=1, max_size=60),
    st.integers(1, 70),
    st.randoms(use_true_random=False),
)
def test_searched_equals_sorted(values, rows, dice):
    values = np.array([np.nan if v is None else float(v) for v in values])
    size = dice.randint(1, len(values))
    # Series begin anywhere; what precedes the batch belongs to the first or to none.
    depth, at = [], dice.randint(0, len(values) - size)
    for _ in range(size):
        depth.append(at)
        at = 0 if dice.random() < 0.1 else at + 1
    depth = np.array(depth)
    found = rolling._searched(values, depth, rows)
    for want, got in zip(rolling.median_and_mad(values, depth, rows), found, strict=True):
        assert np.array_equal(want, got, equal_nan=True)


@pytest.mark.parametrize("values", [np.ones(900), np.arange(900.0), np.full(900, np.nan)])
def test_wide_frames_of_few_values(values):
    depth = np.arange(900)
    found = rolling.median_and_mad(values, depth, 600)
    for place in (0, 1, 599, 899):
        frame = values[max(0, place - 599) : place + 1]
        middle = np.median(frame)
        want = middle, np.median(np.abs(frame - middle))
        assert np.array_equal([f[place] for f in found], want, equal_nan=True)


def test_infinite_values_are_sorted():
    values = np.r_[np.arange(400.0), np.inf, -np.inf]
    median, _ = rolling.median_and_mad(values, np.arange(402), 400)
    assert median[401] == np.median(values[2:])


def test_wide_frames_cost_little_more():
    """A frame of 10,000 rows against one of 90, over the same rows."""
    values = np.random.default_rng(1).normal(size=60_000).round(3)
    taken = {}
    for rows in (90, 10_000):
        start = time.process_time()
        rolling.median_and_mad(values, np.arange(len(values)), rows)
        taken[rows] = time.process_time() - start
    print(taken)
    assert taken[10_000] < 3 * taken[90]
