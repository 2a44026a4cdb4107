import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tableworks.llm import hard_negatives as hn
from tableworks.llm import queries

ROWS = "vec_id long, label int, embedding array<float>"


def brute(rows, every=100):
    """The contract, row by row."""
    known = []
    for vec_id, label, vector in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        known.append((vec_id, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    out = []
    for a, label, v in known:
        if a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), b, m == label) for b, m, w in known if b != a]
        scored.sort(key=lambda s: s[:2])
        for p, b, _ in [s for s in scored if s[2]][:5]:
            fits = [(-n, c) for n, c, same in scored if not same and 30 * -p <= 100 * -n <= 90 * -p]
            out += [(a, b, k, c, -p, n) for k, (n, c) in enumerate(fits[:10], 1)]
    return sorted(out, key=str)


def mined(spark, rows, every=100):
    vectors = spark.createDataFrame(rows, ROWS)
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)
    table = vectors.select(
        "vec_id", F.coalesce(moved, F.col("label")).alias("label"), hn.quantized(vectors).alias("components")
    )
    found = hn.hard_negatives(table, F.col("vec_id") % every == 0)
    return sorted((tuple(r) for r in found.collect()), key=str)


def clustered(n, seed=5, dims=12):
    dice = np.random.default_rng(seed)
    centres = dice.normal(size=(10, dims))
    labels = dice.integers(0, 10, n)
    vectors = centres[labels] + 0.4 * dice.normal(size=(n, dims))
    return [(k, int(labels[k]), vectors[k].astype(np.float32).tolist()) for k in range(n)]


@pytest.mark.parametrize("per_pass", [1 << 14, 5])
def test_clusters_as_brute_force(spark, monkeypatch, per_pass):
    monkeypatch.setattr(hn, "ANCHORS_PER_PASS", per_pass)
    monkeypatch.setattr(hn, "_RUN", 16)
    rows = clustered(400)
    want = brute(rows, 10)
    assert want and mined(spark, rows, 10) == want


def test_table_as_brute_force(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [tuple(r) for r in vectors.select("vec_id", "label", "embedding").collect()]
    found = sorted((tuple(r) for r in queries.op12_hard_negatives(spark, "/root/testdata/sf0.001").collect()), key=str)
    assert found == brute(rows)


def test_odd_rows(spark):
    rows = clustered(60, 6, 4)
    rows += [
        (60, 1, None), (61, None, [1.0] * 4), (None, 1, [1.0] * 4), (100, 2, [0.0] * 4), (70, 3, []),
        (71, 3, [1.0, float("nan"), 0.0, 0.0]), (72, 3, [float("inf")] * 4), (73, 3, [None, 1.0, 1.0, 1.0]),
        (20, 4, [2.0, 1.0]), (30, 4, [1.0] * 9), (-7, -1, [0.5] * 4), (74, 12, [0.5] * 4), (700, 9, [1.0, 0.5, 0.0, 0.0]),
    ]
    # Repeated rows and tied scores.
    rows += [rows[0], rows[0], rows[10], rows[13], *[(k, k % 3, [1.0, 1.0, 0.0, 0.0]) for k in range(200, 260)]]
    want = brute(rows, 10)
    assert want and mined(spark, rows, 10) == want


def test_large_components_are_exact(spark):
    rows = [(k, k % 2, [float(2**17 + k), float(3**12 - k), 1.0 + k]) for k in range(20)]
    rows = [(i, m, [x * 2**6 for x in v]) for i, m, v in rows]
    assert mined(spark, rows, 5) == brute(rows, 5)


@pytest.mark.parametrize("rows", [[], [(1, 1, [1.0])], [(100, 1, [1.0])], [(None, None, None)]])
def test_no_result(spark, rows):
    assert mined(spark, rows) == []


def batch(vectors, labels, references):
    norms = np.linalg.norm(vectors, axis=1)
    return hn.Rows(np.arange(len(vectors)), labels, vectors, norms, hn.angles(vectors, norms, references))


def test_enclosures_hold_every_score():
    dice = np.random.default_rng(8)
    vectors = dice.integers(-300, 300, (600, 8))
    vectors[:300] = vectors[0] + dice.integers(-9, 9, (300, 8))
    vectors[5] = 0
    references = hn.spread_directions(vectors, 6)
    rows = batch(vectors, np.zeros(600, int), references)
    search = hn.Search(rows, np.zeros((600, 1)), np.zeros((600, 1)), 1, False)
    for run in (np.arange(300), np.arange(300, 600), np.array([5]), np.array([7])):
        low, high = search.enclosed(rows.norms[run], rows.angles[run])
        scores = vectors @ vectors[run].T
        assert (low[:, None] <= scores).all() and (scores <= high[:, None]).all()


def test_only_meeting_runs_are_scored():
    """Tight clusters: most pairs are never multiplied, and the result is the same."""
    dice = np.random.default_rng(9)
    centres = np.round(dice.normal(size=(8, 16)) * 500)
    label = np.repeat(np.arange(8), 512)
    vectors = (centres[label] + dice.integers(-12, 12, (4096, 16))).astype(np.int64)
    rows = batch(vectors, label, hn.spread_directions(vectors, 8))
    anchors = hn.Rows(*(getattr(rows, f)[::64] for f in ("ids", "labels", "vectors", "norms", "angles")))
    low = (0.98 * anchors.norms**2).astype(np.int64)[:, None]
    search = hn.Search(anchors, low, np.full((64, 1), hn._MOST), 3, False)
    found = hn.Found(search)
    hn.search_rows(search, rows, found)
    assert found.scored < 0.3 * 64 * 4096
    scores = anchors.vectors @ vectors.T
    other = anchors.labels[:, None] != label[None, :]
    want = int(np.minimum(((scores >= low) & other).sum(axis=1), 3).sum())
    assert len(found.shrink()[0]) == want


def test_matrix_of_ragged_lists():
    lists = pa.array([[1, 2, 3], [], [4], [5, 6]])
    assert hn.matrix(lists).tolist() == [[1, 2, 3], [0, 0, 0], [4, 0, 0], [5, 6, 0]]
    assert hn.matrix(lists.slice(2), 1).tolist() == [[4], [5]]
    assert hn.matrix(lists.slice(0, 0)).shape == (0, 0)
