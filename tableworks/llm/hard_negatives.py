"""Hard negatives of anchors, by exact integer inner products behind an angular filter.

Every row stores its angles to a few reference directions. By the triangle inequality on the
sphere, the angles of an anchor and of a run of rows to the same reference enclose the angle between
them; its cosine times both norms, rounded outwards, encloses their score. Rows are kept sorted by
their nearest reference and their angle to it, so that runs have narrow angles. An anchor is scored
against a run only if the enclosed scores meet one of the score windows it still looks for.

A window closes from below as rows are found: once enough are known, nothing under the worst of them
can be in the result. A small hashed slice of the rows is searched first, and the bounds that it gives
hold for the rest, so tasks send little more than what is returned. Anchors are worked through in
passes of a fixed size, each against all rows; what is broadcast has that size whatever the input.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableworks.session import scratch_path, stored

from .shared import hashed_sample
from .texts import quoted

#: Reference directions, and rows they are picked from.
REFERENCES, REFERENCE_SAMPLE = 8, 1024
#: Anchors of a pass: about 9 MB for vectors of 64 components.
ANCHORS_PER_PASS = 1 << 14
#: One row in so many is searched first.
SLICE = 32

#: Rows that share one enclosure; scores held at once; found rows held before the worse ones go.
_RUN, _SCORES, _HELD = 256, 1 << 22, 1 << 20
_MOST, _LEAST = np.iinfo(np.int64).max, np.iinfo(np.int64).min
#: Angles are exact to far less than this.
_ANGLE_ERROR = 1e-6
#: Sums of integers below this are exact in doubles.
_EXACT = 2.0**52

_ROW = "vec_id long, label long, components array<bigint>, norm double, angles array<double>"


# ---------------------------------------------------------------- vectors and angles


def quantized(vectors: DataFrame, embedding: str = "embedding", scale: int = 256) -> Column:
    """A vector's components as floor(scale * x); null if it, or any component, is null or not finite."""
    values = quoted(embedding).cast("array<double>")
    whole = F.transform(values, lambda x: F.floor(x * float(scale)).cast("long"))
    infinite = (float("inf"), float("-inf"))
    odd = F.exists(values, lambda x: x.isNull() | F.isnan(x) | x.isin(*infinite))
    return F.when(~odd, whole)


def matrix(lists: pa.Array, width: int | None = None) -> np.ndarray:
    """Lists as rows of a matrix; shorter ones end in zeros."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
    sizes = np.diff(ends, prepend=0)
    width = int(sizes.max(initial=0)) if width is None else width
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(len(lists), width)
    out = np.zeros((len(lists), width), flat.dtype)
    row = np.repeat(np.arange(len(lists)), sizes)
    place = np.arange(len(flat)) - np.repeat(ends - sizes, sizes)
    inside = place < width
    out[row[inside], place[inside]] = flat[inside]
    return out


def angles(vectors: np.ndarray, norms: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Angles of rows to unit vectors; a right angle for rows of zeros."""
    width = min(vectors.shape[1], references.shape[1])
    dots = vectors[:, :width].astype(float) @ references[:, :width].T
    return np.arccos(np.clip(dots / np.maximum(norms, 1e-300)[:, None], -1.0, 1.0))


def spread_directions(vectors: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` unit vectors, each the row farthest in angle from those before it."""
    norms = np.linalg.norm(vectors.astype(float), axis=1)
    units = vectors[norms > 0] / norms[norms > 0, None]
    if not len(units):
        return np.eye(1, max(1, vectors.shape[1]))
    picked, closest = [0], units @ units[0]
    while len(picked) < min(count, len(units)):
        picked.append(int(closest.argmin()))
        closest = np.maximum(closest, units @ units[picked[-1]])
    return units[picked]


# ---------------------------------------------------------------- search of one pass


@dataclass
class Rows:
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    norms: np.ndarray
    angles: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch | pa.Table, width: int | None = None) -> "Rows":
        column = {name: batch.column(name) for name in ("vec_id", "label", "norm")}
        plain = {name: c.to_numpy(zero_copy_only=False) if isinstance(c, pa.Array) else c.to_numpy() for name, c in column.items()}
        found = matrix(batch.column("components"), width), matrix(batch.column("angles"))
        return cls(plain["vec_id"], plain["label"], found[0], plain["norm"], found[1])


@dataclass
class Search:
    """Anchors, and for each the score windows [low, high] that it looks for rows in."""

    anchors: Rows
    low: np.ndarray
    high: np.ndarray
    wanted: int
    same_label: bool

    def enclosed(self, norms: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of every anchor's scores with rows of these norms and angles."""
        own, least, most = self.anchors.angles, near.min(axis=0), near.max(axis=0)
        closest = np.maximum(own - most, least - own).max(axis=1) - _ANGLE_ERROR
        farthest = np.minimum(own + most, 2 * math.pi - own - least).min(axis=1) + _ANGLE_ERROR
        top = np.cos(np.clip(closest, 0, math.pi)) * self.anchors.norms
        bottom = np.cos(np.clip(farthest, 0, math.pi)) * self.anchors.norms
        small, large = norms.min(), norms.max()
        error = 1e-9 * self.anchors.norms * large + 0.01
        high = np.where(top > 0, top * large, top * small) + error
        low = np.where(bottom > 0, bottom * small, bottom * large) - error
        return low, high

    def meeting(self, rows: Rows, run: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Anchors with a window that the enclosed scores of a run meet."""
        least, most = self.enclosed(rows.norms[run], rows.angles[run])
        open_ = (low <= most[:, None]) & (self.high >= least[:, None]) & (low <= self.high)
        live = open_.any(axis=1)
        if self.same_label:
            live &= np.isin(self.anchors.labels, np.unique(rows.labels[run]))
        return np.flatnonzero(live)

    def scores(self, some: np.ndarray, rows: Rows, run: np.ndarray) -> np.ndarray:
        left, right = self.anchors.vectors[some], rows.vectors[run]
        if self.anchors.norms[some].max() * rows.norms[run].max() < _EXACT:
            return left.astype(float) @ right.astype(float).T
        return left @ right.T


class Found:
    """The best rows of every window so far, and what a row has to score to join them."""

    def __init__(self, search: Search):
        self.wanted, self.low = search.wanted, search.low.copy()
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.held = 0
        self.scored = 0

    def add(self, window: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if len(window):
            self.parts.append((window, score, ids))
            self.held += len(window)
        if self.held > _HELD:
            self.shrink()

    def shrink(self) -> tuple[np.ndarray, ...]:
        none = np.zeros(0, np.int64)
        window, score, ids = (np.concatenate([none, *side]) for side in (zip(*self.parts) if self.parts else ((), (), ())))
        order = np.lexsort((ids, -score, window))
        window, score, ids = window[order], score[order], ids[order]
        first = np.flatnonzero(np.diff(window, prepend=-1))
        rank = np.arange(len(window)) - np.repeat(first, np.diff(np.append(first, len(window))))
        kept = rank < self.wanted
        last = rank == self.wanted - 1
        flat = self.low.reshape(-1)
        flat[window[last]] = np.maximum(flat[window[last]], score[last])
        self.parts = [(window[kept], score[kept], ids[kept])]
        self.held = int(kept.sum())
        return self.parts[0]


def search_rows(search: Search, rows: Rows, found: Found) -> None:
    """Adds what ``rows`` hold for any window. Only runs that meet a window are scored."""
    by_angle = (rows.angles.min(axis=1), rows.angles.argmin(axis=1))
    order = np.lexsort((*by_angle, rows.labels) if search.same_label else by_angle)
    for at in range(0, len(order), _RUN):
        run = order[at : at + _RUN]
        live = search.meeting(rows, run, found.low)
        step = max(1, _SCORES // len(run))
        for some in np.split(live, range(step, len(live), step)) if len(live) else ():
            scores = search.scores(some, rows, run)
            found.scored += scores.size
            low, high = found.low[some], search.high[some]
            inside = (scores >= low.min(axis=1)[:, None]) & (scores <= high.max(axis=1)[:, None])
            i, j = np.nonzero(inside)
            a, r = some[i], run[j]
            right = (search.anchors.labels[a] == rows.labels[r]) == search.same_label
            right &= search.anchors.ids[a] != rows.ids[r]
            i, a, r, score = i[right], a[right], r[right], scores[i, j][right].astype(np.int64)
            for k in range(low.shape[1]):
                fits = (score >= low[i, k]) & (score <= high[i, k])
                found.add(a[fits] * low.shape[1] + k, score[fits], rows.ids[r[fits]])


def _best(spark: SparkSession, rows: DataFrame, search: Search) -> DataFrame:
    """(item, score, vec_id, rank): the best ``wanted`` rows of each window, windows numbered by anchor."""
    best = None
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc("vec_id"))
    for slice_ in (0, 1):
        shared = spark.sparkContext.broadcast(search)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = shared.value
            found, width = Found(own), own.anchors.vectors.shape[1]
            for batch in batches:
                if batch.num_rows:
                    search_rows(own, Rows.of(batch, width), found)
            item, score, ids = found.shrink()
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (item, score, ids)], ["item", "score", "vec_id"])

        part = rows.where(F.col("slice") == slice_).drop("slice")
        some = part.mapInArrow(run, "item long, score long, vec_id long")
        every = some if best is None else best.drop("rank").unionByName(some)
        ranked = every.withColumn("rank", F.row_number().over(order))
        best = stored(ranked.where(F.col("rank") <= search.wanted), "best")
        shared.unpersist()
        if slice_ == 0:
            # As many numbers as a pass has windows, at most.
            full = best.where(F.col("rank") == search.wanted).select("item", "score").toArrow()
            low = search.low.copy().reshape(-1)
            at = full.column("item").to_numpy()
            low[at] = np.maximum(low[at], full.column("score").to_numpy())
            search = Search(search.anchors, low.reshape(search.low.shape), search.high, search.wanted, search.same_label)
    return best


# ---------------------------------------------------------------- all passes


def prepared(rows: DataFrame, anchor: Column) -> tuple[DataFrame, DataFrame]:
    """Rows with norms and angles, sorted by nearest reference, and the anchors dealt to passes."""
    spark = rows.sparkSession
    sample = hashed_sample(rows.select("components"), REFERENCE_SAMPLE).toArrow()
    references = spread_directions(matrix(sample.column("components")), REFERENCES)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = matrix(batch.column("components"))
            norms = np.linalg.norm(vectors.astype(float), axis=1)
            found = angles(vectors, norms, references)
            nearest = found.argmin(axis=1) if len(found) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(norms),
                    pa.array(list(found), pa.list_(pa.float64())),
                    pa.array(nearest, pa.int32()),
                    pa.array(found.min(axis=1) if len(found) else norms),
                ],
                [*batch.schema.names, "norm", "angles", "nearest", "reach"],
            )

    schema = _ROW.replace(", norm", ", is_anchor boolean, slice int, norm") + ", nearest int, reach double"
    marked = rows.select(
        "vec_id",
        "label",
        "components",
        F.coalesce(anchor, F.lit(False)).alias("is_anchor"),
        F.when(F.pmod(F.xxhash64("vec_id"), F.lit(SLICE)) == 0, 0).otherwise(1).alias("slice"),
    )
    path = scratch_path(spark, "angles")
    measured = marked.mapInArrow(measure, schema)
    measured.repartitionByRange("nearest", "reach", "vec_id").write.partitionBy("slice").parquet(path)
    every = spark.read.schema(measured.schema).parquet(path)
    names = [field.split()[0] for field in _ROW.split(", ")]
    anchors = every.where("is_anchor").select(*names)
    passes = max(1, -(-anchors.count() // ANCHORS_PER_PASS))
    dealt = F.pmod(F.xxhash64("vec_id", F.lit(11)), F.lit(passes)).cast("int").alias("pass")
    path = scratch_path(spark, "anchors")
    anchors.select("*", dealt).write.partitionBy("pass").parquet(path)
    anchors = spark.read.schema(f"{_ROW}, pass int").parquet(path)
    return every.select(*names, "slice"), anchors


def hard_negatives(
    rows: DataFrame,
    anchor: Column,
    n_positives: int = 5,
    n_negatives: int = 10,
    low: int = 30,
    high: int = 90,
) -> DataFrame:
    """Rows of other labels that score between ``low`` and ``high`` percent of an anchor's positives.

    ``rows`` has ``vec_id``, ``label`` and integer ``components``; rows with a null in one of them
    take no part. Anchors are the rows where ``anchor`` is true. An anchor's positives are its first
    ``n_positives`` rows of the same label and another id; for each of them the first ``n_negatives``
    rows of another label within the window come back, with ``rank`` from 1. Higher scores come
    first, ties by smaller id. Scores are 64-bit inner products; of vectors of unequal length the
    shorter one ends in zeros. Repeated rows stand for themselves, as partners and as anchors: an
    anchor that occurs twice has its result twice. Rows that share an id are no partners of each
    other. Without anchors, or without partners, there are no rows.
    """
    spark = rows.sparkSession
    whole = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "components").na.drop()
    table, anchors = prepared(whole, anchor)
    path = scratch_path(spark, "negatives")
    schema = (
        "anchor_id long, positive_id long, rank int, negative_id long, "
        "positive_score long, negative_score long"
    )
    numbers = [row[0] for row in anchors.select("pass").distinct().collect()]
    for number in sorted(numbers):
        own = Rows.of(anchors.where(F.col("pass") == number).drop("pass").toArrow())
        count = len(own.ids)
        nothing = np.full((count, 1), _LEAST), np.full((count, 1), _MOST)
        near = _best(spark, table, Search(own, *nothing, n_positives, True)).toArrow()
        at = near.column("item").to_numpy(), near.column("rank").to_numpy() - 1
        score = np.zeros((count, n_positives), np.int64)
        partner = np.zeros((count, n_positives), np.int64)
        least, most = np.full(score.shape, _MOST), np.full(score.shape, _LEAST)
        score[at], partner[at] = near.column("score").to_numpy(), near.column("vec_id").to_numpy()
        # Whole scores n with low * p <= 100 * n <= high * p.
        least[at] = [-(-low * p // 100) for p in score[at].tolist()]
        most[at] = [high * p // 100 for p in score[at].tolist()]
        best = _best(spark, table, Search(own, least, most, n_negatives, False))
        items = pa.table(
            {
                "item": at[0] * n_positives + at[1],
                "anchor_id": own.ids[at[0]],
                "positive_id": partner[at],
                "positive_score": score[at],
            }
        )
        known = spark.createDataFrame(items, "item long, anchor_id long, positive_id long, positive_score long")
        result = best.join(known, "item").select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("vec_id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
        result.write.mode("append").parquet(path)
    if not numbers:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)
