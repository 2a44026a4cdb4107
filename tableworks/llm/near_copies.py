"""Near duplicates by SimHash fingerprints, linked through vantage-point trees.

Texts with the same fingerprint are one node. A tree over a bounded sample of fingerprints deals
all of them out to shards: at each inner node those within ``mu`` of the vantage point go left and
the rest go right, and, because distances obey the triangle inequality, only fingerprints up to
``radius`` beyond ``mu`` can have a partner on the left, so these visit the left side as well.
Every pair within the radius thus meets in at least one shard. Inside a shard the same split goes
on down to small leaves, where distances are compared directly.

A shard returns no pairs but, for each of its fingerprints, the smallest one it is connected to
there. Joining these stars over all shards gives the components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableworks.session import stored

from .texts import as_bytes, quoted, with_text_columns

SHINGLE, SEED = 3, 42
#: Fingerprints link up to this many differing bits.
RADIUS = 3

#: Fingerprints aimed at in a shard, most shards of the first tree, and most sampled fingerprints per
#: shard. With more fingerprints every shard of the first tree is split again by a tree of its own.
SHARD_SIZE, MAX_SHARDS, SAMPLE_PER_SHARD = 8192, 1 << 14, 64
#: Most partitions of the second shards.
MAX_PARTS = 1 << 16
#: Below this a leaf is compared directly; vantage points tried at each split.
LEAF_SIZE, VANTAGES = 512, 6
#: Leaves that no vantage point splits and that hold more than this probe by flipped bits.
DENSE_LEAF = 8192

_CHUNK = 1 << 16


# ---------------------------------------------------------------- fingerprints


def _bit_counts(shingles: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_digest
    raw = np.frombuffer(b"".join([digest(shingle, SEED) for shingle in shingles]), np.uint8)
    return np.unpackbits(raw).reshape(-1, 64).sum(axis=0, dtype=np.int64)


def fingerprint(text: bytes) -> int:
    """64 bits; a bit is set if it is set in over half of the shingles' hashes."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        return xxhash.xxh64_intdigest(joined, SEED)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts, ends = np.r_[0, gaps + 1], np.r_[gaps, len(joined)]
    starts, ends = starts[: 1 - SHINGLE].tolist(), ends[SHINGLE - 1 :].tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), _CHUNK):
        spans = zip(starts[at : at + _CHUNK], ends[at : at + _CHUNK], strict=True)
        counts += _bit_counts([joined[s:e] for s, e in spans])
    bits = np.packbits(2 * counts > len(starts))
    return int.from_bytes(bits.tobytes(), "big")


def _fingerprints(texts: pa.Array) -> dict[str, np.ndarray]:
    found = np.fromiter(map(fingerprint, as_bytes(texts)), np.uint64, len(texts))
    return {"fingerprint_bits": found.view(np.int64)}


def with_fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``fingerprint_bits``, the fingerprint as a signed long; null texts are empty."""
    return with_text_columns(docs, text, _fingerprints, "fingerprint_bits long")


# ---------------------------------------------------------------- vantage points


def best_split(points: np.ndarray, radius: int) -> tuple[np.uint64, int] | None:
    """Vantage point and ``mu`` of the cheapest split, or none if no split shrinks the work."""
    tried = points[np.linspace(0, len(points) - 1, VANTAGES).astype(int)]
    best, cost = None, 0.95 * len(points) ** 2.0
    for vantage in tried:
        upto = np.cumsum(np.bincount(np.bitwise_count(points ^ vantage), minlength=65))
        left = upto[np.minimum(np.arange(65) + radius, 64)].astype(float)
        costs = left**2 + (len(points) - upto) ** 2.0
        mu = int(costs.argmin())
        if costs[mu] < cost:
            best, cost = (vantage, mu), costs[mu]
    return best


def _dense_labels(points: np.ndarray, radius: int) -> np.ndarray:
    """Components of many mutually close fingerprints: linear in their number.

    Two of them are within the radius exactly if one, with up to half of the radius flipped,
    equals the other with the rest flipped. All that reach a key with half of the radius are
    within the radius of each other, so a key stands for one component.
    """
    near, far = _masks(radius // 2), _masks(radius - radius // 2)
    keys, key = np.unique((points[:, None] ^ near[None, :]).ravel(), return_inverse=True)
    point = np.repeat(np.arange(len(points)), len(near))
    links = [(point, key)]
    for mask in far:
        probe = points ^ mask
        at = np.minimum(np.searchsorted(keys, probe), len(keys) - 1)
        hit = np.flatnonzero(keys[at] == probe)
        links.append((hit, at[hit]))
    point, key = (np.concatenate(side) for side in zip(*links, strict=True))
    labels = np.arange(len(points))
    while True:
        by_key = np.full(len(keys), len(points))
        np.minimum.at(by_key, key, labels[point])
        found = labels.copy()
        np.minimum.at(found, point, by_key[key])
        found = found[found]
        if (found == labels).all():
            return labels
        labels = found


def _masks(flips: int) -> np.ndarray:
    masks = {0}
    for _ in range(flips):
        masks |= {mask ^ (1 << bit) for mask in masks for bit in range(64)}
    return np.array(sorted(masks), np.uint64)


def _close(points: np.ndarray, radius: int) -> Iterator[tuple[slice, np.ndarray]]:
    """Rows of the matrix that tells which points are within the radius."""
    rows = max(1, (1 << 18) // len(points))
    for at in range(0, len(points), rows):
        own = slice(at, at + rows)
        yield own, np.bitwise_count(points[own, None] ^ points[None, :]) <= radius


def _leaf_labels(points: np.ndarray, radius: int) -> np.ndarray:
    """Index of the smallest connected point, for sorted points."""
    labels = np.arange(len(points))
    if not len(points):
        return labels
    counts = np.concatenate([np.count_nonzero(near, axis=1) for _, near in _close(points, radius)])
    linked = np.flatnonzero(counts > 1)
    if not len(linked):
        return labels
    if len(linked) > DENSE_LEAF:
        labels[linked] = linked[_dense_labels(points[linked], radius)]
        return labels
    some, own = points[linked], np.arange(len(linked))
    while True:
        before, own = own, own.copy()
        for rows, near in _close(some, radius):
            own[rows] = np.where(near, before, len(some)).min(axis=1)
        own = own[own]
        if (own == before).all():
            labels[linked] = linked[own]
            return labels


def local_stars(points: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints and, for each, a smaller one it is connected to by links within the radius.

    Enough of them to connect all that are connected by links among ``points``.
    """
    froms, tos = [], []
    stack = [np.unique(points)]
    while stack:
        part = stack.pop()
        split = best_split(part, radius) if len(part) > LEAF_SIZE else None
        if split:
            distance = np.bitwise_count(part ^ split[0]).astype(int)
            stack += [part[distance <= split[1] + radius], part[distance > split[1]]]
            continue
        labels = _leaf_labels(part, radius)
        linked = np.flatnonzero(labels != np.arange(len(part)))
        froms.append(part[linked])
        tos.append(part[labels[linked]])
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *froms]), np.concatenate([none, *tos])


class VantageTree:
    """Splits over a sample; deals fingerprints out to the shards they belong to or visit."""

    def __init__(self, sample: np.ndarray, leaf: int, radius: int = RADIUS):
        self.radius, self.nodes = radius, []
        self.shards = 0
        self._grow(np.unique(sample), leaf)

    def _grow(self, points: np.ndarray, leaf: int) -> int:
        at = len(self.nodes)
        self.nodes.append(None)
        split = best_split(points, self.radius) if len(points) > max(leaf, 2) else None
        if split is None:
            self.nodes[at] = self.shards
            self.shards += 1
        else:
            distance = np.bitwise_count(points ^ split[0])
            left = self._grow(points[distance <= split[1]], leaf)
            right = self._grow(points[distance > split[1]], leaf)
            self.nodes[at] = (*split, left, right)
        return at

    def deal(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shards and points, a row for each shard that a point belongs to or visits."""
        shards, dealt = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        stack = [(0, points)]
        while stack:
            at, part = stack.pop()
            if not len(part):
                continue
            node = self.nodes[at]
            if isinstance(node, int):
                shards.append(np.full(len(part), node))
                dealt.append(part)
                continue
            vantage, mu, left, right = node
            distance = np.bitwise_count(part ^ vantage).astype(int)
            stack += [(left, part[distance <= mu + self.radius]), (right, part[distance > mu])]
        return np.concatenate(shards), np.concatenate(dealt)


# ---------------------------------------------------------------- links and components


def star_links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(a, b)``: links from fingerprints to smaller connected ones, over all shards.

    ``prints`` has distinct, non-null ``fingerprint_bits`` and is read twice: store it first.
    """
    spark = prints.sparkSession
    size, sampled = SHARD_SIZE, SAMPLE_PER_SHARD
    total = prints.count()
    shards = min(MAX_SHARDS, max(1, total // size))
    wanted = shards * sampled if shards > 1 else 0
    share = F.pmod(F.xxhash64("fingerprint_bits", F.lit(7)), F.lit(max(total, 1))) < wanted
    # About MAX_SHARDS * SAMPLE_PER_SHARD fingerprints at most, 8 MB.
    sample = prints.where(share).select("fingerprint_bits").toArrow().column(0)
    bits = sample.to_numpy().astype(np.int64).view(np.uint64)
    tree = spark.sparkContext.broadcast(VantageTree(bits, sampled, radius))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch.column(0).to_numpy().view(np.uint64)
            shard, point = tree.value.deal(points)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard), pa.array(point.view(np.int64))], ["shard", "point"]
            )

    def deal_again(shard: pa.Table) -> pa.Table:
        points = np.unique(shard.column("point").to_numpy().view(np.uint64))
        # Sorted points at even steps are as good as drawn ones: distances look at all bits.
        some = points[:: max(1, size // sampled)]
        part, point = VantageTree(some, sampled, radius).deal(points)
        first = np.full(len(part), shard.column("shard")[0].as_py())
        return pa.table({"shard": first, "part": part, "point": point.view(np.int64)})

    def link(shard: pa.Table) -> pa.Table:
        points = shard.column("point").to_numpy().view(np.uint64)
        a, b = local_stars(points, radius)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    dealt = prints.select("fingerprint_bits").mapInArrow(deal, "shard long, point long")
    # The rows are few bytes and much work: a number given here is not coalesced.
    dealt = dealt.repartition(tree.value.shards, "shard")
    keys = ["shard"]
    if total > size * MAX_SHARDS:
        keys.append("part")
        dealt = dealt.groupBy("shard").applyInArrow(deal_again, "shard long, part long, point long")
        dealt = dealt.repartition(min(MAX_PARTS, total // size), *keys)
    return dealt.groupBy(*keys).applyInArrow(link, "a long, b long").distinct()


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``(node, root)`` for every linked node; the root is the component's smallest node.

    Alternating star operations: each node's larger neighbours, then its smaller ones, are hung
    on its smallest neighbour, until nothing changes. Rounds grow with the logarithm of the
    longest path. Every round is written to the shared folder.
    """
    def edge(larger: str, smaller: str) -> Column:
        return F.struct(F.col(larger).alias("a"), F.col(smaller).alias("b"))

    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stored(ordered.where("a <> b"), name)
    state = None
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        larger = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = larger.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a")
            .select(F.explode(F.array(edge("a", "m"), edge("b", "m"))).alias("e"))
            .select("e.a", "e.b")
            .where("a <> b")
            .distinct()
        )
        edges = stored(small, name)
        summary = edges.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.count_distinct("a")
        ).first()
        if summary[0] == summary[2] and tuple(summary) == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = tuple(summary)


def fingerprint_groups(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(fingerprint_bits, root)`` for fingerprints that have links to other ones."""
    found = components(star_links(prints, radius))
    return found.select(
        F.col("node").alias("fingerprint_bits"), F.col("root")
    ).union(found.select("root", "root").distinct())


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` and ``component_id``, one row per row of ``docs``.

    The component is named by the smallest id in it. Null and empty texts have fingerprint zero
    and link like any other; repeated rows are copies; a component whose ids are all null has a
    null name.
    """
    slim = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))
    marked = stored(with_fingerprints(slim).drop("text"), "fingerprints")
    prints = stored(
        marked.groupBy("fingerprint_bits").agg(F.min("doc_id").alias("first_id")), "prints"
    )
    groups = fingerprint_groups(prints)
    rooted = prints.join(groups, "fingerprint_bits", "left").withColumn(
        "root", F.coalesce("root", "fingerprint_bits")
    )
    names = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(names, "root").select("fingerprint_bits", "component_id")
    shown = F.lower(F.lpad(F.hex("fingerprint_bits"), 16, "0")).alias("fingerprint")
    return marked.join(named, "fingerprint_bits").select("doc_id", shown, "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: the row of the smallest id of each component.

    Null ids come last; of several rows with that id one stays, chosen by text. Tasks rank their
    own rows first, so a component of any size sends one row per task.
    """
    marked = with_fingerprints(docs, text)
    prints = stored(marked.select("fingerprint_bits").distinct(), "prints")
    groups = fingerprint_groups(prints)
    root = F.coalesce("_root", "fingerprint_bits")
    renamed = groups.select(F.col("fingerprint_bits").alias("_bits"), F.col("root").alias("_root"))
    rooted = marked.join(renamed, F.col("fingerprint_bits") == F.col("_bits"), "left")
    order = [quoted(doc_id).asc_nulls_last(), quoted(text).asc_nulls_last()]
    first = F.row_number().over(Window.partitionBy(root).orderBy(*order))
    kept = rooted.withColumn("_rank", first).where("_rank = 1")
    return kept.select(*[quoted(name) for name in docs.columns])


