"""Groups of texts whose five-word shingles have a Jaccard similarity of 0.8 or more.

Texts meet in the vantage-point trees of ``near_copies``, in two ways. Whole texts meet as they do in
that operator: by its fingerprints and its components. At a similarity of 0.8, though, a SimHash of all
shingles moves by ten bits or so, further than a search among 64 bits can reach. So a text has several
more fingerprints, each the SimHash of a small min-wise sample of its shingles: two texts draw the same
sample, and so have the same fingerprint, with a probability of the similarity to the power of the
sample's size. Over all samples a pair at 0.8 is met with a probability of 0.99, and unlike texts hardly
ever. These go through trees of their own, of a smaller radius: another sample differs by a dozen bits.

All texts that meet in a place (a component, a fingerprint or a group of samples) are candidates, and only a
similarity that is reached, shingle by shingle, makes a link. Links are joined to groups as in ``near_copies``;
so pairs of one group need no comparison any more. Each text is compared with the first and the last of a
place first, which settles places of texts that are all alike. What is left, all pairs of different groups in
a place, goes through a prefix filter: shingles are ordered from rare to common, and sets that are similar
share one of their first ones, at places that leave enough shingles behind them in both. No similar pair
fails that, whatever the order; how common a shingle is, is read from a sample, so that few others pass. Of
texts that share a rare shingle, those outside of the largest group there meet a few of that group, round by
round, and then all that are left. Texts of the same words are one node from the beginning.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableworks.session import stored

from .near_copies import components, fingerprint_groups, near_copies
from .texts import Packed, as_bytes, mixed, quoted, span_hashes, window_hashes, with_text_columns

#: Words of a shingle, and the similarity of a link in hundredths.
WORDS, SIMILARITY = 5, 80
#: Fingerprints of a text, and shingles sampled for each.
SAMPLES, SAMPLED = 10, 4
#: Fingerprints of samples meet up to this many differing bits.
SAMPLE_RADIUS = 1

#: Texts of the largest group that the others sharing a shingle meet, round by round.
PIVOTS = (16,)
#: About as many shingles are read to tell common ones from rare ones.
ORDERED_BY = 1_000_000

_TURNS = mixed(np.arange(1, SAMPLES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_CHUNK = 1 << 14
_LOWER = bytes(b + 32 if 65 <= b < 91 else b for b in range(256))


def _shingles(texts: pa.Array) -> list[tuple[int, np.ndarray]]:
    """For each text a hash of its words in order, and the sorted hashes of its different shingles.

    A text of fewer words is one shingle; without a word it has none and the hash 0.
    """
    packed = Packed([text.translate(_LOWER) for text in as_bytes(texts)])
    words = packed.word_hashes() if len(packed.starts) else np.zeros(0, np.uint64)
    found = []
    for first, last in zip(packed.first[:-1], packed.first[1:], strict=True):
        own = words[first:last]
        if not len(own):
            found.append((0, own))
            continue
        shingles = window_hashes(own, min(WORDS, len(own)))
        whole = span_hashes(own.view(np.uint8), np.array([0]), np.array([8 * len(own)]))
        found.append((int(whole.view(np.int64)[0]), np.unique(shingles)))
    return found


def fingerprints(shingles: np.ndarray) -> np.ndarray:
    """SimHashes of the min-wise samples of a set of shingles; none of an empty set."""
    if not len(shingles):
        return np.zeros(0, np.int64)
    least = np.zeros((0, SAMPLES), np.uint64)
    for at in range(0, len(shingles), _CHUNK):
        turned = mixed(shingles[at : at + _CHUNK, None] * _TURNS[None, :])
        least = np.concatenate([least, turned])
        if len(least) > SAMPLED:
            least = np.partition(least, SAMPLED - 1, axis=0)[:SAMPLED]
    # Turned hashes are as good as the shingles' own: equal samples give equal ones.
    bits = np.unpackbits(np.ascontiguousarray(least.T).view(np.uint8).reshape(SAMPLES, -1, 8), axis=2)
    over_half = 2 * bits.sum(axis=1, dtype=np.int64) > len(least)
    return np.packbits(over_half, axis=1).view(np.int64).ravel()


def _marks(texts: pa.Array) -> dict[str, list]:
    found = _shingles(texts)
    return {"node": [node for node, _ in found], "prints": [fingerprints(own) for _, own in found]}


def _sets(texts: pa.Array) -> dict[str, list]:
    found = _shingles(texts)
    return {"node": [node for node, _ in found], "shingles": [own.view(np.int64) for _, own in found]}


def met_whole(docs: DataFrame, marked: DataFrame, text: str) -> DataFrame:
    """(node, place): what each text shares with its near copies, fingerprint and component."""
    keyed = docs.select(_key(text), quoted(text).alias("text"))
    found = near_copies(keyed, "key").groupBy(F.col("doc_id").alias("key")).agg(
        F.first("fingerprint").alias("fingerprint"), F.first("component_id").alias("component")
    )
    places = [F.xxhash64(F.lit(name), F.col(name)) for name in ("fingerprint", "component")]
    known = marked.select("key", "node").distinct().join(found, "key")
    return known.select("node", F.explode(F.array(*places)).alias("place"))


def met_sampled(marked: DataFrame) -> DataFrame:
    """(node, place): groups of close fingerprints of samples."""
    texts = marked.groupBy("node").agg(F.first("prints").alias("prints"))
    prints = texts.select("node", F.explode("prints").alias("fingerprint_bits"))
    different = stored(prints.select("fingerprint_bits").distinct(), "samples")
    groups = fingerprint_groups(different, SAMPLE_RADIUS)
    place = F.coalesce("root", "fingerprint_bits").alias("place")
    return prints.join(groups, "fingerprint_bits", "left").select("node", place)


def candidate_pairs(met: DataFrame) -> DataFrame:
    """(a, b): each text with the first and the last of those in the same place, the first round."""
    ends = met.groupBy("place").agg(F.min("node").alias("first"), F.max("node").alias("last"))
    ends = ends.where(F.col("first") < F.col("last"))
    pairs = met.join(ends, "place").select("node", F.explode(F.array("first", "last")).alias("other"))
    return _ordered(pairs)


def _ordered(pairs: DataFrame) -> DataFrame:
    """Different pairs (a, b) of (node, other), the larger node first."""
    ordered = pairs.select(F.greatest("node", "other").alias("a"), F.least("node", "other").alias("b"))
    return ordered.where("a <> b").distinct()


def _several(grouped: DataFrame, place: str) -> DataFrame:
    """Of (place, root) rows the places with several roots, and the root most rows there have."""
    sizes = grouped.groupBy(place, "root").agg(F.count(F.lit(1)).alias("rows"))
    most = sizes.groupBy(place).agg(
        F.count(F.lit(1)).alias("roots"), F.max(F.struct("rows", "root"))["root"].alias("most")
    )
    return most.where("roots > 1").drop("roots")


def _rooted(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """Rows of nodes with the root of each one's group."""
    return nodes.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))


def open_nodes(met: DataFrame, links: DataFrame) -> DataFrame:
    """The texts of places that hold several groups."""
    rooted = _rooted(met, links)
    return rooted.join(_several(rooted, "place"), "place").select("node").distinct()


def rare_shingles(sets: DataFrame) -> DataFrame:
    """(node, size, left, shingle): the first shingles of each set, enough for any similar set to share one.

    A set shares at most ``left`` shingles with another one if this is the first that they share.
    """
    total = sets.agg(F.sum(F.size("shingles"))).first()[0] or 0
    share = F.pmod(F.xxhash64("node", F.lit(11)), F.lit(max(total, 1))) < ORDERED_BY
    seen = sets.where(share).select(F.explode("shingles").alias("shingle"))
    values, counts = np.unique(seen.toArrow().column(0).to_numpy().astype(np.int64), return_counts=True)
    common = sets.sparkSession.sparkContext.broadcast((values[counts > 1], counts[counts > 1]))

    def firsts(batches):
        known, often = common.value
        for batch in batches:
            size = np.diff(batch.column(1).offsets.to_numpy())
            shingles = batch.column(1).flatten().to_numpy()
            held = np.repeat(np.arange(len(size)), size)
            at = np.minimum(np.searchsorted(known, shingles), max(len(known) - 1, 0))
            counted = np.where(known[at] == shingles, often[at], 0) if len(known) else np.zeros(len(held), int)
            order = np.lexsort((shingles, counted, held))
            left = np.repeat(np.cumsum(size), size) - np.arange(len(held))
            # ``held`` is in order already: sorting moves shingles inside their sets only.
            first = 100 * left >= SIMILARITY * size[held]
            found = batch.column(0).to_numpy()[held[first]], size[held[first]], left[first], shingles[order[first]]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in found], ["node", "size", "left", "shingle"])

    return sets.select("node", "shingles").mapInArrow(firsts, "node long, size long, left long, shingle long")


def sharing_pairs(rare: DataFrame, links: DataFrame, pivots: int | None = None) -> DataFrame:
    """(a, b): pairs of different groups that may be similar, or those with ``pivots`` of the largest group.

    With m and k shingles a similarity of s hundredths takes s (m + k) / (100 + s) shared ones.
    """
    rooted = _rooted(rare, links)
    mixed_up = rooted.join(_several(rooted, "shingle"), "shingle")
    rest, other = mixed_up.where("root <> most"), mixed_up
    if pivots is not None:
        drawn = Window.partitionBy("shingle").orderBy(F.desc("left"), F.xxhash64("shingle", "node"), "node")
        other = mixed_up.where("root = most").withColumn("drawn", F.row_number().over(drawn))
        other = other.where(F.col("drawn") <= pivots).drop("drawn")
    names = {"node": "other", "root": "other_root", "size": "other_size", "left": "other_left"}
    other = other.drop("most").withColumnsRenamed(names)
    needed = SIMILARITY * (F.col("size") + F.col("other_size"))
    enough = (100 + SIMILARITY) * F.least("left", "other_left") >= needed
    found = rest.drop("most").join(other, "shingle").where(enough & (F.col("root") != F.col("other_root")))
    return _ordered(found.select("node", "other"))


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of pairs (a, b) those with a similarity of at least ``SIMILARITY`` hundredths."""
    one, two = (sets.select(F.col("node").alias(k), F.col("shingles").alias(f"of_{k}")) for k in "ab")
    shared = F.size(F.array_intersect("of_a", "of_b"))
    whole = F.size("of_a") + F.size("of_b") - shared
    return pairs.join(one, "a").join(two, "b").where(100 * shared >= SIMILARITY * whole).select("a", "b")


def similar_links(docs: DataFrame, marked: DataFrame, text: str) -> DataFrame:
    """(a, b): links of nodes with a similarity of at least ``SIMILARITY`` hundredths.

    They join all that meet and that links between any two in one place would join.
    """
    met = met_whole(docs, marked, text).unionByName(met_sampled(marked)).distinct()
    met = stored(met, "met")
    shared = met.groupBy("place").agg(F.count(F.lit(1)).alias("nodes")).where("nodes > 1").drop("nodes")
    met = stored(met.join(shared, "place").select("node", "place"), "meeting")
    every = with_text_columns(docs.select(quoted(text).alias("text")), "text", _sets, "node long, shingles array<bigint>")
    sets = every.select("node", "shingles").join(met.select("node").distinct(), "node", "left_semi")
    sets = stored(sets.groupBy("node").agg(F.first("shingles").alias("shingles")), "shingles")

    links = stored(_similar(stored(candidate_pairs(met), "pairs"), sets), "links")
    opened = stored(open_nodes(met, links), "open")
    rare = stored(rare_shingles(sets.join(opened, "node", "left_semi")), "first")
    # Shingles of one text alone lead nowhere.
    several = rare.groupBy("shingle").agg(F.count(F.lit(1)).alias("nodes")).where("nodes > 1").drop("nodes")
    rare = stored(rare.join(several, "shingle"), "rare")
    for pivots in (*PIVOTS, None):
        found = _similar(stored(sharing_pairs(rare, links, pivots), "sharing"), sets)
        links = stored(links.unionByName(found), "links")
    return links


def one_of_similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with one row for each group of similar texts: that of the smallest id.

    Null ids come last; of several rows with that id one stays, chosen by text. Null texts count as
    empty, and all texts without a word are one group. Columns and their values stay as they are.
    Words are split at blanks, A-Z in lower case. Words and shingles are compared by 64-bit hashes.
    Tasks rank their own rows first, so a group of any size sends one row per task.
    """
    slim = docs.select(_key(text), quoted(text).alias("text"))
    marked = with_text_columns(slim, "text", _marks, "node long, prints array<bigint>")
    marked = stored(marked.select("key", "node", "prints"), "prints")
    groups = components(similar_links(docs, marked, text)).select(F.col("node").alias("_member"), F.col("root").alias("_root"))
    # Rows travel as one struct, so that no input column can clash with a helper's name.
    rows = docs.select(
        F.struct(*[quoted(name) for name in docs.columns]).alias("row"),
        quoted(doc_id).alias("id"),
        quoted(text).cast("string").alias("text"),
    )
    named = with_text_columns(rows, "text", _nodes, "node long").join(groups, F.col("node") == F.col("_member"), "left")
    order = [F.col("id").asc_nulls_last(), F.col("text").asc_nulls_last()]
    place = F.row_number().over(Window.partitionBy(F.coalesce("_root", "node")).orderBy(*order))
    kept = named.withColumn("place", place).where("place = 1")
    return kept.select("row.*")


def _key(text: str) -> Column:
    """Stands for a text where fingerprints meet nodes."""
    return F.xxhash64(quoted(text).cast("string")).alias("key")


def _nodes(texts: pa.Array) -> dict[str, list]:
    return {"node": [node for node, _ in _shingles(texts)]}
