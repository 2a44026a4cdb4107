"""Benchmark passages in documents: SimHash of item-sized windows under a Hamming index.

Words are runs of letters and digits, lower-cased; shingles are five words (a text of fewer words
is one shingle). A window has as many words as an item; a text of fewer words than an item is one
window, compared directly with the items that share a shingle with it. Other windows and items have 64-bit SimHash
fingerprints; an index over four 16-bit blocks finds every item within ``RADIUS`` bits of a
window: if two fingerprints differ in at most 20 bits then, of blocks with allowances 5, 4, 4 and
4, at least one is within its allowance. Candidates count only if the weighted Jaccard similarity
of their shingles, occurrences as weights, is ``SIMILARITY`` or more.

Two lists of equal length and that similarity share over 8/9 of their shingles. So only windows
of which so many shingles occur in some item are fingerprinted; the others cannot pass, and the
answer is the same as for all windows. Two texts at the threshold differ in 9.7 bits on average
with a deviation of 2.9, so the radius is 3.6 deviations out; closer texts differ in fewer bits.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .texts import Packed, as_strings, blocks, quoted, window_hashes, with_text_columns

SHINGLE, SIMILARITY = 5, 0.8
RADIUS, ALLOWED = 20, (5, 4, 4, 4)
#: Items looked up in one scan of the documents, by the bytes of their texts and ``ITEM_BYTES`` for
#: each; a lookup takes some five times as much memory. More items take further scans.
PASS_BYTES, ITEM_BYTES = 1 << 24, 64
#: Block values and fingerprints compared at once.
PROBES = 1 << 21
#: Positions of a document that are fingerprinted together.
STRETCH = 1 << 14

SEPARATORS = np.ones(256, bool)
SEPARATORS[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")] = False
SEPARATORS[128:] = False

MATCHES = "item_id long, similarity double, first_word long, n_words long, n_windows long"


def pack(texts: list[str]) -> Packed:
    return Packed([text.lower().encode("utf-8", "replace") for text in texts], SEPARATORS)


def shingles(words: np.ndarray) -> np.ndarray:
    return window_hashes(words, min(SHINGLE, max(1, len(words))))


def signs(hashes: np.ndarray) -> np.ndarray:
    """A row of 64 bits per hash."""
    return np.unpackbits(hashes.byteswap().view(np.uint8)).reshape(-1, 64)


def packed_bits(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=1).view(np.uint64).ravel().byteswap()


def simhash(hashes: np.ndarray) -> np.uint64:
    return packed_bits((2 * signs(hashes).sum(axis=0, dtype=np.int64) > len(hashes))[None, :])[0]


def similarity(left: np.ndarray, right: np.ndarray) -> float:
    """Weighted Jaccard similarity of two bags."""
    values, counts = np.unique(left, return_counts=True)
    others, other_counts = np.unique(right, return_counts=True)
    _, a, b = np.intersect1d(values, others, assume_unique=True, return_indices=True)
    shared = np.minimum(counts[a], other_counts[b]).sum()
    return float(shared / (len(left) + len(right) - shared))


class HammingIndex:
    """Finds the fingerprints within ``RADIUS`` bits of each query, all of them.

    Each block holds its different values in order and their owners, a few bytes a fingerprint. The
    values within a block's allowance of a query's are found by flipping bits of the query or, where
    there are fewer values than flips, by comparing it with every value.
    """

    def __init__(self, prints: np.ndarray):
        self.prints, self.tables = prints, []
        for block in range(len(ALLOWED)):
            own = self._block(prints, block)
            order = np.argsort(own, kind="stable")
            values, first = np.unique(own[order], return_index=True)
            self.tables.append((values, np.append(first, len(own)), order.astype(np.int32)))

    @staticmethod
    def _block(prints: np.ndarray, block: int) -> np.ndarray:
        return ((prints >> np.uint64(16 * block)) & np.uint64(0xFFFF)).astype(np.uint16)

    @staticmethod
    def _values(asked: np.ndarray, values: np.ndarray, allowed: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``asked`` and, beside them, in ``values`` that differ in few enough bits."""
        flips = _flips(allowed)
        if len(values) <= len(flips):
            return np.nonzero(np.bitwise_count(asked[:, None] ^ values[None, :]) <= allowed)
        probes = asked[:, None] ^ flips[None, :]
        at = np.minimum(np.searchsorted(values, probes), len(values) - 1)
        query, column = np.nonzero(values[at] == probes)
        return query, at[query, column]

    def near(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``queries`` and, beside them, in the fingerprints."""
        step = max(1, PROBES // max(len(_flips(max(ALLOWED))), len(self.prints) // 4))
        pairs = [np.zeros(0, np.int64)]
        for begin in range(0, len(queries), step):
            some = queries[begin : begin + step]
            for block, (values, first, owners) in enumerate(self.tables):
                query, value = self._values(self._block(some, block), values, ALLOWED[block])
                low, counts = first[value], first[value + 1] - first[value]
                place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts - low, counts)
                query, owner = np.repeat(query, counts), owners[place]
                close = np.bitwise_count(some[query] ^ self.prints[owner]) <= RADIUS
                pairs.append((query[close] + begin) * len(self.prints) + owner[close])
        return np.divmod(np.unique(np.concatenate(pairs)), max(1, len(self.prints)))


@functools.cache
def _flips(bits: int) -> np.ndarray:
    """All 16-bit masks of up to ``bits`` bits."""
    chosen = (c for n in range(bits + 1) for c in itertools.combinations(range(16), n))
    return np.array([sum(1 << bit for bit in bits) for bits in chosen], np.uint16)


class Benchmark:
    """Items, their shingles and fingerprints, ready to look windows up."""

    def __init__(self, item_ids: list[int], texts: list[str]):
        packed = pack(texts)
        words = packed.word_hashes()
        found = [words[packed.first[i] : packed.first[i + 1]] for i in range(len(texts))]
        held = [(item_id, len(own), shingles(own)) for item_id, own in zip(item_ids, found, strict=True) if len(own)]
        #: Of each item its id and words; the shingles of all lie one after the other.
        self.ids, self.words = [item[0] for item in held], np.array([item[1] for item in held], np.int64)
        self.first = np.cumsum([0, *(len(item[2]) for item in held)])
        self.flat = np.concatenate([np.zeros(0, np.uint64), *(item[2] for item in held)])
        lengths = np.minimum(self.words, SHINGLE)
        #: Words of a window -> its items and their index; shingle length -> these sizes.
        self.by_size, self.sizes = {}, {}
        for size in np.unique(self.words).tolist():
            own = np.flatnonzero(self.words == size)
            prints = np.array([simhash(self.shingles_of(at)) for at in own], np.uint64)
            self.by_size[size] = own, HammingIndex(prints)
            self.sizes.setdefault(min(size, SHINGLE), []).append(size)
        #: Shingle length -> all shingles in order and, beside them, the items that hold them.
        self.holders = {}
        #: Shingle length -> a sieve for them, by their leading bits.
        self.sieves = {}
        holder = np.repeat(np.arange(len(held), dtype=np.int32), np.diff(self.first))
        for k in self.sizes:
            own = np.flatnonzero(lengths[holder] == k)
            own = own[np.argsort(self.flat[own], kind="stable")]
            every = self.flat[own]
            self.holders[k] = every, holder[own]
            bits = min(24, 4 + len(every).bit_length())
            sieve = np.zeros(1 << bits, bool)
            sieve[(every >> np.uint64(64 - bits)).astype(np.int64)] = True
            self.sieves[k] = np.uint64(64 - bits), sieve

    def shingles_of(self, at: int) -> np.ndarray:
        return self.flat[self.first[at] : self.first[at + 1]]

    def is_known(self, hashes: np.ndarray, k: int) -> np.ndarray:
        (shift, sieve), every = self.sieves[k], self.holders[k][0]
        found = sieve[(hashes >> shift).astype(np.int64)]
        at = np.flatnonzero(found)
        place = np.minimum(np.searchsorted(every, hashes[at]), len(every) - 1)
        found[at] = every[place] == hashes[at]
        return found

    def windows(self, hashes: np.ndarray, known: np.ndarray, k: int) -> Iterator[tuple]:
        """``(size, first words, fingerprints)`` of all windows that can match an item."""
        marks, share = np.flatnonzero(known), 2 * SIMILARITY / (1 + SIMILARITY)
        widest = self.sizes[k][-1] - k + 1
        # A window that can match neither spans a wider gap nor starts far ahead of a mark.
        for run in np.split(marks, np.flatnonzero(np.diff(marks) > widest) + 1):
            for low in range(max(0, run[0] - widest), run[-1] + 1, STRETCH):
                high = min(low + STRETCH, run[-1] + 1)
                own = slice(low, high + widest - 1)
                upto = np.concatenate([[0], np.cumsum(known[own])])
                sums = None
                for size in self.sizes[k]:
                    count = size - k + 1
                    held = upto[count:] - upto[:-count]
                    starts = np.flatnonzero(held[: high - low] >= share * count - 1e-9)
                    if not len(starts):
                        continue
                    if sums is None:
                        sums = np.zeros((len(upto), 64), np.int32)
                        np.cumsum(signs(hashes[own]), axis=0, dtype=np.int32, out=sums[1:])
                    bits = 2 * (sums[starts + count] - sums[starts]) > count
                    yield size, starts + low, packed_bits(bits)

    def longer(self, hashes: np.ndarray, known: np.ndarray, k: int) -> Iterator[tuple[int, float]]:
        """Items of more words than a whole text, and how similar it is to them."""
        n_words = len(hashes) + k - 1
        # The shared shingles are at most the known ones, and all are at least the item's.
        most = np.count_nonzero(known) / SIMILARITY + k - 1 + 1e-9
        if not len(hashes) or not any(n_words < size <= most for size in self.sizes[k]):
            return
        every, holder = self.holders[k]
        asked = np.unique(hashes[known])
        low, high = np.searchsorted(every, asked), np.searchsorted(every, asked, "right")
        held = np.unique(np.concatenate([holder[a:b] for a, b in zip(low, high, strict=True)]))
        for at in held[(self.words[held] > n_words) & (self.words[held] <= most)].tolist():
            yield at, similarity(hashes, self.shingles_of(at))

    def matches(self, by_length: dict, marks: dict) -> dict[int, list]:
        """Item position -> [similarity, first word, words, windows] of its best window."""
        found: dict[int, list] = {}
        for k, hashes in by_length.items():
            if not marks[k].any():
                continue
            for size, starts, prints in self.windows(hashes, marks[k], k):
                own, index = self.by_size[size]
                for query, near in zip(*index.near(prints), strict=True):
                    start, at = int(starts[query]), int(own[near])
                    alike = similarity(hashes[start : start + size - k + 1], self.shingles_of(at))
                    if alike >= SIMILARITY:
                        best = found.setdefault(at, [alike, start, size, 0])
                        best[3] += 1
                        if alike > best[0]:
                            best[:3] = alike, start, size
            for at, alike in self.longer(hashes, marks[k], k):
                if alike >= SIMILARITY:
                    found[at] = [alike, 0, len(hashes) + k - 1, 1]
        return found

    def scan(self, texts: list[str]) -> Iterator[tuple[int, int, list]]:
        """``(text, item id, match)`` over a block of texts."""
        packed = pack(texts)
        words = packed.word_hashes()
        by_length = {k: window_hashes(words, k) for k in self.sizes}
        marks = {k: self.is_known(by_length[k], k) for k in self.sizes}
        hits = set()
        for mark in marks.values():
            hits |= set((np.searchsorted(packed.first, np.flatnonzero(mark), "right") - 1).tolist())
        for i in sorted(hits):
            low, high = packed.first[i], packed.first[i + 1]
            lengths = {k: v[low : max(low, high - k + 1)] for k, v in by_length.items()}
            marked = {k: v[low : max(low, high - k + 1)] for k, v in marks.items()}
            for at, match in sorted(self.matches(lengths, marked).items()):
                yield i, self.ids[at], match


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``doc_id``, ``item_id``, best ``similarity``, its ``first_word`` and ``n_words``, and
    ``n_windows``: a row for each document row and item that it repeats.

    A text of fewer words than an item is compared as a whole. Null, empty and wordless texts
    repeat nothing, and such items are repeated by nothing. Null
    ids stay null. Equal items each have their row, and so have repeated document rows. The
    benchmark is read in passes of ``PASS_BYTES``, some 60,000 items of 200 bytes; each pass scans
    the documents once.
    """
    slim = docs.select(quoted(doc_id).cast("long").alias("doc_id"), quoted(text).cast("string").alias("text"))
    found = None
    for held in _passes(benchmark, item_id, item_text):
        here = slim.mapInArrow(_scanner(held), "doc_id long, " + MATCHES)
        found = here if found is None else found.union(here)
    return found


def _passes(benchmark: DataFrame, item_id: str, item_text: str) -> Iterator:
    """Broadcast lookups of ``PASS_BYTES`` or so each; one, without items, of nothing."""
    text = F.coalesce(quoted(item_text).cast("string"), F.lit(""))
    items = benchmark.select(quoted(item_id).cast("long").alias("item_id"), text.alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + ITEM_BYTES)).first()[0] or 0
    passes = max(1, -(-size // PASS_BYTES))
    for k in range(passes):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k).collect()
        held = Benchmark([row[0] for row in rows], [row[1] for row in rows])
        yield benchmark.sparkSession.sparkContext.broadcast(held)


def _scanner(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
        names = ["doc_id", "item_id", "similarity", "first_word", "n_words", "n_windows"]
        for batch in batches:
            ids, rows, first = batch.column(0).to_pylist(), [], 0
            for block in blocks(batch.column(1)):
                texts = as_strings(block)
                rows += [(ids[first + i], item, *match) for i, item, match in held.value.scan(texts)]
                first += len(texts)
            columns = [pa.array([row[c] for row in rows], kind) for c, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _repeats(held):
    def work(texts: pa.Array) -> dict[str, np.ndarray]:
        out = np.zeros(len(texts), bool)
        for i, *_ in held.value.scan(as_strings(texts)):
            out[i] = True
        return {"_repeats_item": out}

    return work


def without_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` whose text repeats no benchmark item; same rules as above."""
    kept = docs
    for held in _passes(benchmark, item_id, item_text):
        marked = with_text_columns(kept, text, _repeats(held), "_repeats_item boolean")
        kept = marked.where("NOT _repeats_item").drop("_repeats_item")
    return kept
