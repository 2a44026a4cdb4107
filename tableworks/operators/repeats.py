"""Rows whose key may occur more than once, found before anything is shuffled.

Two Bloom filters are built where the rows lie: bits that some key has set, and bits that were set
at least twice. They merge like sums with a carry: a bit set in two filters has been set twice. Both
bits of a key that repeats are set twice, so rows with another bit drop out at once, and an audit of
duplicates shuffles the few rows that are left instead of the table. The audit decides exactly, over
the rows that stay: a key that occurs once may stay by chance, a repeated one never goes.

The filter has ``bits`` bits whatever the table holds. Of unique keys the share that stays is about
``(1 - exp(-2 * keys / bits)) ** 2``: 3 % at ten bits a key, nearly all below one. Then the rows
go through as they are, for one more scan of the keys.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a filter, a power of two; a task holds two of them, and the finished one is broadcast.
FILTER_BITS = 1 << 27
#: Bytes of a filter that are merged as one row.
BLOCK_BYTES = 1 << 13
#: Share of bits set twice from which on the filter is not worth asking.
CROWDED = 0.7


def _key_hash(keys: Sequence[str | Column]) -> Column:
    return F.xxhash64(*keys)


def _places(hashes: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each hash, from its lowest and its highest bits."""
    own = hashes.to_numpy(zero_copy_only=False).view(np.uint64)
    mask = np.uint64(bits - 1)
    return (own & mask).astype(np.int64), (own >> np.uint64(64 - bits.bit_length() + 1)).astype(np.int64)


def _is_set(filled: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (filled[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1


def _set(filled: np.ndarray, places: np.ndarray) -> None:
    np.bitwise_or.at(filled, places >> 3, np.left_shift(1, places & 7).astype(np.uint8))


def _built(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            places, counts = np.unique(np.concatenate(_places(batch.column(0), bits)), return_counts=True)
            _set(twice, places[(counts > 1) | _is_set(seen, places)])
            _set(seen, places)
        size = min(BLOCK_BYTES, len(seen))
        for block in np.flatnonzero(seen.reshape(-1, size).any(axis=1)).tolist():
            own = slice(block * size, (block + 1) * size)
            packed = [zlib.compress(filled[own].tobytes(), 1) for filled in (seen, twice)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int32()), *(pa.array([part], pa.binary()) for part in packed)],
                ["block", "seen", "twice"],
            )

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come block after block; one block is held at a time, however many tasks filled it."""
    current = seen = twice = None

    def finished() -> Iterator[pa.RecordBatch]:
        if current is not None and twice.any():
            columns = [pa.array([current], pa.int32()), pa.array([twice.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["block", "twice"])

    for batch in batches:
        for block, *packed in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            own, again = (np.frombuffer(zlib.decompress(part), np.uint8) for part in packed)
            if block != current:
                yield from finished()
                current, seen, twice = block, np.zeros_like(own), np.zeros_like(own)
            twice = twice | again | (seen & own)
            seen = seen | own
    yield from finished()


def repeat_filter(df: DataFrame, keys: Sequence[str | Column], bits: int = FILTER_BITS) -> np.ndarray:
    """The bits that keys of ``df`` set at least twice, ``bits / 8`` bytes; reads the keys once."""
    if bits < 64 or bits & (bits - 1):
        raise ValueError("bits must be a power of two, 64 at least")
    parts = df.select(_key_hash(keys).alias("hash")).mapInArrow(_built(bits), "block int, seen binary, twice binary")
    blocks = parts.repartition("block").sortWithinPartitions("block")
    found = blocks.mapInArrow(_merged, "block int, twice binary").toArrow()
    filled = np.zeros(bits // 8, np.uint8)
    size = min(BLOCK_BYTES, len(filled))
    for block, part in zip(found.column(0).to_pylist(), found.column(1).to_pylist(), strict=True):
        filled[block * size : (block + 1) * size] = np.frombuffer(part, np.uint8)
    return filled


def possible_repeats(df: DataFrame, keys: Sequence[str | Column], bits: int = FILTER_BITS) -> DataFrame:
    """Rows of ``df`` whose key may repeat: all whose key does, and few others.

    Null keys are equal, as in grouping. ``having_dups``, ``duplicate_excess`` and ``dup_audit`` give
    the same over these rows as over all. The keys are read while this is called.
    """
    filled = repeat_filter(df, keys, bits)
    if np.bitwise_count(filled).sum(dtype=np.int64) > CROWDED * bits:
        return df
    held = df.sparkSession.sparkContext.broadcast(filled)

    def stays(hashes: pa.Array) -> pa.Array:
        low, high = _places(hashes, bits)
        return pa.array(_is_set(held.value, low) & _is_set(held.value, high))

    stays.__annotations__ = {"hashes": pa.Array, "return": pa.Array}
    return df.where(F.arrow_udf(stays, "boolean")(_key_hash(keys)))
