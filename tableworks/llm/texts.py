"""Work on whole texts inside Arrow batches: blocks, words, lines and hashes by numpy.

A null text counts as empty everywhere. Blocks bound what numpy holds at once; a text is never
cut, so the largest single text sets the rest of the bound.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

#: Bytes of text worked on together.
BLOCK_BYTES = 1 << 21


def byte_set(characters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table


#: Word separators: blank, and 0x09 to 0x0D.
WHITE = byte_set(b" \t\n\x0b\x0c\r")


def quoted(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def blocks(texts: pa.Array, most: int = BLOCK_BYTES) -> Iterator[pa.Array]:
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    first = 0
    while first < len(texts):
        base = ends[first] - sizes[first]
        last = max(first + 1, int(np.searchsorted(ends, base + most, "right")))
        yield texts.slice(first, last - first)
        first = last


def as_bytes(texts: pa.Array) -> list[bytes]:
    kind = pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()
    return [text or b"" for text in texts.cast(kind).to_pylist()]


def as_strings(texts: pa.Array) -> list[str]:
    return [text or "" for text in texts.to_pylist()]


def text_udf(work: Callable[[pa.Array], dict], schema: str):
    """A text column to a struct. ``work`` gets a block and returns one sequence per field.

    Marked as non-deterministic so that no filter above makes Spark run it a second time.
    """
    fields = StructType.fromDDL(schema)
    kind = to_arrow_type(fields)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [pa.array([], kind)]
            for block in blocks(texts):
                found = work(block)
                columns = [pa.array(found[f.name], f.type) for f in kind]
                parts.append(pa.StructArray.from_arrays(columns, fields=list(kind)))
            yield pa.concat_arrays(parts)

    return F.arrow_udf(run, fields).asNondeterministic()


def with_text_columns(
    df: DataFrame, column: str, work: Callable[[pa.Array], dict], schema: str
) -> DataFrame:
    """``df`` and the fields of ``schema``; input columns of the same names give way."""
    names = StructType.fromDDL(schema).fieldNames()
    new = {name.lower() for name in names}
    kept = [quoted(name) for name in df.columns if name.lower() not in new]
    packed = "_found"
    while packed in new or packed in {name.lower() for name in df.columns}:
        packed += "_"
    found = text_udf(work, schema)(quoted(column).cast("string")).alias(packed)
    return df.select(*kept, found).select(*kept, *[F.col(packed)[n].alias(n) for n in names])


_random = np.random.default_rng(20_240_901)
_LETTERS = _random.integers(0, 2**64, 256, np.uint64)
_ODD = _random.integers(0, 2**63, 2, np.uint64) * np.uint64(2) + np.uint64(1)
_PIECE = 1 << 16
_NEAR = np.cumprod(np.r_[np.uint64(1), np.full(_PIECE - 1, _ODD[0])], dtype=np.uint64)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def mixed(values: np.ndarray) -> np.ndarray:
    """Every bit of a 64-bit value made to depend on all of them."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def apart(values: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """Values that are equal only within the same group."""
    return values + mixed((groups.astype(np.uint64) + np.uint64(1)) * _SPREAD)


def _long_hash(data: np.ndarray) -> np.uint64:
    total, far = np.uint64(0), 1
    for at in range(0, len(data), _PIECE):
        piece = data[at : at + _PIECE]
        near = (_LETTERS[piece] * _NEAR[: len(piece)]).sum(dtype=np.uint64)
        total = np.uint64((int(total) + int(near) * far) % 2**64)
        far = far * int(_ODD[1]) % 2**64
    return total


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes of sorted spans, none of them empty."""
    out, sizes = np.empty(len(starts), np.uint64), ends - starts
    reach = np.cumsum(sizes)
    first = 0
    while first < len(starts):
        base = reach[first] - sizes[first]
        last = max(first + 1, int(np.searchsorted(reach, base + (1 << 19), "right")))
        if sizes[first] > _PIECE:
            out[first] = _long_hash(data[starts[first] : ends[first]])
            first += 1
            continue
        if (longer := np.flatnonzero(sizes[first:last] > _PIECE)).size:
            last = first + int(longer[0])
        size = sizes[first:last]
        begin = np.cumsum(size) - size
        place = np.arange(begin[-1] + size[-1]) - np.repeat(begin, size)
        value = _LETTERS[data[place + np.repeat(starts[first:last], size)]] * _NEAR[place]
        out[first:last] = np.add.reduceat(value, begin)
        first = last
    return mixed(out + sizes.astype(np.uint64) * _SPREAD)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Ordered hashes of all runs of ``size`` values."""
    count = max(0, len(hashes) - size + 1)
    out, factor = np.zeros(count, np.uint64), 1
    for k in range(size):
        factor = factor * int(_ODD[1]) % 2**64
        out += hashes[k : k + count] * np.uint64(factor)
    return mixed(out)


class Packed:
    """Texts as one byte array, a line feed before, between and after them.

    ``begin``/``end`` bound the texts, ``starts``/``ends`` the words; the words of text ``i``
    are those from ``first[i]`` to ``first[i + 1]``.
    """

    def __init__(self, texts: list[bytes], separators: np.ndarray = WHITE):
        self.data = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.end = np.cumsum(sizes + 1)
        self.begin = self.end - sizes
        self.separator = separators[self.data]
        gaps = np.flatnonzero(self.separator)
        starts, ends = gaps[:-1] + 1, gaps[1:]
        full = ends > starts
        self.starts, self.ends = starts[full], ends[full]
        self.first = np.searchsorted(self.starts, np.append(self.begin, len(self.data)))

    def counts(self, mask: np.ndarray) -> np.ndarray:
        """Marked bytes of each text."""
        places = np.flatnonzero(mask)
        return np.searchsorted(places, self.end) - np.searchsorted(places, self.begin)

    def word_texts(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.begin)), np.diff(self.first))

    def word_hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Masks of the keys that occur more than once, and of those after the first."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    later, any_ = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:][same]] = True
    any_[order[1:][same]] = any_[order[:-1][same]] = True
    return any_, later
