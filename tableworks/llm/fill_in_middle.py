"""Fill-in-middle transformation over a Roaring-style set of unit boundaries.

The ends of all units (lines) of a block of texts are kept in one set of code point offsets. Its
containers hold 65,536 consecutive values each, as a sorted array, a bitmap or runs, whichever is
smallest. Cumulative cardinalities find the container that holds the k-th boundary, and a select
inside the container gives its offset, so both cuts of every text are two lookups.

Cuts are offsets; Spark assembles the outputs from them and takes them apart again.
"""

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from .texts import as_bytes, blocks, quoted

#: Texts that hold one of these stay plain: prefix, suffix and middle.
MARKERS = ("<P>", "<S>", "<M>")

_BITS = 16
_WORDS = 1 << (_BITS - 6)


class ArrayContainer:
    """Few values: sorted, two bytes each."""

    def __init__(self, low: np.ndarray):
        self.values = low.astype(np.uint16)

    def select(self, ranks: np.ndarray) -> np.ndarray:
        return self.values[ranks].astype(np.int64)


class BitmapContainer:
    """Many scattered values: a bit for each, and the number of bits before each word."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(1 << _BITS, np.uint8)
        bits[low] = 1
        self.words = np.packbits(bits, bitorder="little").view(np.uint64)
        self.before = np.r_[0, np.cumsum(np.bitwise_count(self.words), dtype=np.int64)]

    def select(self, ranks: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.before, ranks, "right") - 1
        octets = self.words[word].view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(octets, axis=1, bitorder="little")
        nth = np.cumsum(bits, axis=1, dtype=np.int64) == (ranks - self.before[word] + 1)[:, None]
        return (word << 6) + nth.argmax(axis=1)


class RunContainer:
    """Values in a row: the first of each run, and the number of values before it."""

    def __init__(self, low: np.ndarray):
        first = np.flatnonzero(np.diff(low, prepend=-2) != 1)
        self.starts = low[first].astype(np.uint16)
        self.before = first

    def select(self, ranks: np.ndarray) -> np.ndarray:
        run = np.searchsorted(self.before, ranks, "right") - 1
        return self.starts[run] + (ranks - self.before[run])


def container(low: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest form of sorted, distinct values below 65,536."""
    runs = int(np.count_nonzero(np.diff(low, prepend=-2) != 1))
    sizes = {ArrayContainer: 2 * len(low), RunContainer: 4 * runs, BitmapContainer: 8 * _WORDS}
    return min(sizes, key=sizes.get)(low)


class BoundarySet:
    """Sorted, distinct, non-negative offsets; ``select(k)`` is the k-th of them, from 0."""

    def __init__(self, offsets: np.ndarray):
        high = offsets >> _BITS
        first = np.flatnonzero(np.diff(high, prepend=-1))
        self.keys = high[first]
        self.before = np.append(first, len(offsets))
        low = offsets & ((1 << _BITS) - 1)
        self.containers = [
            container(low[a:b]) for a, b in zip(self.before[:-1], self.before[1:], strict=True)
        ]

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, ranks: np.ndarray) -> np.ndarray:
        place = np.searchsorted(self.before, ranks, "right") - 1
        found = np.empty(len(ranks), np.int64)
        order = np.argsort(place, kind="stable")
        cuts = np.flatnonzero(np.diff(place[order])) + 1
        for some in np.split(order, cuts) if len(order) else ():
            at = place[some[0]]
            local = self.containers[at].select(ranks[some] - self.before[at])
            found[some] = (self.keys[at] << _BITS) + local
        return found


def line_cuts(texts: list[bytes], draws: Sequence[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Lines of each text, and for each draw the code points before the end of line ``draw % (n + 1)``."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    end = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    begin = np.r_[0, end[:-1]]
    ends = np.unique(np.r_[np.flatnonzero(data == 10) + 1, end[end > begin]])
    leads = ((data & 0xC0) != 0x80).view(np.uint8)
    sizes = np.add.reduceat(leads, np.r_[0, ends[:-1]], dtype=np.int64) if len(ends) else ends
    offsets = np.cumsum(sizes)
    boundaries = BoundarySet(offsets)
    first = np.searchsorted(ends, begin, "right")
    count = np.searchsorted(ends, end, "right") - first
    start = np.r_[0, offsets][first]
    cuts = []
    for draw in draws:
        unit = draw % (count + 1)
        cut = np.zeros(len(texts), np.int64)
        inside = np.flatnonzero(unit)
        cut[inside] = boundaries.select(first[inside] + unit[inside] - 1) - start[inside]
        cuts.append(cut)
    return count, cuts


def _cuts_udf():
    fields = StructType.fromDDL("n long, lower long, upper long")
    kind = to_arrow_type(fields)

    def run(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, one, two in batches:
            parts, at = [pa.array([], kind)], 0
            for block in blocks(texts):
                own = slice(at, at + len(block))
                draws = [draw.to_numpy(zero_copy_only=False)[own] for draw in (one, two)]
                count, (a, b) = line_cuts(as_bytes(block), draws)
                columns = [pa.array(c) for c in (count, np.minimum(a, b), np.maximum(a, b))]
                parts.append(pa.StructArray.from_arrays(columns, fields=list(kind)))
                at += len(block)
            yield pa.concat_arrays(parts)

    return F.arrow_udf(run, fields).asNondeterministic()


def check_markers(markers: Sequence[str]) -> None:
    """Markers have to be told apart wherever they stand: none may begin where another ends."""
    for i, a in enumerate(markers):
        for k, b in enumerate(markers):
            if not b or any(a.endswith(b[:size]) for size in range(1, len(b))) or (i != k and b in a):
                raise ValueError(f"markers {a!r} and {b!r} overlap")


def draws(key: Column, seed: int) -> list[Column]:
    """Four 32-bit numbers of a key, from the SHA-256 of the seed and the key."""
    spelt = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    digest = F.sha2(spelt, 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    seed: int = 7,
    percent: int = 100,
    spm_percent: int = 50,
    markers: Sequence[str] = MARKERS,
) -> DataFrame:
    """``docs`` with ``n`` lines, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    Of texts that can be cut, ``percent`` are, and ``spm_percent`` of these start with the suffix
    (form ``spm``), the others with the prefix (``psm``). Empty texts and texts that hold a marker
    stay ``plain``; their output is the text and their counts are null. Null texts count as empty
    and null keys as an empty key. Repeated rows get the same cuts. Columns of the same names as
    the new ones give way. There is no shuffle; a text of any length is cut whole.
    """
    check_markers(markers)
    names = ("n", "form", "prefix_chars", "middle_chars", "output")
    kept = [name for name in docs.columns if name.lower() not in names]
    packed = "_cut"
    while packed in {name.lower() for name in docs.columns}:
        packed += "_"
    whole = F.coalesce(quoted(text).cast("string"), F.lit(""))
    one, two, third, fourth = draws(quoted(key), seed)
    held = F.lit(False)
    for marker in markers:
        held = held | F.contains(whole, F.lit(marker))
    plain = (whole == "") | held | (third % 100 >= percent)
    form = F.when(plain, "plain").when(fourth % 100 < spm_percent, "spm").otherwise("psm")
    work = F.struct(
        whole.alias("text"), form.alias("form"), _cuts_udf()(whole, one, two).alias("cut")
    )
    rows = docs.select(*map(quoted, kept), work.alias(packed))
    body, shown, cut = (F.col(packed)[name] for name in ("text", "form", "cut"))
    lower, upper, size = cut["lower"].cast("int"), cut["upper"].cast("int"), F.length(body)
    prefix = F.substr(body, F.lit(1), lower)
    middle = F.substr(body, lower + 1, upper - lower)
    suffix = F.substr(body, upper + 1, size - upper)
    p, s, m = map(F.lit, markers)
    output = (
        F.when(shown == "plain", body)
        .when(shown == "spm", F.concat(s, suffix, p, prefix, m, middle))
        .otherwise(F.concat(p, prefix, s, suffix, m, middle))
    )
    return rows.select(
        *map(quoted, kept),
        cut["n"].alias("n"),
        shown.alias("form"),
        F.when(shown != "plain", cut["lower"]).alias("prefix_chars"),
        F.when(shown != "plain", cut["upper"] - cut["lower"]).alias("middle_chars"),
        output.alias("output"),
    )


def restored(output: Column, form: Column, markers: Sequence[str] = MARKERS) -> Column:
    """The text of an output, told from the output and its form alone."""
    p, s, m = markers

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        rest = F.substr(output, F.lit(len(first) + 1))
        one = F.substring_index(rest, second, 1)
        later = F.substr(rest, F.length(one) + len(second) + 1)
        two = F.substring_index(later, m, 1)
        return one, two, F.substr(later, F.length(two) + len(m) + 1)

    prefix, suffix, middle = parts(p, s)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(s, p)
    spm = F.concat(prefix, middle, suffix)
    return F.when(form == "spm", spm).when(form == "psm", psm).otherwise(output)
