"""SentencePiece encoding with N-best segmentations, and decoding.

A text is segmented over the lattice of vocabulary pieces by the highest sum of piece scores. A
forward Viterbi pass gives every position its best score from the start; a backward A-star search
takes these as heuristics, which are exact, and pops complete segmentations in order of score.

Between two characters that stand next to each other in no piece every path has a node, so the
lattice is a chain of independent stretches. Equal stretches of a block share one forward and one
backward pass, done for all of them together, position by position. The backward pass also gives
each stretch the loss of its second-best path. Any segmentation among the N best differs from the
best one only in the N - 1 stretches of smallest loss, so the search opens these alone.

Blanks are written as U+2581, one leads the text; characters without a piece are spelt as bytes,
U+2581 itself too, so decoding gives back every text exactly.
"""

from __future__ import annotations

import functools
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .texts import as_strings, blocks, mixed, quoted

BLANK, LITERAL = 0x2581, 0x110000
#: Segmentations returned, and how much worse than the worst piece a character without one is.
N_BEST, UNKNOWN_PENALTY = 4, 10.0
#: Stretches up to this long are passed together, short ones apart; longer ones alone.
TOGETHER, SHORT = 40, 10
#: Bytes of text encoded together: every one of them takes some 60 in the tables.
BLOCK_BYTES = 1 << 19

_SLOT_BITS = 18
_BASE = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xC2B2AE3D27D4EB4F)
_WORST = -1e30

ENCODED = (
    "pieces array<int>, "
    "nbest array<struct<score:double,edits:array<struct<at:int,cut:int,put:array<int>>>>>, "
    "round_trip boolean"
)


class Vocabulary:
    """Pieces and scores in the form that the passes look up."""

    def __init__(self, pieces: list[tuple[str, float, int]], byte_ids: dict[int, int], unknown: int):
        self.byte_ids, self.unknown = byte_ids, unknown
        pieces = [(text, score, id_) for text, score, id_ in pieces if text]
        letters = sorted({letter for text, *_ in pieces for letter in text})
        self.classes = np.zeros(LITERAL + 1, np.int16)
        self.classes[[ord(letter) for letter in letters]] = np.arange(1, len(letters) + 1)
        self.together = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        self.by_text = {}
        for text, score, id_ in pieces:
            own = self.classes[[ord(letter) for letter in text]]
            self.together[own[:-1], own[1:]] = True
            self.by_text[tuple(own.tolist())] = score, id_
        self.longest = max((len(text) for text, *_ in pieces), default=1)
        worst = min((score for _, score, _ in pieces), default=0.0)
        self.unknown_score = worst - UNKNOWN_PENALTY
        # A letter that only longer pieces have gets an id of its own, which is spelt in the end.
        self.real_ids = 1 + max([unknown, *byte_ids.values(), *(id_ for *_, id_ in pieces)])
        self.stand_ins = {}
        for letter in letters:
            own = int(self.classes[ord(letter)])
            if (own,) not in self.by_text:
                self.by_text[own,] = self.unknown_score, self.real_ids + own
                self.stand_ins[self.real_ids + own] = self.spelt(ord(letter))
        self.letters = mixed(np.arange(len(letters) + 1, dtype=np.uint64) + np.uint64(77))
        self.powers = np.cumprod(np.r_[np.uint64(1), np.full(TOGETHER, _BASE)], dtype=np.uint64)
        self._slots()
        texts: list[bytes] = [b""] * self.real_ids
        for text, _, id_ in pieces:
            texts[id_] = text.replace(chr(BLANK), " ").encode()
        for value, id_ in byte_ids.items():
            texts[id_] = bytes([value])
        self.sizes = np.array([len(text) for text in texts])
        self.offsets = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)

    def _hash(self, own: tuple[int, ...]) -> np.uint64:
        value = 0
        for letter in own:
            value = (value * int(_BASE) + int(self.letters[letter])) % 2**64
        return np.uint64(value)

    def _slots(self) -> None:
        """Two places per piece; whoever is in the way moves to its other one."""
        self.keys = np.zeros(1 << _SLOT_BITS, np.uint64)
        self.scores = np.full(1 << _SLOT_BITS, _WORST, np.float64)
        self.ids = np.zeros(1 << _SLOT_BITS, np.int32)
        held = {}
        for own, found in self.by_text.items():
            entry = (int(self._hash(own)), *found)
            slot = entry[0] >> (64 - _SLOT_BITS)
            for _ in range(500):
                entry, held[slot] = held.get(slot), entry
                if entry is None:
                    break
                first = entry[0] >> (64 - _SLOT_BITS)
                second = entry[0] * int(_OTHER) % 2**64 >> (64 - _SLOT_BITS)
                slot = second if slot == first else first
            else:
                raise ValueError("the vocabulary does not fit its table")
        for slot, (key, score, id_) in held.items():
            self.keys[slot], self.scores[slot], self.ids[slot] = key, score, id_

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slots, and scores: very low where there is no such piece."""
        shift = np.uint64(64 - _SLOT_BITS)
        slot = hashes >> shift
        missed = np.flatnonzero(self.keys[slot] != hashes)
        slot[missed] = (hashes[missed] * _OTHER) >> shift
        score = self.scores[slot]
        missed = missed[self.keys[slot[missed]] != hashes[missed]]
        score[missed] = _WORST
        return slot, score

    # ------------------------------------------------------------ one stretch

    def edges(self, own: tuple[int, ...]) -> list[list[tuple[int, float, int]]]:
        """Pieces by the position where they end: (start, score, id)."""
        found = [[] for _ in range(len(own) + 1)]
        for end in range(1, len(own) + 1):
            for start in range(max(0, end - self.longest), end):
                piece = self.by_text.get(own[start:end])
                if piece:
                    found[end].append((start, *piece))
        return found

    def search(self, own: tuple[int, ...], n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The ``n`` best segmentations of a stretch of classes: scores and ids."""
        edges = self.edges(own)
        forward = [0.0] + [float("-inf")] * len(own)
        for end in range(1, len(own) + 1):
            forward[end] = max(forward[start] + score for start, score, _ in edges[end])
        found, ticket = [], 0
        # Of equal hypotheses the one nearest to the start goes first.
        open_ = [(-forward[-1], len(own), ticket, 0.0, None)]
        while open_ and len(found) < n:
            _, at, _, tail, path = heapq.heappop(open_)
            if at == 0:
                ids = []
                while path:
                    ids.append(path[0])
                    path = path[1]
                found.append((tail, tuple(ids)))
                continue
            for start, score, id_ in edges[at]:
                ticket += 1
                bound = tail + score + forward[start]
                heapq.heappush(open_, (-bound, start, ticket, tail + score, (id_, path)))
        return found

    def spelt(self, code: int) -> list[int]:
        letter = chr(BLANK if code == LITERAL else code)
        if not self.byte_ids:
            return [self.unknown]
        return [self.byte_ids[value] for value in letter.encode("utf-8", "replace")]

    # ------------------------------------------------------------ many stretches

    def passes(self, rows: np.ndarray, sizes: np.ndarray):
        """Best score, ids and loss of the second-best path of stretches of classes.

        ``rows`` is padded with zeros, longest stretches first.
        """
        count, width = rows.shape
        hashes = np.zeros((width + 1, count), np.uint64)
        for j in range(width):
            hashes[j + 1] = hashes[j] * _BASE + self.letters[rows[:, j]]
        active = np.searchsorted(-sizes, -np.arange(width + 1), "right")
        forward = np.full((width + 1, count), _WORST, np.float64)
        back = np.zeros((width + 1, count), np.int8)
        taken = np.zeros((width + 1, count), np.int32)
        forward[0] = 0
        scores = {}
        for j in range(1, width + 1):
            n = active[j]
            for size in range(1, min(j, self.longest) + 1):
                value = hashes[j, :n] - hashes[j - size, :n] * self.powers[size]
                slot, score = self.look_up(value)
                scores[j, size] = score
                total = forward[j - size, :n] + score
                better = np.flatnonzero(total > forward[j, :n])
                forward[j, better] = total[better]
                back[j, better] = size
                taken[j, better] = self.ids[slot[better]]
        every = np.arange(count)
        on_best = np.zeros((width + 1, count), bool)
        ids, n_ids = np.zeros((count, width), np.int32), np.zeros(count, np.int64)
        at, left = sizes.copy(), every
        while len(left):
            here = at[left]
            on_best[here, left] = True
            ids[left, n_ids[left]] = taken[here, left]
            n_ids[left] += 1
            at[left] = here - back[here, left]
            left = left[at[left] > 0]
        # They were met from the end.
        turned = np.maximum(n_ids[:, None] - 1 - np.arange(width)[None, :], 0)
        ids = np.take_along_axis(ids, turned, axis=1)
        backward = np.full((width + 1, count), _WORST, np.float64)
        backward[sizes, every] = 0
        second = np.full(count, _WORST, np.float64)
        for j in range(width, 0, -1):
            n = active[j]
            for size in range(1, min(j, self.longest) + 1):
                onward = scores[j, size] + backward[j, :n]
                np.maximum(backward[j - size, :n], onward, out=backward[j - size, :n])
                through = onward + forward[j - size, :n]
                through[on_best[j, :n] & (back[j, :n] == size)] = _WORST
                np.maximum(second[:n], through, out=second[:n])
        best = forward[sizes, every]
        return best, ids, n_ids, best - second

    # ------------------------------------------------------------ texts

    def encode(self, texts: list[str], n: int) -> tuple[list[np.ndarray], list[list[tuple]]]:
        """Best ids of each text, and its ``n`` best as ``(score, edits of the best ids)``."""
        joined = "".join([" " + text for text in texts if text])
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int64)
        lengths = np.array([len(text) + 1 if text else 0 for text in texts], np.int64)
        ends = np.cumsum(lengths)
        codes[codes == BLANK] = LITERAL
        codes[codes == 0x20] = BLANK
        letters = self.classes[codes]
        cut = np.ones(len(codes), bool)
        cut[1:] = ~self.together[letters[:-1], letters[1:]]
        cut[(ends - lengths)[lengths > 0]] = True
        starts = np.flatnonzero(cut)
        sizes = np.diff(np.append(starts, len(codes)))
        best, pool, first, n_ids, loss, owner, keys = self._stretches(codes, letters, starts, sizes)

        tokens = n_ids[owner]
        places = np.cumsum(tokens) - tokens
        at = np.arange(tokens.sum()) - np.repeat(places - first[owner], tokens)
        ids = pool[at]
        chunk = np.searchsorted(starts, np.append(ends - lengths, len(codes)))
        token_ends = np.append(places, len(ids))
        totals = np.concatenate([[0.0], np.cumsum(best[owner])])
        out, nbest = [], []
        for i, length in enumerate(lengths):
            low, high = chunk[i], chunk[i + 1]
            begin = token_ends[low]
            out.append(ids[begin : token_ends[high]])
            if not length:
                nbest.append([(0.0, [])])
                continue
            losses = loss[owner[low:high]]
            few = min(n - 1, len(losses))
            near = np.argpartition(losses, few - 1)[:few] if few else []
            near = sorted((int(k) for k in near if losses[k] < 1e29), key=lambda k: (losses[k], k))
            ways = [(0.0, ())]
            for k in near:
                own = owner[low + k]
                found = self._ways(keys[own], n, pool[first[own] :][: n_ids[own]])
                ways = heapq.nsmallest(
                    n,
                    [
                        (lost + found[0][0] - score, (*path, (k, other)) if other else path)
                        for lost, path in ways
                        for other, (score, _) in enumerate(found)
                    ],
                )
            total = totals[high] - totals[low]
            entries = []
            for lost, path in ways:
                edits = []
                for k, other in sorted(path):
                    own = owner[low + k]
                    put = self._ways(keys[own], n, pool[first[own] :][: n_ids[own]])[other][1]
                    edits.append((int(places[low + k] - begin), int(n_ids[own]), list(put)))
                entries.append((total - lost, edits))
            nbest.append(entries)
        return out, nbest

    @functools.lru_cache(maxsize=8192)  # noqa: B019  one vocabulary per process
    def _searched(self, own: tuple[int, ...], n: int):
        return [(score, self._spelt_out(ids)) for score, ids in self.search(own, n)]

    def _ways(self, own: tuple[int, ...], n: int, best: np.ndarray):
        """The ``n`` best of a stretch, led by the one that the forward pass chose among equals."""
        found, first = self._searched(own, n), tuple(best.tolist())
        others = [way for way in found if way[1] != first]
        return [(found[0][0], first), *others][:n]

    def _spelt_out(self, ids: tuple[int, ...]) -> tuple[int, ...]:
        if not self.stand_ins or max(ids) < self.real_ids:
            return ids
        return tuple(x for id_ in ids for x in self.stand_ins.get(id_, (id_,)))

    def _stretches(self, codes, letters, starts, sizes):
        """Each different stretch once: score, ids, loss of the second best, and who has it."""
        place = np.arange(len(codes)) - np.repeat(starts, sizes)
        power = self.powers[np.minimum(place, TOGETHER)]
        # A place has the same weight in every block, and an odd one: no letter drops out.
        far = np.flatnonzero(place >= TOGETHER)
        power[far] *= mixed(place[far].astype(np.uint64)) | np.uint64(1)
        value = self.letters[letters] * power
        bare = letters == 0
        value[bare] = mixed(codes[bare].astype(np.uint64) + np.uint64(1 << 32))
        keys = np.add.reduceat(value, starts) if len(starts) else np.zeros(0, np.uint64)
        keys = mixed(keys + sizes.astype(np.uint64) * _OTHER)
        _, example, owner = np.unique(keys, return_index=True, return_inverse=True)
        size, start = sizes[example], starts[example]
        count = len(example)
        best, loss = np.zeros(count), np.full(count, 1e30)
        n_ids = np.zeros(count, np.int64)
        is_bare = letters[start] == 0 if count else np.zeros(0, bool)
        order = np.argsort(-size, kind="stable")
        common = order[(size[order] <= TOGETHER) & ~is_bare[order]]
        pool_parts, first = [np.zeros(0, np.int32)], np.zeros(count, np.int64)
        used = 0
        # Short and long ones apart: the tables are as wide as the longest of their stretches.
        for low, high in ((0, SHORT), (SHORT, TOGETHER)):
            some = common[(size[common] > low) & (size[common] <= high)]
            if not len(some):
                continue
            width = int(size[some[0]])
            at = start[some][:, None] + np.arange(width)[None, :]
            inside = np.arange(width)[None, :] < size[some][:, None]
            rows_of = np.where(inside, letters[np.minimum(at, len(letters) - 1)], 0)
            best[some], ids, n_own, loss[some] = self.passes(rows_of, size[some])
            filled = np.arange(ids.shape[1])[None, :] < n_own[:, None]
            if (filled & (ids >= self.real_ids)).any():
                rows = [self._spelt_out(tuple(r[:k].tolist())) for r, k in zip(ids, n_own, strict=True)]
                n_own = np.array([len(row) for row in rows])
                pool_parts.append(np.array([x for row in rows for x in row], np.int32))
            else:
                pool_parts.append(ids[filled])
            n_ids[some] = n_own
            first[some] = used + np.cumsum(n_own) - n_own
            used += int(n_own.sum())
        for k in np.flatnonzero(is_bare | (size > TOGETHER)):
            if is_bare[k]:
                ids_k, best[k] = self.spelt(int(codes[start[k]])), self.unknown_score
            else:
                own = tuple(letters[start[k] : start[k] + size[k]].tolist())
                found = self.search(own, 2)
                best[k], ids_k = found[0][0], self._spelt_out(found[0][1])
                loss[k] = found[0][0] - found[1][0] if len(found) > 1 else 1e30
            n_ids[k], first[k] = len(ids_k), used
            pool_parts.append(np.array(ids_k, np.int32))
            used += len(ids_k)
        own_keys = _Keys(letters, start, size)
        return best, np.concatenate(pool_parts), first, n_ids, loss, owner, own_keys

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of a sequence of ids, without the leading blank."""
        if not len(ids):
            return b""
        sizes = self.sizes[ids]
        at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes - self.offsets[ids], sizes)
        return self.bytes[at].tobytes()[1:]


class _Keys:
    """Stretches as tuples of classes, made when asked for."""

    def __init__(self, letters, start, size):
        self.letters, self.start, self.size = letters, start, size

    def __getitem__(self, k: int) -> tuple[int, ...]:
        return tuple(self.letters[self.start[k] : self.start[k] + self.size[k]].tolist())


def load(model_path: str) -> Vocabulary:
    """The pieces of a model file; read on the driver, executors get them by broadcast."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    pieces, byte_ids = [], {}
    for id_ in range(model.get_piece_size()):
        text = model.id_to_piece(id_)
        if model.is_byte(id_):
            byte_ids[int(text[3:5], 16)] = id_
        elif not (model.is_control(id_) or model.is_unknown(id_) or model.is_unused(id_)):
            pieces.append((text, model.get_score(id_), id_))
    return Vocabulary(pieces, byte_ids, model.unk_id())


def broadcast(spark: SparkSession, model_path: str):
    return spark.sparkContext.broadcast(load(model_path))


def encode(docs: DataFrame, vocabulary, text: str = "text", n: int = N_BEST, keep_text: bool = False) -> DataFrame:
    """``docs`` with ``pieces``, ``nbest`` and ``round_trip``.

    ``nbest`` has up to ``n`` segmentations, best first; each names its score and the edits that
    turn ``pieces`` into it: at position ``at``, ``cut`` ids give way to ``put``. ``round_trip``
    tells that ``pieces`` decode to the text. Null and empty texts have no pieces and one
    segmentation of score zero. Of equal scores any may come first. The text column is left out
    unless ``keep_text``; columns with the new names give way.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    new = StructType.fromDDL(ENCODED)
    names = {name.lower() for name in new.fieldNames()}
    passed = [c for c in docs.columns if c.lower() not in names and (keep_text or c != text)]
    # Plain names on the way: those with dots cannot be passed by name.
    plain = [quoted(c).alias(f"_{k}") for k, c in enumerate(passed)]
    source = docs.select(*plain, quoted(text).cast("string").alias("_text"))
    schema = StructType([*source.schema.fields[:-1], *new.fields])
    kinds = list(to_arrow_schema(new))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = 0
            for block in blocks(batch.column(batch.num_columns - 1), BLOCK_BYTES):
                texts = as_strings(block)
                ids, nbest = vocabulary.value.encode(texts, n)
                same = [
                    vocabulary.value.decode(own) == string.encode()
                    for own, string in zip(ids, texts, strict=True)
                ]
                offsets = np.concatenate([[0], np.cumsum([len(own) for own in ids])])
                pieces = pa.ListArray.from_arrays(
                    pa.array(offsets, pa.int32()), pa.array(np.concatenate(ids), pa.int32())
                )
                ways = [
                    [
                        {"score": score, "edits": [dict(zip(("at", "cut", "put"), e, strict=True)) for e in edits]}
                        for score, edits in own
                    ]
                    for own in nbest
                ]
                kept = batch.slice(first, len(block)).columns[:-1]
                first += len(block)
                columns = [*kept, pieces.cast(kinds[0].type), pa.array(ways, kinds[1].type), pa.array(same)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return source.mapInArrow(run, schema).toDF(*passed, *new.fieldNames())


def decode(encoded: DataFrame, vocabulary, pieces: str = "pieces", into: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ``pieces``; null pieces decode to null.

    Bytes that are no text, as from ids put together by hand, become replacement characters.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(
                [
                    None if own is None else vocabulary.value.decode(np.array(own, np.int64)).decode("utf-8", "replace")
                    for own in batch.to_pylist()
                ],
                pa.string(),
            )

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return encoded.withColumn(into, F.arrow_udf(run, "string")(quoted(pieces).cast("array<int>")))
