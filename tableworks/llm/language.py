"""Language identification with hyperdimensional profiles.

Every letter has a random vector of signs. A letter trigram is the product of its letters'
vectors, each permuted (rolled) by its distance from the end; a text is the sum, or bundle, of its
trigrams; a language is the bundle of all its training texts. The language of a text is the one
whose bundle has the largest cosine with the text's.

Bundles are sums, so training counts trigrams by language in every task and adds the counts up;
all training rows count.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .texts import as_strings, blocks, quoted, with_text_columns

#: Components of a vector; letters, with 0 for all that are none; languages of a page.
DIMENSIONS, LETTERS, PAGE = 1024, 96, 1000
#: Texts bundled together, and code points of a text counted together.
TOGETHER, STRETCH = 96, 1 << 20
UNKNOWN = "und"

PREDICTED = "lang_pred string, score double"


@functools.cache
def letter_numbers() -> np.ndarray:
    """Code point -> letter: a to z, then hashed numbers for other letters, cases alike."""
    numbers = np.zeros(0x110000, np.uint8)
    for code in range(0x110000):
        letter = chr(code)
        if letter.isalpha():
            lower = letter.lower()
            own = ord(lower) if len(lower) == 1 else code
            small = ord("a") <= own <= ord("z")
            numbers[code] = own - 96 if small else 27 + (own * 2654435761 >> 7) % (LETTERS - 27)
    return numbers


@functools.cache
def _vectors() -> list[np.ndarray]:
    signs = np.random.default_rng(4).integers(0, 2, (LETTERS, DIMENSIONS)) * 2 - 1
    return [np.roll(signs, by, axis=1).astype(np.float32) for by in (2, 1, 0)]


def trigram_vectors(codes: np.ndarray) -> np.ndarray:
    first, second, third = _vectors()
    bound = first[codes // LETTERS**2]
    bound *= second[codes // LETTERS % LETTERS]
    bound *= third[codes % LETTERS]
    return bound


def trigrams(text: str) -> np.ndarray:
    """Trigrams of letters as numbers; everything between words is one boundary."""
    if not text:
        return np.zeros(0, np.int64)
    letters = letter_numbers()[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
    kept = np.flatnonzero(letters)
    if not len(kept):
        return np.zeros(0, np.int64)
    spaced = np.zeros(2 * len(kept) + 1, np.int64)
    # A boundary stays where letters do not follow each other, and at both ends.
    spaced[1::2] = letters[kept]
    stays = np.ones(len(spaced), bool)
    stays[2:-1:2] = np.diff(kept) > 1
    spaced = spaced[stays]
    return (spaced[:-2] * LETTERS + spaced[1:-1]) * LETTERS + spaced[2:]


def _counted(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Trigrams that occur, and a row of their counts for each text."""
    found = [trigrams(text) for text in texts]
    seen = np.zeros(LETTERS**3, bool)
    for codes in found:
        seen[codes] = True
    codes = np.flatnonzero(seen)
    column = np.zeros(LETTERS**3, np.int32)
    column[codes] = np.arange(len(codes))
    counts = np.zeros((len(texts), len(codes)), np.float32)
    for row, own in zip(counts, found, strict=True):
        row += np.bincount(column[own], minlength=len(codes))
    return codes, counts


def _groups(texts: list[str]) -> Iterator[list[str]]:
    group, size = [], 0
    for text in texts:
        if group and (len(group) >= TOGETHER or size + len(text) > STRETCH):
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


def bundle(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of the trigrams' vectors, as often as each occurs."""
    total = np.zeros(DIMENSIONS)
    for at in range(0, len(codes), 1 << 13):
        own = slice(at, at + (1 << 13))
        total += counts[own].astype(np.float64) @ trigram_vectors(codes[own])
    return total


class Profiles:
    """Unit prototypes by language, in the order of their names."""

    def __init__(self, bundles: dict[str, np.ndarray]):
        self.names = sorted(bundles)
        rows = [bundles[name] / max(np.linalg.norm(bundles[name]), 1e-12) for name in self.names]
        self.prototypes = np.array(rows, np.float32).reshape(len(rows), DIMENSIONS)

    def pages(self) -> Iterator[Profiles]:
        yield self

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        for group in _groups(texts):
            codes, counts = _counted(group)
            bundles = np.zeros((len(group), DIMENSIONS), np.float32)
            for at in range(0, len(codes), 1 << 13):
                own = slice(at, at + (1 << 13))
                bundles += counts[:, own] @ trigram_vectors(codes[own])
            norms = np.linalg.norm(bundles, axis=1)
            if not self.names:
                names += [UNKNOWN] * len(group)
                scores += [0.0] * len(group)
                continue
            cosines = (bundles @ self.prototypes.T) / np.maximum(norms, 1e-12)[:, None]
            best = cosines.argmax(axis=1)
            has = counts.sum(axis=1) > 0 if counts.size else np.zeros(len(group), bool)
            names += [self.names[k] if ok else UNKNOWN for k, ok in zip(best, has, strict=True)]
            top = cosines[np.arange(len(group)), best]
            scores += np.where(has, np.clip(top, 0.0, 1.0), 0.0).astype(float).tolist()
        return names, scores


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram counts by language over a whole partition."""
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        langs, first = batch.column(0).to_pylist(), 0
        for block in blocks(batch.column(1)):
            own = langs[first : first + len(block)]
            first += len(block)
            found: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(own, as_strings(block), strict=True):
                found.setdefault(lang, []).append(trigrams(text))
            for lang, codes in found.items():
                counts = np.bincount(np.concatenate(codes), minlength=LETTERS**3)
                totals[lang] = totals[lang] + counts if lang in totals else counts
    for lang, total in totals.items():
        codes = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(total[codes])],
            ["lang", "code", "n"],
        )


def _bundled(counts: pa.Table) -> pa.Table:
    """One language's bundle from its counts; no more rows than there are trigrams."""
    vector = bundle(counts.column("code").to_numpy(), counts.column("n").to_numpy())
    return pa.table({"lang": counts.column("lang").slice(0, 1), "vector": [vector.tolist()]})


class PagedProfiles:
    """Prototypes of more languages than a task should hold, as a stored table read page by page."""

    def __init__(self, bundles: DataFrame, count: int):
        self.bundles, self.count = bundles, count

    def pages(self) -> Iterator[Profiles]:
        """About ``PAGE`` languages each."""
        page = F.pmod(F.xxhash64("lang"), F.lit(self.count))
        for number in range(self.count):
            yield _collected(self.bundles.where(page == number))


def _collected(bundles: DataFrame) -> Profiles:
    return Profiles({row["lang"]: np.array(row["vector"]) for row in bundles.collect()})


def learn(rows: DataFrame, text: str = "text", lang: str = "lang") -> Profiles | PagedProfiles:
    """Profiles from all rows whose language is known; texts without letters teach nothing.

    With more than ``PAGE`` languages they stay in the shared folder and are read page by page.
    """
    known = rows.where(quoted(lang).isNotNull()).select(
        quoted(lang).cast("string").alias("lang"), quoted(text).cast("string").alias("text")
    )
    summed = (
        known.mapInArrow(_count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    )
    bundles = stored(summed.groupBy("lang").applyInArrow(_bundled, "lang string, vector array<double>"), "bundles")
    pages = -(-bundles.count() // PAGE)
    return PagedProfiles(bundles, pages) if pages > 1 else _collected(bundles)


def identify(docs: DataFrame, profiles: Profiles | PagedProfiles, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the cosine between 0 and 1.

    Null texts and texts without a letter are ``und`` with score 0, and so is every text if
    nothing was learned. Of equal cosines the first name wins, and of scores on different pages
    that equal to six digits. Columns of these names give way. The texts are read once, however
    many pages there are; each page's profiles are a broadcast of 4 MB or so.
    """
    spark, found = docs.sparkSession, None
    for page in profiles.pages():
        held = spark.sparkContext.broadcast(page)
        if found is None:
            found = with_text_columns(docs, text, _predictor(held, "lang_pred", "score"), PREDICTED)
            continue
        name, score = (unused(found, own) for own in ("lang_pred", "score"))
        work = _predictor(held, name, score)
        found = with_text_columns(found, text, work, f"{name} string, {score} double")
        first = (F.col(score) == F.col("score")) & (F.col(name) < F.col("lang_pred"))
        better = (F.col("lang_pred") == UNKNOWN) | (F.col(score) > F.col("score")) | first
        # A page may be empty.
        better = better & (F.col(name) != UNKNOWN)
        found = found.withColumns(
            {
                "lang_pred": F.when(better, F.col(name)).otherwise(F.col("lang_pred")),
                "score": F.when(better, F.col(score)).otherwise(F.col("score")),
            }
        ).drop(name, score)
    return found


def _predictor(held, name: str, score: str):
    def work(texts: pa.Array) -> dict[str, list]:
        names, scores = held.value.predict(as_strings(texts))
        # Sums depend on how rows were batched, in the last digits.
        return {name: names, score: np.round(scores, 6)}

    return work


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {column.lower() for column in df.columns}
    while name in taken:
        name = f"_{name}"
    return name
