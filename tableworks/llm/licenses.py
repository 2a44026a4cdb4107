"""License wording in documents: template markup compiled to token automata.

A template is written as license lists write it. ``<<beginOptional>> ... <<endOptional>>`` may be
missing; ``<<var;words=0-12>>`` stands for any words, as many as it says; all other words are
mandatory, in order, and have to match exactly once letter case, punctuation and line breaks are
gone. Words become numbers of a small vocabulary and a template a graph of states: mandatory words
are steps, optional regions can be stepped over, replaceable ones take any word.

Numpy splits and numbers the words of a block of texts and marks the places where two words in a
row can begin some template. From there one pass over the words keeps the live states of all
templates at once, each with the leftmost place it began at, until none is left. States are
bounded by the templates, so a text costs time in proportion to its length, however it repeats.
"""

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import license_texts
from .texts import Packed, as_bytes, with_text_columns

#: Words are runs of ASCII letters and digits and of all characters beyond ASCII.
SEPARATORS = np.array([not (48 <= b < 58 or 65 <= b < 91 or 97 <= b < 123 or b >= 128) for b in range(256)])
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = bytes(b + 32 if 65 <= b < 91 else b for b in range(256))
_TAG = re.compile(r"<<(beginOptional|endOptional|var;words=(\d+)-(\d+))>>")

#: Evidence is m / (m + HALF) for m mandatory words.
HALF = 3


def lowered(text: str) -> str:
    """A-Z in lower case, everything else as it is."""
    return text.encode().translate(_LOWER).decode()


@dataclass(frozen=True)
class Template:
    label: str
    markup: str


TEMPLATES = [Template(*entry) for entry in license_texts.TEMPLATES]
PHRASES = [Template(*entry) for entry in license_texts.PHRASES]


@dataclass
class Automaton:
    """States of all templates together. State 0 of each begins it; ``ends`` tells what it accepts."""

    words: dict[str, int] = field(default_factory=dict)
    steps: list[dict[int, list[int]]] = field(default_factory=list)
    skips: list[list[int]] = field(default_factory=list)
    wild: list[list[int]] = field(default_factory=list)
    ends: dict[int, int] = field(default_factory=dict)
    starts: list[int] = field(default_factory=list)
    labels: list[str] = field(default_factory=list)
    mandatory: list[int] = field(default_factory=list)

    def _state(self) -> int:
        self.steps.append({})
        self.skips.append([])
        self.wild.append([])
        return len(self.steps) - 1

    def add(self, template: Template) -> None:
        at = self._state()
        self.starts.append(at)
        opened: list[int] = []
        count, last = 0, 0
        for tag, text in _split(template.markup):
            if text is not None:
                for word in _WORD.findall(lowered(text)):
                    number = self.words.setdefault(word, len(self.words) + 1)
                    following = self._state()
                    self.steps[at].setdefault(number, []).append(following)
                    at = following
                    count += not opened
            elif tag[1] == "beginOptional":
                opened.append(at)
            elif tag[1] == "endOptional":
                if not opened:
                    raise ValueError(f"{template.label}: endOptional without its beginning")
                at = self._joined(opened.pop(), at)
            else:
                at = self._region(at, int(tag[2]), int(tag[3]))
        if opened or not count:
            raise ValueError(f"{template.label}: an open optional region, or no mandatory word")
        self.ends[at] = len(self.labels)
        self.labels.append(template.label)
        self.mandatory.append(count)

    def _joined(self, before: int, at: int) -> int:
        """A state after an optional region, reached through it or past it."""
        following = self._state()
        self.skips[at].append(following)
        self.skips[before].append(following)
        return following

    def _region(self, at: int, least: int, most: int) -> int:
        if least > most:
            raise ValueError(f"a replaceable region of {least} to {most} words")
        passed = [at]
        for _ in range(most):
            following = self._state()
            self.wild[passed[-1]].append(following)
            passed.append(following)
        after = self._state()
        for state in passed[least:]:
            self.skips[state].append(after)
        return after

    def closed(self, states: Iterable[int]) -> list[int]:
        """The states and all that are reached from them without a word."""
        found, stack = set(states), list(states)
        while stack:
            for following in self.skips[stack.pop()]:
                if following not in found:
                    found.add(following)
                    stack.append(following)
        return sorted(found)

    def compiled(self) -> "Matcher":
        return Matcher(self)


def _split(markup: str):
    """(tag, None) and (None, text) parts of a template, in order."""
    at = 0
    for tag in _TAG.finditer(markup):
        yield None, markup[at : tag.start()]
        yield tag, None
        at = tag.end()
    rest = markup[at:]
    if "<<" in rest or "<<" in _TAG.sub("", markup):
        raise ValueError("unknown markup")
    yield None, rest


class Matcher:
    """An automaton ready for numbered words: what follows each state, without empty steps.

    Every template has to begin with two words of its own, optional or mandatory, because places
    to begin at are told from pairs of words.
    """

    def __init__(self, automaton: Automaton):
        self.labels, self.mandatory = automaton.labels, automaton.mandatory
        self.words = automaton.words
        closed = [automaton.closed([s]) for s in range(len(automaton.steps))]
        self.step = [self._merged(automaton.steps, states) for states in closed]
        self.any = [sorted({t for s in states for t in automaton.wild[s]}) for states in closed]
        self.ends = [[automaton.ends[s] for s in states if s in automaton.ends] for states in closed]
        self.starts = automaton.starts
        size = len(self.words) + 1
        self.pairs = np.zeros((size, size), bool)
        for start in self.starts:
            for first, states in self.step[start].items():
                for state in states:
                    if self.any[start] or self.any[state] or self.ends[state]:
                        raise ValueError("a template has to begin with two words of its own")
                    self.pairs[first, list(self.step[state])] = True
            if self.any[start]:
                raise ValueError("a template has to begin with two words of its own")

    @staticmethod
    def _merged(steps, states) -> dict[int, list[int]]:
        merged: dict[int, set[int]] = {}
        for state in states:
            for word, following in steps[state].items():
                merged.setdefault(word, set()).update(following)
        return {word: sorted(following) for word, following in merged.items()}

    def places(self, numbers: np.ndarray) -> np.ndarray:
        """Places whose word and next word can begin a template."""
        return np.flatnonzero(self.pairs[numbers[:-1], numbers[1:]]) if len(numbers) > 1 else numbers[:0]

    def spans(self, numbers: Sequence[int], places: Sequence[int]) -> list[tuple[int, int, int]]:
        """(template, first word, word after the last) of matches, those of a template apart.

        The end of a match belongs to its leftmost beginning, and a beginning reaches as far as the
        last end of its own. From left to right, matches that overlap an earlier one go.
        """
        found: dict[tuple[int, int], int] = {}
        live: dict[int, int] = {}
        at, queued = 0, 0
        while queued < len(places) or live:
            if not live:
                at = places[queued]
            if queued < len(places) and places[queued] == at:
                for start in self.starts:
                    live.setdefault(start, at)
                queued += 1
            if at >= len(numbers):
                break
            word, following = numbers[at], {}
            for state, begin in live.items():
                for target in (*self.step[state].get(word, ()), *self.any[state]):
                    if following.get(target, begin) >= begin:
                        following[target] = begin
            at += 1
            for state, begin in following.items():
                for template in self.ends[state]:
                    found[template, begin] = at
            live = following
        kept, free = [], [0] * len(self.labels)
        for (template, begin), end in sorted(found.items(), key=lambda item: item[0][::-1]):
            if begin >= free[template]:
                kept.append((template, begin, end))
                free[template] = end
        return kept


def compile_templates(templates: Sequence[Template]) -> Matcher:
    automaton = Automaton()
    for template in templates:
        automaton.add(template)
    return automaton.compiled()


class Scanner:
    """Templates and phrases over blocks of texts. A phrase is a template without any markup."""

    def __init__(self, templates: Sequence[Template], phrases: Sequence[Template]):
        self.templates, self.phrases = list(templates), list(phrases)
        self.matcher = compile_templates(self.templates)
        self.wanted = [_WORD.findall(lowered(phrase.markup)) for phrase in self.phrases]
        if not all(self.wanted):
            raise ValueError("a phrase without words")
        known = dict(self.matcher.words)
        for words in self.wanted:
            for word in words:
                known.setdefault(word, len(known) + 1)
        spelt = Packed([" ".join(known).encode()], SEPARATORS)
        hashes, numbers = spelt.word_hashes(), np.fromiter(known.values(), np.int64, len(known))
        order = np.argsort(hashes)
        self.hashes, self.numbers, self.known = hashes[order], numbers[order], known

    def numbered(self, packed: Packed) -> np.ndarray:
        """Numbers of the words of the vocabulary; all other words are 0."""
        if not len(packed.starts):
            return np.zeros(0, np.int64)
        hashes = packed.word_hashes()
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.numbers[at], 0)

    def scan(self, texts: list[bytes]) -> dict[str, list]:
        packed = Packed([text.translate(_LOWER) for text in texts], SEPARATORS)
        numbers, owner = self.numbered(packed), packed.word_texts()
        spans: list[list[tuple[str, int, int, int]]] = [[] for _ in texts]
        base: list[list[tuple[str, int, int, int]]] = [[] for _ in texts]
        for phrase, words in zip(self.phrases, self.wanted, strict=True):
            count = max(0, len(numbers) - len(words) + 1)
            hit = np.ones(count, bool)
            for k, word in enumerate(words):
                hit &= numbers[k : k + count] == self.known[word]
            for at in np.flatnonzero(hit).tolist():
                text = int(owner[at])
                if owner[at + len(words) - 1] == text:
                    first = at - int(packed.first[text])
                    base[text].append((phrase.label, first, first + len(words), len(words)))
        limit = len(self.matcher.words)
        templated = np.where(numbers <= limit, numbers, 0)
        places = self.matcher.places(templated)
        places = places[owner[places] == owner[places + 1]] if len(places) else places
        for text in np.unique(owner[places]).tolist():
            first, last = int(packed.first[text]), int(packed.first[text + 1])
            own = places[np.searchsorted(places, first) : np.searchsorted(places, last)] - first
            for template, begin, end in self.matcher.spans(templated[first:last].tolist(), own.tolist()):
                size = self.matcher.mandatory[template]
                spans[text].append((self.matcher.labels[template], begin, end, size))
        most = [max((s[3] for s in a + b), default=0) for a, b in zip(base, spans, strict=True)]
        return {
            "n_words": np.diff(packed.first),
            "phrases": [_rows(sorted(own, key=_by_place)) for own in base],
            "licenses": [_rows(sorted(own, key=_by_place)) for own in spans],
            "score": [m / (m + HALF) for m in most],
        }


def _by_place(span: tuple[str, int, int, int]):
    return span[1], span[2], span[0]


def _rows(spans):
    return [{"label": label, "first": first, "after": after} for label, first, after, _ in spans]


_SPANS = "array<struct<label: string, first: bigint, after: bigint>>"
SCHEMA = f"n_words long, phrases {_SPANS}, licenses {_SPANS}, score double"


def find_licenses(
    docs: DataFrame,
    text: str = "text",
    templates: Sequence[Template] = TEMPLATES,
    phrases: Sequence[Template] = PHRASES,
) -> DataFrame:
    """``docs`` with ``n_words``, the places of ``phrases`` and of ``licenses``, and ``score``.

    Places are (label, first word, word after the last), in order. ``phrases`` lists every place
    where a phrase stands, overlapping ones too; ``licenses`` where templates match, see
    ``Matcher.spans``. ``score`` is
    m / (m + 3) for the greatest number m of mandatory words that some place spells, 0 without any.

    Null texts count as empty: no word, no place, 0. Repeated rows stand for themselves. Columns of
    the same names as the new ones give way. There is no shuffle; a text is read whole, whatever
    its length. Words are compared by 64-bit hashes.
    """
    scanner = Scanner(templates, phrases)

    def work(texts: pa.Array) -> dict:
        return scanner.scan(as_bytes(texts))

    return with_text_columns(docs, text, work, SCHEMA)


def joined_labels(*places: Column) -> Column:
    """The distinct labels of places, sorted and joined by commas."""
    found = F.concat(*[F.transform(place, lambda span: span["label"]) for place in places])
    return F.array_join(F.array_sort(F.array_distinct(found)), ",")

