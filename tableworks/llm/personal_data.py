"""Personal data: base patterns, and a semi-Markov conditional random field that adds spans.

The field scores whole candidate segments, not single tokens: what a span looks like from end to
end (shape, digit groups, check digit, separators) and the word before it. A dynamic program over
the tokens of a stretch chooses boundaries and types together; an entity has at most
``MAX_TOKENS`` tokens. Scored are the stretches around digits, at-signs, "at" or "dot" in brackets,
and a bare "at" that a "dot" or a dotted host follows; text far from all of these is outside by
definition.

It is trained here, on stretches around the base spans of a bounded sample of texts. Some of these
are rewritten the way people disguise such data, with "at" and "dot", other separators or no plus
sign, and keep their labels, which is how it learns spans that the base patterns miss.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .segment_scores import SegmentScorer, Tokens
from .shared import hashed_sample
from .texts import as_bytes, byte_set, quoted, with_text_columns

SPANS = (
    "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
)
KINDS = ("email", "ip", "card", "phone")

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Characters that base matches consist of: a match lies within one run of them.
EMAIL_RUN = re.compile(r"[A-Za-z0-9._%+@-]+")

#: Tokens in a segment at most; words of context on either side of a stretch.
MAX_TOKENS, CONTEXT = 24, 3
#: Words around a bare "at" among which its dots or its host must be.
SPELT_REACH = 4
#: Texts sampled for training at most, passes over them, and the seed of both.
SAMPLE_TEXTS, EPOCHS, SEED = 800, 6, 11
#: Texts looked through for these at most.
SEARCHED_TEXTS = 24_000
#: Features on fewer training segments are left out.
RARE = 25
#: A segment found must beat staying outside by this much to be reported.
MARGIN = 2.0

#: Characters looked back on for the word before a token; of a longer word, its end.
NEAR = 200
#: Characters of a stretch worked on together, and numbers of stretches that need no window.
WINDOW, FEW_NUMBERS = 1 << 16, 12

TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[^A-Za-z0-9]")
_NUMBER = re.compile(r"[0-9]+")
_MARKS = byte_set(b"0123456789@+")


# ---------------------------------------------------------------- base patterns


def luhn(digits: str) -> bool:
    total = 0
    for at, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + at % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def _card_ok(text: str) -> bool:
    digits = _digits(text)
    return 16 <= len(digits) <= 19 and luhn(digits)


def _ip_ok(text: str) -> bool:
    # Long parts are too large whatever their leading zeros hide; compare without them.
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in text.split("."))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base patterns: by kind as listed, then by start."""
    found = []
    if "@" in text:
        for run in EMAIL_RUN.finditer(text):
            if "@" in run.group():
                found += [("email", m.start(), m.end()) for m in EMAIL.finditer(text, *run.span())]
    found += [("ip", *m.span()) for m in IP.finditer(text) if _ip_ok(m.group())]
    found += [("card", *m.span()) for m in CARD.finditer(text) if _card_ok(m.group())]
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(_digits(m.group())) <= 15:
                found.append(("phone", *m.span()))
    return found


# ---------------------------------------------------------------- stretches and features


class Stretch:
    """Tokens around marks; blanks are tokens too, but no segment begins or ends with one."""

    def __init__(self, text: str, start: int, end: int, first: int | None = None):
        self.text, self.first = text, start if first is None else first
        spans = [m.span() for m in TOKEN.finditer(text, start, end)]
        self.starts, self.ends = [s for s, _ in spans], [e for _, e in spans]

    def segments(self, marked: np.ndarray | None = None):
        """``(first token, last token + 1)`` of every candidate.

        Given the tokens that are marks, only of candidates that hold letters: they hold a mark, too.
        """
        text, count = self.text, len(self.starts)
        places = range(count)
        if marked is not None:
            ahead = np.convolve(marked, np.ones(MAX_TOKENS, int))[MAX_TOKENS - 1 :] if count else marked
            places = np.flatnonzero(ahead).tolist()
        for i in places:
            head = text[self.starts[i]]
            if not (head.isascii() and head.isalnum() or head in "+("):
                continue
            if self.starts[i] and text[self.starts[i] - 1].isalnum():
                continue
            digits = letters = marks = 0
            for j in range(i, min(count, i + MAX_TOKENS)):
                token = text[self.starts[j] : self.ends[j]]
                if token == "\n":
                    break
                if token[0].isdigit():
                    digits += len(token)
                elif token[0].isalpha():
                    letters += 1
                    marks += token.lower() in ("at", "dot")
                elif token == "@":
                    marks += 1
                tail = token[-1]
                if not (tail.isascii() and tail.isalnum()):
                    continue
                if self.ends[j] < len(text) and text[self.ends[j]].isalnum():
                    continue
                if digits >= 4 or marks:
                    if marks if letters else marked is None:
                        yield i, j + 1

    def candidates(self) -> list[tuple[int, int, list[str]]]:
        return [(i, j, features(self, i, j)) for i, j in self.segments()]

    def before(self, i: int) -> str:
        """The word among the five tokens before a token, back to the beginning of the stretch."""
        end = self.starts[i]
        tokens = TOKEN.findall(self.text, max(self.first, end - NEAR), end)
        return next((t.lower() for t in reversed(tokens[-5:]) if t[0].isalpha()), "")


_AT = re.compile(r"\s*[\[({<]?\s*(?:@|\bat\b)\s*[\])}>]?\s*", re.I)
_DOT = re.compile(r"\s*[\[({<]\s*dot\s*[\])}>]\s*|\s+dot\s+|\.", re.I)
_GOES_ON = re.compile(r"(?:%s)[A-Za-z0-9]" % _DOT.pattern, re.I)
_LED_ON = re.compile(r"[A-Za-z0-9](?:%s)\Z" % _DOT.pattern, re.I)
_NAME = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_HOST = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}\Z")
_SPELT_DOT = re.compile(r"[\[({<]\s*dot\s*[\])}>]|\sdot\s", re.I)
# Endings of hosts that are hardly ever words of a text.
ENDINGS = frozenset(
    "com org net edu gov mil int info biz de fr es uk eu ch nl se dk fi pl cz hu pt gr ru ua cn jp kr tw au nz ca br mx ar cl"
    .split()
)


def _plain(separators: str) -> bool:
    return len(separators) < 2 or separators in (" +", " -", "-.", " .")


def _ending(host: str) -> str:
    """A kind of ending, not the ending itself: training texts may know only one."""
    last = host.rsplit(".", 1)[1].lower()
    return "listed" if last in ENDINGS else "two letters" if len(last) == 2 else "other"


def features(stretch: Stretch, i: int, j: int) -> list[str]:
    """What a whole segment looks like."""
    text = stretch.text[stretch.starts[i] : stretch.ends[j - 1]]
    digits = _digits(text)
    groups = re.findall(r"[0-9]+", text)
    found = ["bias", "n=%d" % min(len(digits), 20), "groups=%d" % min(len(groups), 8)]
    separators = "".join(sorted(set(re.sub(r"[A-Za-z0-9]", "", text))))
    found.append("sep=" + separators[:6])
    if _plain(separators):
        found.append("plain separators")
    if re.search(r"[^A-Za-z0-9]{3,}", text):
        found.append("long gap")
    if re.search(r"[A-Za-z]", text):
        parts = _AT.split(text)
        if len(parts) == 2 and _NAME.match(_DOT.sub(".", parts[0])):
            host = _DOT.sub(".", parts[1])
            if _HOST.match(host):
                # How the whole is spelt tells more than which marks that takes.
                found = [name for name in found if not name.startswith(("sep=", "plain", "long"))]
                at_form = re.sub(r"\s+", " ", _AT.search(text).group().lower())
                found += ["name at host", "at=" + at_form, "ending=" + _ending(host)]
                if _SPELT_DOT.search(parts[1]):
                    found.append("dot spelt")
                if _GOES_ON.match(stretch.text, stretch.ends[j - 1]):
                    found.append("host goes on")
                if _LED_ON.search(stretch.text[max(0, stretch.starts[i] - 8) : stretch.starts[i]]):
                    found.append("name begins earlier")
            else:
                found.append("name at other")
            found.append("at sign" if "@" in text else "at word")
        else:
            found.append("letters")
    else:
        found.append("no letters")
        if len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups):
            between = {gap.strip() for gap in re.findall(r"[^0-9]+", text)}
            found.append("octets " + ("even" if len(between) == 1 and "" not in between else "mixed"))
        if 13 <= len(digits) <= 19:
            found.append("check digit " + ("fits" if luhn(digits) else "fails"))
            found.append("fours" if {len(g) for g in groups[:-1]} <= {4} else "no fours")
        if len(digits) in (10, 11, 12):
            found.append("phone groups " + "-".join(str(min(len(g), 5)) for g in groups[:5]))
        found.append("head=" + (text[0] if text[0] in "+(" else "d"))
    if "name at host" not in found:
        found.append("before=" + stretch.before(i))
    return found


def _stretches(text: str) -> list[tuple[int, int]]:
    """Bounds of the words near marks, neighbours joined."""
    edges = (edge for m in re.finditer(r"[^\s]+", text) for edge in m.span())
    words = np.fromiter(edges, np.int64).reshape(-1, 2)
    hot = [k for k, (s, e) in enumerate(zip(*words.T.tolist())) if _HOT_WORD.search(text, s, e)]
    if _BARE_AT.search(text):
        hot = sorted({*hot, *_spelt_out([text[s:e] for s, e in words.tolist()])})
    bounds: list[list[int]] = []
    for k in hot:
        low, high = max(0, k - CONTEXT), min(len(words), k + CONTEXT + 2)
        if bounds and low <= bounds[-1][1]:
            bounds[-1][1] = high
        else:
            bounds.append([low, high])
    return [(int(words[low, 0]), int(words[high - 1, 1])) for low, high in bounds]


_HOT_WORD = re.compile(r"[0-9@]|[\[({<](?:at|dot)[\])}>]", re.I)
_BARE_AT = re.compile(r"(?<!\S)at(?!\S)", re.I)


def _spelt_out(words: list[str]) -> Iterator[int]:
    """Places of a bare "at" with a "dot" or a dotted host soon after it, and of the dots beside it."""
    for k, word in enumerate(words):
        if len(word) == 2 and word.lower() == "at":
            after = range(k + 1, min(len(words), k + 1 + SPELT_REACH))
            dots = [j for j in after if words[j].lower() == "dot"]
            if dots or any(_HOST.match(words[j].strip("()[]{}<>\"',;:.!?")) for j in after):
                before = range(max(0, k - SPELT_REACH), k)
                yield from (k, *dots, *(j for j in before if words[j].lower() == "dot"))


# ---------------------------------------------------------------- the field


class Field:
    """Weights by (kind, feature); staying outside scores zero per token."""

    def __init__(self):
        self.weights: dict[tuple[str, str], float] = defaultdict(float)

    def scores(self, candidates: list[tuple[int, int, list[str]]]) -> dict[int, list[tuple]]:
        """Segments by their end: (start, kind, score, features)."""
        by_end: dict[int, list] = defaultdict(list)
        get = self.weights.get
        for i, j, found in candidates:
            for kind in KINDS:
                by_end[j].append((i, kind, sum(get((kind, name), 0.0) for name in found), found))
        return by_end

    def best(self, stretch: Stretch) -> list[tuple[str, int, int, float]]:
        """The best segmentation's entities: kind, first token, last token + 1, score."""
        by_end = self.scores(stretch.candidates())
        chosen = {
            j: [(i, kind, score) for i, kind, score, _ in ending if score > 0]
            for j, ending in by_end.items()
        }
        return _decode(chosen, len(stretch.starts))

    def entities(self, text: str, start: int, end: int) -> Iterator[tuple[str, int, int, float]]:
        """The same entities for a stretch of any length, as (kind, start, end, score).

        The stretch is cut where no segment that scores above zero crosses, at line ends above all,
        so the best segmentations of the pieces are together the best one. Memory goes with the
        window; it grows only where such segments overlap without a break. Stretches of few numbers
        are faster without numpy and have the same result.
        """
        if len(_NUMBER.findall(text, start, end)) <= FEW_NUMBERS:
            stretch = Stretch(text, start, end)
            for kind, i, j, score in self.best(stretch):
                yield kind, stretch.starts[i], stretch.ends[j - 1], score
            return
        scorer = SegmentScorer(self.weights, KINDS, _plain)
        at, window = start, WINDOW
        while at < end:
            stop = min(end, at + window)
            if stop < end:
                line = text.rfind("\n", at, stop)
                stop = line + 1 if line >= at else stop
            stretch = Stretch(text, at, stop, start)
            cut_off = stop < end and text[stop - 1] != "\n"
            if cut_off and stretch.starts:
                # The last token may go on behind the window.
                del stretch.starts[-1], stretch.ends[-1]
            count = len(stretch.starts)
            chosen, reach = self._positive(scorer, stretch)
            size = count
            if cut_off:
                crossed = np.cumsum(reach)[:count]
                free = np.flatnonzero(crossed[: max(0, count - MAX_TOKENS)] == 0)
                size = int(free[-1]) if len(free) else 0
                if not size:
                    window *= 2
                    continue
            inside = {j: own for j, own in chosen.items() if j <= size}
            for kind, i, j, score in _decode(inside, size):
                yield kind, stretch.starts[i], stretch.ends[j - 1], score
            at, window = (stretch.starts[size] if size < count else stop), WINDOW

    def _positive(self, scorer: "SegmentScorer", stretch: Stretch):
        """Segments above zero by their end, and how many begin to cross or end before each token."""
        tokens = Tokens(stretch.text, stretch.starts, stretch.ends)
        chosen: dict[int, list] = defaultdict(list)
        reach = np.zeros(len(stretch.starts) + 1, np.int64)
        if len(tokens.separators) > 62:
            for j, ending in self.scores(stretch.candidates()).items():
                chosen[j] = [(i, kind, score) for i, kind, score, _ in ending if score > 0]
        else:
            found = scorer.positive(
                stretch.text, stretch.starts, stretch.ends, tokens, stretch.before, MAX_TOKENS, 0
            )
            for i, j, kind, score in zip(*(x.tolist() for x in found), strict=True):
                chosen[j].append((i, KINDS[kind], score))
            spelt = [(i, j, features(stretch, i, j)) for i, j in stretch.segments(tokens.mark)]
            for j, ending in self.scores(spelt).items():
                chosen[j] += [(i, kind, score) for i, kind, score, _ in ending if score > 0]
        for j, ending in chosen.items():
            ending.sort(key=lambda own: own[0])
            for i, *_ in ending:
                if j > i + 1:
                    reach[i + 1] += 1
                    reach[j] -= 1
        return chosen, reach

    def gradient(self, candidates: list, count: int, gold: set[tuple[str, int, int]]) -> dict:
        """Observed minus expected feature counts, by the forward and backward recursions."""
        by_end = self.scores(candidates)
        forward = np.zeros(count + 1)
        for j in range(1, count + 1):
            ways = [forward[j - 1]] + [forward[i] + score for i, _, score, _ in by_end.get(j, ())]
            forward[j] = np.logaddexp.reduce(ways)
        backward = np.full(count + 1, -np.inf)
        backward[count] = 0.0
        for j in range(count, 0, -1):
            backward[j - 1] = np.logaddexp(backward[j - 1], backward[j])
            for i, _, score, _ in by_end.get(j, ()):
                backward[i] = np.logaddexp(backward[i], backward[j] + score)
        change: dict[tuple[str, str], float] = defaultdict(float)
        for j, ending in by_end.items():
            for i, kind, score, found in ending:
                expected = np.exp(forward[i] + score + backward[j] - forward[count])
                step = float((kind, i, j) in gold) - expected
                if abs(step) > 1e-4:
                    for name in found:
                        change[kind, name] += step
        return change


def _decode(chosen: dict[int, list[tuple]], count: int) -> list[tuple[str, int, int, float]]:
    best, back = [0.0] * (count + 1), [None] * (count + 1)
    for j in range(1, count + 1):
        best[j] = best[j - 1]
        for i, kind, score in chosen.get(j, ()):
            if best[i] + score > best[j]:
                best[j], back[j] = best[i] + score, (i, kind, score)
    found, j = [], count
    while j > 0:
        if back[j]:
            i, kind, score = back[j]
            found.append((kind, i, j, score))
            j = i
        else:
            j -= 1
    return found[::-1]


def train(examples: list[tuple[str, list[tuple[str, int, int]]]]) -> Field:
    """Maximum likelihood with a small penalty, by adaptive gradient steps."""
    field, seen = Field(), defaultdict(float)
    shuffled = random.Random(SEED)
    cases = []
    for text, spans in examples:
        for start, end in _stretches(text):
            stretch = Stretch(text, start, end)
            begins = {s: k for k, s in enumerate(stretch.starts)}
            stops = {e: k + 1 for k, e in enumerate(stretch.ends)}
            inside = [x for x in spans if start <= x[1] and x[2] <= end]
            if all(s in begins and e in stops for _, s, e in inside):
                gold = {(k, begins[s], stops[e]) for k, s, e in inside}
                cases.append((stretch.candidates(), len(stretch.starts), gold))
    often = Counter(name for candidates, *_ in cases for *_, found in candidates for name in found)
    for candidates, *_ in cases:
        for *_, found in candidates:
            found[:] = [name for name in found if often[name] >= RARE]
    for _ in range(EPOCHS):
        shuffled.shuffle(cases)
        for case in cases:
            for key, step in field.gradient(*case).items():
                step -= 0.002 * field.weights[key]
                seen[key] += step * step
                field.weights[key] += 0.5 * step / (1e-6 + seen[key] ** 0.5)
    field.weights = dict(field.weights)
    return field


#: Ways to write an address: for its at-sign, and for its dots.
ADDRESS_FORMS = ((" at ", " dot "), (" [at] ", " [dot] "), ("(at)", "."), (" @ ", "."), ("[at]", "[dot]"))
#: Characters on either side that an address is shown with.
BESIDE = 30


def _disguised(kind: str, text: str, dice: random.Random, form: tuple | None = None) -> str:
    if kind == "email":
        if dice.random() < 0.5:
            text = re.sub(r"\.?[0-9]+", "", text)
        name, host = text.split("@")
        at, dot = form or dice.choice(ADDRESS_FORMS)
        return (name.replace(".", dot) if dice.random() < 0.5 else name) + at + host.replace(".", dot)
    if kind == "ip":
        return text.replace(".", dice.choice((" . ", "[.]", ".")))
    digits = _digits(text)
    if kind == "card":
        return dice.choice((".", "-", "  ", " - ")).join(digits[k : k + 4] for k in range(0, len(digits), 4))
    cut = max(1, len(digits) - 10)
    parts = digits[:cut], digits[cut : cut + 3], digits[cut + 3 : cut + 6], digits[cut + 6 :]
    return dice.choice(("({1}) {2}-{3}", "{1}-{2}-{3}", "00{0} {1} {2} {3}", "{1}.{2}.{3}")).format(*parts)


_NOUNS = ("product", "matrix", "plot", "on", "of", "in", "and", "pattern", "size", "above", "there", "map")


def _plain_numbers(dice: random.Random) -> str:
    """Dates, times, amounts, book numbers, codes and dots in words, none of them personal."""
    n = dice.randint
    kinds = (
        f"in {n(1000, 2100)} there were {n(10, 10**9):,} of no {n(1, 10**6)} and {dice.random():.4f} more",
        f"on {n(1950, 2030)}-{n(1, 12):02}-{n(1, 28):02} {n(0, 23):02}:{n(0, 59):02}:{n(0, 59):02} it was",
        f"dated {n(1, 28):02}.{n(1, 12):02}.{n(1950, 2030)} {n(0, 23):02}:{n(0, 59):02} and so",
        f"book {n(978, 979)}-{n(0, 9)}-{n(10, 99)}-{n(100000, 999999)}-{n(0, 9)} by them",
        f"order {n(10**12, 10**14)} of {n(10, 99)} {n(100, 999)} {n(1000, 9999)} {n(10, 99)} parts",
        f"look at {dice.choice(('the', 'this', 'a', 'each'))} dot {dice.choice(_NOUNS)} or stay at the dot",
        f"release {n(0, 20)}.{n(0, 20)}.{n(0, 900)} has {n(1, 99)} - {n(100, 999)} notes",
    )
    return dice.choice(kinds)


def examples(texts: list[str]) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Pieces of texts with labelled spans: as they are, and disguised, addresses in every form."""
    dice, out = random.Random(SEED), []
    for text in texts:
        taken, last = [], -1
        for kind, start, end in sorted(base_spans(text), key=lambda x: (x[1], -x[2])):
            if start >= last:
                taken.append((kind, start, end))
                last = end
        for rewrite in (False, True):
            parts, spans, at, size = [], [], 0, 0
            for kind, start, end in taken:
                found = text[start:end]
                if rewrite:
                    found = _disguised(kind, found, dice)
                parts += [text[at:start], found]
                size += start - at
                spans.append((kind, size, size + len(found.rstrip())))
                size, at = size + len(found), end
            out.append(("".join([*parts, text[at:]]), spans))
        # Addresses are rare: each is shown in all its forms, up to the spans beside it.
        edges = [0, *(end for *_, end in taken)], [*(start for _, start, _ in taken[1:]), len(text)]
        for (kind, start, end), low, high in zip(taken, *edges):
            for form in ADDRESS_FORMS if kind == "email" else ():
                lead, found = text[max(low, start - BESIDE) : start], _disguised(kind, text[start:end], dice, form)
                spans = [(kind, len(lead), len(lead) + len(found.rstrip()))]
                out.append((lead + found + text[end : min(high, end + BESIDE)], spans))
        out.append((_plain_numbers(dice), []))
    return out


# ---------------------------------------------------------------- over tables


def fit(
    docs: DataFrame, text: str = "text", sample: int = SAMPLE_TEXTS, searched: int = SEARCHED_TEXTS
) -> Field:
    """A field trained on at most ``sample`` of ``searched`` or so sampled texts: those that hold a
    base span's characters."""
    texts = hashed_sample(docs.select(quoted(text).cast("string").alias("text")), searched)
    likely = texts.where(F.col("text").rlike("@[A-Za-z0-9]|[0-9]{2}"))
    drawn = likely.orderBy(F.xxhash64("text"), "text").limit(sample)
    pieces = [row[0] for row in drawn.collect()]
    return train(examples(pieces))


def all_spans(text: str, field: Field) -> tuple[list, list]:
    """Base spans, and these with the field's spans that touch none of them."""
    base = base_spans(text)
    taken = sorted((s, e) for _, s, e in base)
    # Spans of different kinds can overlap: the farthest end of those up to each start counts.
    starts = [s for s, _ in taken]
    reached = list(accumulate((e for _, e in taken), max))
    added = []
    for start, end in _stretches(text):
        for kind, s, e, score in field.entities(text, start, end):
            before = bisect_left(starts, e)
            if score >= MARGIN and not (before and reached[before - 1] > s):
                added.append((kind, s, e))
    order = {kind: k for k, kind in enumerate(KINDS)}
    return base, sorted(base + added, key=lambda x: (order[x[0]], x[1]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


_NOTHING = hashlib.sha256(b"").hexdigest()
_WORDS = re.compile(rb"[\[({<](?:at|dot)[\])}>]|(?<![A-Za-z0-9])at(?![A-Za-z0-9])", re.I)


def _finder(field):
    def work(texts: pa.Array) -> dict[str, list]:
        counts = {kind: [] for kind in KINDS}
        digests, spans = [], []
        for data in as_bytes(texts):
            if _MARKS[np.frombuffer(data, np.uint8)].any() or _WORDS.search(data):
                base, every = all_spans(data.decode("utf-8", "replace"), field.value)
            else:
                base, every = [], []
            for kind, found in counts.items():
                found.append(sum(x[0] == kind for x in base))
            digests.append(hashlib.sha256(joined(base).encode()).hexdigest() if base else _NOTHING)
            spans.append(joined(every))
        return {f"n_{kind}": found for kind, found in counts.items()} | {
            "base_sha256": digests,
            "spans": spans,
        }

    return work


def find_personal_data(docs: DataFrame, text: str = "text", field: Field | None = None) -> DataFrame:
    """``docs`` with counts of base spans, ``base_sha256`` of them, and all ``spans``.

    Spans read ``kind:start:end`` by code points, ends exclusive. Null texts count as empty.
    Without ``field`` one is trained on the texts; without any base span among them nothing is
    added. Repeated rows stand for themselves.
    """
    held = docs.sparkSession.sparkContext.broadcast(field or fit(docs, text))
    return with_text_columns(docs, text, _finder(held), SPANS)
