import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tableworks.llm import personal_data as pd_

from . import brute

SAMPLE = [
    f"word{k} here mail.{k}@host{k % 9}.example.com there, call +1 ({200 + k}) 555-{1000 + k} and {k % 250}.7.{k % 99}.2 "
    f"or 42{k:02}051279{1000 + k}08 end"
    for k in range(60)
]


@pytest.fixture(scope="module")
def field():
    return pd_.train(pd_.examples(SAMPLE))


@settings(max_examples=300, deadline=None)
@given(st.text("a.@+1024-( )ü²\n", max_size=50), st.sampled_from(["", "4111 1111 1111 1111", "+1 555 123-4567", "a@b.c", "1.2.3.4.5"]))
def test_base_spans_equal_brute_force(text, extra):
    whole = text + extra + text
    assert pd_.base_spans(whole) == brute.personal(whole)


def best_by_force(field, stretch):
    """Highest score of any segmentation."""
    ends = {}
    for i, j, found in stretch.candidates():
        top = max(sum(field.weights.get((kind, name), 0.0) for name in found) for kind in pd_.KINDS)
        ends.setdefault(j, []).append((i, top))

    def upto(j):
        if j == 0:
            return 0.0
        return max([upto(j - 1)] + [upto(i) + score for i, score in ends.get(j, ())])

    return upto(len(stretch.starts))


@pytest.mark.parametrize("text", ["a 555-123-4567 b", "at 10.0.0.1, x@y.org", "4111-1111-1111-1111", "+1 (555) 123-4567"])
def test_decoding_finds_the_best_segmentation(field, text):
    stretch = pd_.Stretch(text, 0, len(text))
    found = sum(score for *_, score in field.best(stretch))
    assert found == pytest.approx(best_by_force(field, stretch))


def test_gradient_is_that_of_the_likelihood(field):
    import numpy as np

    text = "call 555-123-4567 or 10.0.0.1"
    stretch = pd_.Stretch(text, 0, len(text))
    candidates, count = stretch.candidates(), len(stretch.starts)
    gold = {("ip", count - 7, count)}

    def likelihood():
        by_end = field.scores(candidates)
        forward = [0.0]
        for j in range(1, count + 1):
            ways = [forward[j - 1]] + [forward[i] + s for i, _, s, _ in by_end.get(j, ())]
            forward.append(float(np.logaddexp.reduce(ways)))
        own = sum(s for j, x in by_end.items() for i, kind, s, _ in x if (kind, i, j) in gold)
        return own - forward[-1]

    change = field.gradient(candidates, count, gold)
    for key in sorted(change, key=lambda k: -abs(change[k]))[:5]:
        old = field.weights.get(key, 0.0)
        field.weights[key] = old + 1e-4
        up = likelihood()
        field.weights[key] = old - 1e-4
        down = likelihood()
        field.weights[key] = old
        assert change[key] == pytest.approx((up - down) / 2e-4, abs=1e-3)


@pytest.mark.parametrize(
    ("text", "kind", "span"),
    [("please call 555-123-4567 now", "phone", "555-123-4567"), ("from 10[.]20[.]30[.]40 on", "ip", "10[.]20[.]30[.]40")],
)
def test_disguised_data_is_added(field, text, kind, span):
    base, every = pd_.all_spans(text, field)
    assert not base and (kind, text.index(span), text.index(span) + len(span)) in every


@pytest.mark.parametrize("before", ["", "write to ", "see figures 1 2 3 and then some more words before you write to "])
@pytest.mark.parametrize(
    "span",
    [
        "john(at)example.com",
        "john[at]example[dot]com",
        "john [at] example [dot] com",
        "john @ example.com",
        "john at example dot com",
        "john dot smith at mail dot example dot com",
    ],
)
def test_disguised_addresses_without_digits(field, span, before):
    text = f"{before}{span} today"
    own = ("email", len(before), len(before) + len(span))
    assert pd_.all_spans(text, field)[1] == [own]
    found = pd_._finder(type("Held", (), {"value": field}))(pd_.pa.array([text]))
    assert found["spans"] == ["%s:%d:%d" % own]


def plainly(field, text):
    """Every stretch as a whole, every candidate's features spelt out."""
    found = []
    for start, end in pd_._stretches(text):
        stretch = pd_.Stretch(text, start, end)
        found += [(k, stretch.starts[i], stretch.ends[j - 1], s) for k, i, j, s in field.best(stretch)]
    return found


def in_windows(field, text):
    return [x for start, end in pd_._stretches(text) for x in field.entities(text, start, end)]


def same(one, other):
    assert [x[:3] for x in one] == [x[:3] for x in other]
    assert [x[3] for x in one] == pytest.approx([x[3] for x in other])


PARTS = [
    "10.2.3.7", "12:30:45", "555-123-4567", "+1 (555) 123-4567", "4111 1111 1111 1111", "4111-1111-1111-1111", "(212)",
    "1234", "0", "2024-01-15", "10 . 20 . 30 . 40", "1,234,567.89", "a@b.c", "x at y dot com", "j.doe [at] host [dot] org",
    "é", "²³", "٣٤٥", "v1.2.3.4", "1.2.3.4.5", "word", "\n", "\t", "+", "@", "12345678901234567890123", "call", "#",
    "999.1.2.3", "1.2.3.04", "+44 20 7946 0958", "001 555 123 4567", "{dot}", "1.2;3.4",
]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=40), st.sampled_from([" ", "", " and then ", "-"]), st.sampled_from([40, 97, 1 << 16]))
def test_windows_equal_whole_stretches(field, parts, between, window):
    text, old = between.join(parts), (pd_.WINDOW, pd_.FEW_NUMBERS)
    pd_.WINDOW, pd_.FEW_NUMBERS = window, -1
    try:
        same(in_windows(field, text), plainly(field, text))
    finally:
        pd_.WINDOW, pd_.FEW_NUMBERS = old


def test_windows_of_documents(documents, field):
    for row in documents.collect():
        same(in_windows(field, row["text"] or ""), plainly(field, row["text"] or ""))


def log_text(size, lines, seed=2):
    import random

    dice, parts, length = random.Random(seed), [], 0
    while length < size:
        n = dice.randint
        part = f"{n(1, 255)}.{n(0, 255)}.{n(0, 255)}.{n(0, 255)} {n(0, 23)}:{n(10, 59)}:{n(10, 59)} {n(200, 999)}-{n(100, 999)}-{n(1000, 9999)}"
        parts.append(part)
        length += len(part) + 1
    return ("\n" if lines else " ").join(parts)


@pytest.mark.parametrize("lines", [True, False])
def test_long_texts_of_numbers_take_little(field, lines):
    """A megabyte of addresses, times and numbers: time in proportion, memory by the window."""
    import resource
    import time

    text = log_text(1_000_000, lines)
    same(in_windows(field, text[:20_000]), plainly(field, text[:20_000]))
    before, started = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.time()
    base, every = pd_.all_spans(text, field)
    assert len(base) >= 25_000 and len(every) >= len(base)
    assert time.time() - started < 30
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 300_000


def test_dots_in_words_stay_clean(field):
    for text in ("they look at the dot product of both", "he is at home. The dot is red", "at the dot com boom"):
        assert pd_.all_spans(text, field) == ([], [])


def test_plain_text_stays_clean(field):
    for text in ("In 1999 there were 12,345,678 people.", "on 2024-01-15 12:30:45 it rained", "no numbers at all. dot"):
        assert pd_.all_spans(text, field) == ([], [])


def test_documents(documents, field):
    for row in pd_.find_personal_data(documents, field=field).collect():
        want = brute.personal(row["text"])
        assert row["base_sha256"] == brute.digest(want)
        assert [row[f"n_{k}"] for k in pd_.KINDS] == [sum(k == x for x, *_ in want) for k in pd_.KINDS]
        assert {f"{k}:{s}:{e}" for k, s, e in want} <= set(row["spans"].split(",")) | {""}


def test_odd_rows(odd, none):
    rows = pd_.find_personal_data(odd).collect()
    assert len(rows) == odd.count()
    for row in rows:
        assert row["base_sha256"] == brute.digest(brute.personal(row["text"]))
    assert pd_.find_personal_data(none).count() == 0


def luhn_number(dice):
    digits = [4] + [dice.randrange(10) for _ in range(14)]
    total = sum(d if k % 2 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(digits))
    return "".join(map(str, [*digits, -total % 10]))


def hidden(kind, dice):
    """Personal data that no base pattern takes whole, written without the trainer's own disguises."""
    names, hosts = ("ana", "j.smith", "kim_lee", "r.o.novak"), ("posta.example.org", "mail.example.de", "inbox.example.co.uk", "box.example.museum")
    if kind == "email":
        at, dot = dice.choice(((" at ", " dot "), ("[at]", "[dot]"), (" (at) ", " (dot) "), (" [at] ", "."), ("(at)", ".")))
        return dice.choice(names) + at + dice.choice(hosts).replace(".", dot)
    if kind == "ip":
        return dice.choice(("[.]", " . ")).join(str(dice.randrange(1, 256)) for _ in range(4))
    if kind == "card":
        digits = luhn_number(dice)
        return dice.choice((".", " - ")).join(digits[k : k + 4] for k in range(0, 16, 4))
    a, b, c = dice.randrange(200, 999), dice.randrange(200, 999), dice.randrange(1000, 9999)
    return dice.choice((f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"001 {a} {b} {c}"))


def hide_all(texts, dice):
    """Texts with every base span replaced by something hidden of its kind, and where that is."""
    for text in texts:
        parts, spans, at, size = [], [], 0, 0
        for kind, start, end in sorted(pd_.base_spans(text), key=lambda x: x[1]):
            if start < at:
                continue
            new = hidden(kind, dice)
            parts += [text[at:start], new]
            size += start - at
            spans.append((kind, size, size + len(new)))
            size, at = size + len(new), end
        yield "".join([*parts, text[at:]]), spans


def rates(spark, sf):
    """Planted, found, added and rightly added spans of texts that the field was not fitted on."""
    docs = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet")
    field = pd_.fit(docs.where("doc_id % 2 = 0"))
    texts = [r["text"] for r in docs.where("doc_id % 2 = 1 AND text IS NOT NULL").orderBy("doc_id").collect()]
    counts = {kind: [0, 0, 0, 0] for kind in pd_.KINDS}
    for text, planted in hide_all(texts, random.Random(8)):
        base, every = pd_.all_spans(text, field)
        added = set(every) - set(base)
        for kind, low, high in planted:
            counts[kind][0] += 1
            counts[kind][1] += (kind, low, high) in added
        for kind, low, high in added:
            counts[kind][2] += 1
            counts[kind][3] += any(k == kind and low < b and a < high for k, a, b in planted)
    return counts


def test_hidden_data_in_held_out_documents(spark):
    counts = rates(spark, "0.01")
    planted, found, added, right = (sum(c[k] for c in counts.values()) for k in range(4))
    print({kind: dict(zip(("planted", "found", "added", "right"), c)) for kind, c in counts.items()})
    assert planted > 30 and right >= 0.9 * added and found >= 0.5 * planted
