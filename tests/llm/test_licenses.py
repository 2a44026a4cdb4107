import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tableworks.llm import licenses as lic

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(lic.lowered(text or ""))


def pattern(markup):
    """A template as a regular expression over words that each have a blank after them."""
    out = ""
    for part in re.split(r"(<<[^>]*>>)", markup):
        if part == "<<beginOptional>>":
            out += "(?:"
        elif part == "<<endOptional>>":
            out += ")?"
        elif part.startswith("<<var"):
            low, high = re.findall(r"\d+", part)
            out += f"(?:[^ ]+ ){{{low},{high}}}"
        else:
            out += "".join(re.escape(word) + " " for word in words_of(part))
    return re.compile(out)


def matches(markup, words):
    """All places of a template: every end with its leftmost beginning, apart from left to right."""
    found, one = {}, pattern(markup)
    for end in range(1, len(words) + 1):
        for begin in range(end):
            if one.fullmatch(" ".join(words[begin:end]) + " "):
                found[begin] = end
                break
    kept, free = [], 0
    for begin in sorted(found):
        if begin >= free:
            kept.append((begin, found[begin]))
            free = found[begin]
    return kept


def phrase_places(words):
    return sorted(
        (at, at + len(wanted), phrase.label)
        for phrase in lic.PHRASES
        for wanted in [words_of(phrase.markup)]
        for at in range(len(words))
        if words[at : at + len(wanted)] == wanted
    )


SMALL = [
    lic.Template("x", "a b <<beginOptional>>c<<endOptional>> <<var;words=0-2>> d"),
    lic.Template("y", "<<beginOptional>>b b<<endOptional>> a a <<beginOptional>>b <<beginOptional>>c<<endOptional>> a<<endOptional>>"),
    lic.Template("z", "b c <<var;words=2-3>> b"),
]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("aaabbbccdé"), max_size=24))
def test_small_templates_as_regular_expressions(words):
    text = " ".join(words)
    found = lic.Scanner(SMALL, [lic.Template("p", "a b"), lic.Template("q", "b b")]).scan([b"a b", text.encode(), b"d"])
    for template in SMALL:
        got = [(s["first"], s["after"]) for s in found["licenses"][1] if s["label"] == template.label]
        assert got == matches(template.markup, words)
    assert len(found["phrases"][1]) == sum(words[i : i + 2] in (["a", "b"], ["b", "b"]) for i in range(len(words)))


def filled(markup, dice, optional):
    """A text that meets the template, with or without its optional regions."""
    while region := re.search(r"<<beginOptional>>((?:(?!<<beginOptional>>).)*?)<<endOptional>>", markup, re.S):
        markup = markup[: region.start()] + (region[1] if optional else " ") + markup[region.end() :]
    for low, high in re.findall(r"<<var;words=(\d+)-(\d+)>>", markup):
        some = " ".join(f"Holder{dice.randrange(99)}" for _ in range(dice.randint(int(low), int(high))))
        markup = re.sub(r"<<var;[^>]*>>", some, markup, count=1)
    return markup


@pytest.mark.parametrize("number", range(len(lic.TEMPLATES)))
def test_every_license_is_found_and_a_changed_word_is_not(number):
    template, dice = lic.TEMPLATES[number], random.Random(number)
    scanner = lic.Scanner([template], lic.PHRASES)
    for optional in (True, False):
        text = filled(template.markup, dice, optional)
        noise = " ".join(f"word{k}" for k in range(30))
        lines = f"{noise}.\n * {text.upper()}\n{noise}"
        assert [s["label"] for s in scanner.scan([lines.encode()])["licenses"][0]] == [template.label]
        mandatory = words_of(re.sub(r"<<beginOptional>>.*?<<endOptional>>|<<[^>]*>>", " ", template.markup, flags=re.S))
        words = words_of(text)
        for word in dice.sample(mandatory, min(4, len(mandatory))):
            # Every occurrence changes, so that no other reading of the text is left.
            changed = " ".join("different" if w == word else w for w in words)
            assert scanner.scan([changed.encode()])["licenses"] == [[]]
        assert scanner.scan([" ".join(words[:-1]).encode()])["licenses"] == [[]] or template.markup.endswith("<<endOptional>>")


def test_documents_as_brute_force(documents):
    rows = lic.find_licenses(documents).collect()
    assert len(rows) == documents.count()
    patterns = [(t, pattern(t.markup)) for t in lic.TEMPLATES]
    some = 0
    for r in rows:
        words = words_of(r["text"])
        spelt = " " + "".join(f"{w} " for w in words)
        assert r["n_words"] == len(words)
        assert [(s["first"], s["after"], s["label"]) for s in r["phrases"]] == phrase_places(words)
        want = {t.label for t, one in patterns if re.search(" " + one.pattern, spelt)}
        assert {s["label"] for s in r["licenses"]} == want
        assert 0 <= r["score"] < 1 and (r["score"] > 0) == bool(r["phrases"] or r["licenses"])
        some += bool(want)
    assert some


@pytest.mark.parametrize(
    "markup",
    ["<<beginOptional>>a", "a<<endOptional>>", "<<var;words=0-3>> a b", "a <<var;words=1-2>> b", "", "a <<other>> b",
     "<<beginOptional>>a b<<endOptional>>", "a b <<var;words=3-1>> c", "a <<beginOptional>>b<<endOptional>>"],
)
def test_faulty_markup_is_refused(markup):
    with pytest.raises(ValueError):
        lic.compile_templates([lic.Template("t", markup)])


def test_long_text_of_beginnings(spark):
    text = "licensed under the apache license version 2 0 permission is hereby " * 40_000
    (row,) = lic.find_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert row["n_words"] == 440_000
    assert len(row["phrases"]) == len(row["licenses"]) == 40_000


def test_odd_rows(odd, none):
    rows = lic.find_licenses(odd.withColumnRenamed("lang", "score")).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert r["n_words"] == len(words_of(r["text"]))
        assert r["score"] == 0 and r["licenses"] == [] and r["a.b"] == 7
    assert lic.find_licenses(none).count() == 0
