import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tableworks.llm import pieces
from tableworks.llm.queries import MODEL_PATH


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load(MODEL_PATH)


@pytest.fixture(scope="module")
def tiny():
    """A vocabulary with many equal scores and overlaps."""
    own = ["▁", "a", "b", "c", "ab", "bc", "abc", "▁a", "ca", "▁▁", "aa", "aaa", "bd"]
    found = [(text, -float(1 + k % 5), k + 300) for k, text in enumerate(own)]
    return pieces.Vocabulary(found, {k: k for k in range(256)}, 299)


def every(vocabulary, text):
    """All segmentations of a text: (score, ids), by plain recursion over whole texts."""
    codes = [pieces.LITERAL if c == "▁" else ord(c) for c in text]
    codes = [pieces.BLANK] + [pieces.BLANK if c == 0x20 else c for c in codes]
    own = [int(vocabulary.classes[c]) for c in codes]

    def upto(j):
        if j == 0:
            return [(0.0, ())]
        found = []
        for i in range(max(0, j - vocabulary.longest), j):
            piece = vocabulary.by_text.get(tuple(own[i:j])) if all(own[i:j]) else None
            if piece:
                put = tuple(vocabulary.stand_ins.get(piece[1], (piece[1],)))
                found += [(score + piece[0], ids + put) for score, ids in upto(i)]
        if not own[j - 1]:
            spelt = tuple(vocabulary.spelt(codes[j - 1]))
            found += [(s + vocabulary.unknown_score, ids + spelt) for s, ids in upto(j - 1)]
        return found

    return sorted(upto(len(own)), key=lambda x: -x[0])


def applied(ids, edits):
    out = list(ids)
    for at, cut, put in sorted(edits, reverse=True):
        out[at : at + cut] = put
    return tuple(out)


@pytest.mark.parametrize("n", [1, 2, 4, 9])
def test_n_best_equal_brute_force(tiny, n):
    dice = random.Random(n)
    texts = ["".join(dice.choice("aabbcd ▁é") for _ in range(dice.randrange(1, 11))) for _ in range(60)]
    ids, nbest = tiny.encode(texts, n)
    for text, own, ways in zip(texts, ids, nbest, strict=True):
        want = every(tiny, text)
        assert [score for score, _ in ways] == pytest.approx([s for s, _ in want[:n]])
        valid, seen = dict((i, s) for s, i in want), set()
        for score, edits in ways:
            found = applied(own.tolist(), edits)
            assert valid[found] == pytest.approx(score)
            assert tiny.decode(np.array(found)).decode() == text
            seen.add(found)
        assert len(seen) == len(ways)


def test_long_stretches_equal_short_ones(tiny, monkeypatch):
    text = "abcaabca" * 4
    together = tiny.encode([text], 4)
    monkeypatch.setattr(pieces, "TOGETHER", 8)
    split = tiny.encode([text], 4)
    assert [s for s, _ in together[1][0]] == pytest.approx([s for s, _ in split[1][0]])
    assert tiny.decode(split[0][0]).decode() == text


@pytest.mark.parametrize(
    "text", ["", " ", "hello", "  two  blanks ", "▁literal▁", "日本語\n\t\u0000", "\U0001f600é", "x" * 100_000, "﷐"]
)
def test_round_trip(vocabulary, text):
    ids, nbest = vocabulary.encode([text, "other", text], 3)
    assert vocabulary.decode(ids[0]).decode() == text and (ids[0] == ids[2]).all()
    for _, edits in nbest[0]:
        assert vocabulary.decode(np.array(applied(ids[0].tolist(), edits), np.int64)).decode() == text


def test_a_long_word_leaves_the_rest_of_its_block_alone(vocabulary):
    texts = ["a, b. c; 1 2 3", "cat bat rat 4 5 6 ?!", "x" * 60, "y" + "x" * 60, "é ü 7"]
    ids, nbest = vocabulary.encode(texts, 4)
    for text, own, ways in zip(texts, ids, nbest, strict=True):
        (alone,), (ways_alone,) = vocabulary.encode([text], 4)
        assert own.tolist() == alone.tolist() and vocabulary.decode(own).decode() == text
        assert [s for s, _ in ways] == pytest.approx([s for s, _ in ways_alone])


def test_documents(spark, documents, odd, none):
    held = pieces.broadcast(spark, MODEL_PATH)
    for docs in (documents, odd):
        encoded = pieces.encode(docs, held, keep_text=True)
        back = pieces.decode(encoded, held)
        assert back.count() == docs.count()
        assert back.where(~F.col("round_trip") | ~F.coalesce("text", F.lit("")).eqNullSafe(F.col("decoded"))).count() == 0
    assert pieces.encode(none, held).count() == 0
    assert pieces.encode(odd, held).columns == [*(c for c in odd.columns if c != "text"), "pieces", "nbest", "round_trip"]
