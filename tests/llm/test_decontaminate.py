import random
import re

import numpy as np
import pytest

from tableworks.llm import decontaminate as dc

WORDS = [a + b for a in "bcdfg" for b in ("ab", "et", "il", "or", "un")]


def bag(words):
    k = min(5, max(1, len(words)))
    return [tuple(words[i : i + k]) for i in range(len(words) - k + 1)]


def jaccard(a, b):
    a, b = list(a), list(b)
    left = list(b)
    shared = 0
    for x in a:
        if x in left:
            left.remove(x)
            shared += 1
    return shared / (len(a) + len(b) - shared)


def words_of(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())


def best(text, item):
    words, own = words_of(text), words_of(item)
    if not own:
        return 0
    spans = [words[i : i + len(own)] for i in range(len(words) - len(own) + 1)]
    return max((jaccard(bag(s), bag(own)) for s in spans), default=0)


@pytest.fixture(scope="module")
def tables(spark):
    dice = random.Random(4)
    items = [" ".join(dice.choice(WORDS) for _ in range(n)) for n in (2, 4, 5, 14, 30, 40, 59, 60)]
    items += [items[4], "", "?!"]
    texts = []
    for k in range(60):
        words = [dice.choice(WORDS) for _ in range(dice.randrange(0, 120))]
        own = items[k % 8].split()
        if k % 3:
            for _ in range(k % 4):
                own[dice.choice((0, len(own) - 1, len(own) // 2))] = "other"
            at = dice.randrange(len(words) + 1)
            words[at:at] = own
        texts.append(dice.choice((" ", ", ", "\n")).join(words).title())
    docs = spark.createDataFrame(list(enumerate([*texts, None, ""])), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)) + [(None, None)], "item_id long, text string")
    return docs, bench


def test_matches_equal_brute_force(tables):
    docs, bench = tables
    items = [(r["item_id"], r["text"]) for r in bench.collect()]
    want = {}
    for row in docs.collect():
        for item_id, item in items:
            alike = best(row["text"], item)
            if alike >= 0.8:
                want[row["doc_id"], item_id] = round(alike, 9)
    rows = dc.contaminated(docs, bench).collect()
    found = {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in rows}
    assert found == want and len(want) > 30
    assert len({s for s in want.values()}) > 3
    kept = {r["doc_id"] for r in dc.without_contaminated(docs, bench).collect()}
    assert kept == {r["doc_id"] for r in docs.collect()} - {d for d, _ in want}


def best_or_whole(text, item):
    """As ``best``; a text of fewer words than the item is one window."""
    words, own = words_of(text), words_of(item)
    if not words or len(words) >= len(own):
        return best(text, item)
    return jaccard(bag(words), bag(own))


def test_texts_shorter_than_an_item(spark, tables):
    _, bench = tables
    items = [(r["item_id"], r["text"]) for r in bench.collect()]
    texts = []
    for _, item in items:
        words = words_of(item)
        for cut in range(1, 14):
            texts += [" ".join(words[:-cut]), " ".join(words[cut:]), " ".join(words[cut // 2 : -cut]).title()]
            texts.append(" ".join([*words[:7], "other", *words[8:-cut]]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {}
    for doc_id, text in enumerate(texts):
        for item_id, item in items:
            alike = best_or_whole(text, item)
            if alike >= 0.8:
                want[doc_id, item_id] = round(alike, 9)
    rows = dc.contaminated(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in rows} == want and len(want) > 60
    whole = {(d, i) for d, i in want if len(words_of(texts[d])) < len(words_of(dict(items)[i]))}
    assert len(whole) > 60
    for r in rows:
        if (r["doc_id"], r["item_id"]) in whole:
            assert (r["first_word"], r["n_words"], r["n_windows"]) == (0, len(words_of(texts[r["doc_id"]])), 1)
    kept = {r["doc_id"] for r in dc.without_contaminated(docs, bench).collect()}
    assert kept == set(range(len(texts))) - {d for d, _ in want}


def test_several_passes_are_one(tables, monkeypatch):
    docs, bench = tables
    whole = sorted(map(str, dc.contaminated(docs, bench).collect()))
    monkeypatch.setattr(dc, "PASS_BYTES", 400)
    assert len(list(dc._passes(bench, "item_id", "text"))) > 3
    assert sorted(map(str, dc.contaminated(docs, bench).collect())) == whole
    kept = dc.without_contaminated(docs, bench)
    assert kept.columns == docs.columns


def test_fifty_thousand_items_take_one_scan(spark):
    draw = np.random.default_rng(6)
    words = np.array([f"{a}{b}" for a in WORDS for b in WORDS])
    items = [" ".join(draw.choice(words, 12 + k % 25)) for k in range(50_000)]
    planted, texts = {}, []
    for k in range(300):
        at = int(draw.integers(len(items)))
        own = items[at].split()
        if k % 2:
            own[0] = "other"
        texts.append(" ".join([*draw.choice(words, 40), *own, *draw.choice(words, 40)]))
        planted[k] = at
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    assert len(list(dc._passes(bench, "item_id", "text"))) == 1
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in dc.contaminated(docs, bench).collect()}
    asked = set(planted.values())
    holds = {}
    for at in asked:
        for shingle in bag(items[at].split()):
            holds.setdefault(shingle, set()).add(at)
    want = {}
    for doc_id, text in enumerate(texts):
        for at in set().union(*(holds.get(s, ()) for s in bag(text.split()))):
            alike = best(text, items[at])
            if alike >= 0.8:
                want[doc_id, at] = round(alike, 9)
    assert {pair: s for pair, s in found.items() if pair[1] in asked} == want
    assert set(want) >= {(k, at) for k, at in planted.items() if len(items[at].split()) >= 14 or not k % 2}


@pytest.mark.parametrize("count", [300, 20_000])
def test_index_finds_all_within_radius(count):
    draw = np.random.default_rng(1)
    prints = draw.integers(0, 2**64, count, np.uint64)
    queries = []
    for k in range(200):
        flips = draw.choice(64, k % 24, replace=False)
        queries.append(prints[k] ^ np.bitwise_xor.reduce(np.uint64(1) << flips.astype(np.uint64), initial=np.uint64(0)))
    queries = np.array(queries, np.uint64)
    got = set(zip(*(x.tolist() for x in dc.HammingIndex(prints).near(queries)), strict=True))
    distance = np.bitwise_count(queries[:, None] ^ prints[None, :])
    assert got == set(zip(*(x.tolist() for x in np.nonzero(distance <= dc.RADIUS)), strict=True))


def test_odd_rows(odd, none, tables):
    _, bench = tables
    assert dc.contaminated(odd, bench).count() == 0
    assert dc.contaminated(none, bench).count() == 0
    assert dc.contaminated(odd, bench.where("item_id < 0")).count() == 0
    assert dc.without_contaminated(odd, bench).columns == odd.columns
    own = odd.where("doc_id = 1").selectExpr("1L AS item_id", "text").limit(1)
    assert {r["doc_id"] for r in dc.contaminated(odd, own).collect()} == {1}
    assert dc.contaminated(odd, own).count() == 2
