import numpy as np
import pytest
from pyspark.sql import functions as F

from tableworks.llm import near_copies as nc
from tableworks.llm import similar_texts as st

from . import brute


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = brute.WORD.findall(lower)
    if not words:
        return frozenset()
    return frozenset(" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def links(texts):
    """All pairs with a similarity of 0.8, by the texts' shingles."""
    sets, holders = [shingles(t) for t in texts], {}
    for i, own in enumerate(sets):
        for s in own or {""}:
            holders.setdefault(s, []).append(i)
    seen = {(i, j) for held in holders.values() for i in held for j in held if j < i}
    return [(i, j) for i, j in seen if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]


def similar_groups(texts):
    """Smallest index reachable from each text."""
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in links(texts):
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


def test_shingles_as_brute_force(documents):
    texts = [r["text"] for r in documents.collect()] + ["", " \t", "One", "a b c d", "A b c d e", "x y x y x y x y x y"]
    found = st._shingles(st.pa.array(texts, st.pa.string()))
    for text, (node, own) in zip(texts, found, strict=True):
        assert len(own) == len(shingles(text)) and (node == 0) == (not shingles(text))


def test_chance_of_a_shared_fingerprint():
    dice = np.random.default_rng(1)
    met = apart = 0
    for _ in range(300):
        whole = dice.integers(0, 2**63, 130, np.uint64)
        one, two, other = np.unique(whole[:115]), np.unique(whole[15:]), np.unique(dice.integers(0, 2**63, 100, np.uint64))
        met += bool((st.fingerprints(one) == st.fingerprints(two)).any())
        apart += bool((st.fingerprints(one) == st.fingerprints(other)).any())
    # 100 of 130 shared: a similarity of 0.77.
    assert met > 0.95 * 300 and apart == 0


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_recall_and_precision_on_documents(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet")
    rows = docs.orderBy("doc_id").collect()
    texts = [r["text"] for r in rows]
    want = similar_groups(texts)
    kept = {r["doc_id"] for r in st.one_of_similar(docs).collect()}
    right = {rows[g]["doc_id"] for g in want}
    # Every group keeps its first; of those that should go, hardly any stays.
    assert right <= kept
    assert len(kept - right) <= 0.02 * (len(rows) - len(right))


def test_no_link_below_the_threshold(spark):
    words = [f"w{k}" for k in range(60)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:-1])), (3, " ".join([*words[:40], "x", *words[41:]])), (4, " ".join(words[20:]))]
    rows += [(5, " ".join(words).upper()), (6, "a b"), (7, "A  B"), (8, "a b c"), (9, None), (10, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(r["doc_id"] for r in st.one_of_similar(docs).collect())
    groups = similar_groups([t for _, t in rows])
    assert kept == [rows[g][0] for g in sorted(set(groups))]


def test_odd_rows(odd, none):
    kept = st.one_of_similar(odd)
    assert kept.columns == odd.columns and kept.dtypes == odd.dtypes
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 4, 5, 6]
    assert st.one_of_similar(none).count() == 0


def test_a_large_group_of_near_copies(spark):
    words = [f"w{k}" for k in range(80)]
    docs = spark.range(2000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit(" ".join(words) + " "), F.col("id").cast("string")).alias("text")
    )
    assert [r["doc_id"] for r in st.one_of_similar(docs).collect()] == [0]


def test_texts_meet_in_the_trees_of_near_copies(spark, monkeypatch):
    """The operator's own fingerprints make candidates, without any sample; similarity decides."""
    called = []
    monkeypatch.setattr(st, "near_copies", lambda *a: called.append(a) or nc.near_copies(*a))
    begun = [" ".join(f"w{k}" for k in range(size)) for size in range(200, 300)]
    bits = [nc.fingerprint(text.encode()) for text in begun]
    base, near = next(
        begun[k : k + 2] for k in range(99) if 0 < (bits[k] ^ bits[k + 1]).bit_count() <= nc.RADIUS
    )
    other = " ".join(f"v{k}" for k in range(400))
    texts = [base, near, other, other.upper(), None]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    marked = st.with_text_columns(docs.select(st._key("text"), "text"), "text", st._marks, "node long, prints array<bigint>")
    marked = marked.withColumn("prints", F.slice("prints", 1, 0)).cache()
    node = {r["text"]: r["node"] for r in marked.collect()}
    found = st.similar_links(docs, marked, "text").collect()
    assert [(r["a"], r["b"]) for r in found] == [tuple(sorted((node[base], node[near]), reverse=True))]
    assert len(called) == 1


def test_samples_meet_in_trees(spark):
    far = [1 << 60, 2**40 - 1, -1]
    rows = [(n, n, [p]) for n, p in enumerate([5, 5, 4, *far])]
    met = st.met_sampled(spark.createDataFrame(rows, "key long, node long, prints array<bigint>"))
    pairs = sorted(tuple(r) for r in st.candidate_pairs(met).collect())
    # Equal ones, and those that differ in one bit.
    assert pairs == [(1, 0), (2, 0), (2, 1)]


@pytest.mark.parametrize("pivots", [(), (16,)])
def test_all_pairs_of_a_place_are_compared(spark, monkeypatch, pivots):
    """Similar texts of one place whose first and last texts are like none of them."""
    monkeypatch.setattr(st, "PIVOTS", pivots, raising=False)
    line = [f"c{k}" for k in range(30)]
    texts = []
    for group in range(12):
        own = [f"g{group}w{k}" for k in range(100)]
        texts += [" ".join([*own, *line]), " ".join([*own, *line, "more"]), " ".join([*own[:80], *line])]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    marked = st.with_text_columns(docs.select(st._key("text"), "text"), "text", st._marks, "node long, prints array<bigint>")
    marked = marked.withColumn("prints", F.array(F.lit(7).cast("long"))).cache()
    node = {r["text"]: r["node"] for r in marked.collect()}
    groups = {r["node"]: r["root"] for r in nc.components(st.similar_links(docs, marked, "text")).collect()}
    found = [groups.get(node[t], node[t]) for t in texts]
    wanted = similar_groups(texts)
    assert len(set(wanted)) == 24
    assert [found.index(f) for f in found] == wanted


def test_no_similar_pair_fails_the_prefix_filter(spark):
    """Random sets around 0.8, of common and rare shingles, against all pairs."""
    dice, sets = np.random.default_rng(3), []
    for base in range(20):
        whole = np.r_[dice.choice(40, 25, replace=False), 1000 * (base + 1) + np.arange(dice.integers(0, 60))]
        sets += [whole[dice.random(len(whole)) > dice.choice([0, 0.05, 0.1, 0.2])] for _ in range(6)]
    sets = [set(map(int, s)) for s in sets] + [{1}, {1, 2}, {2, 1, 3, 4}, {1, 2, 3, 4, 5}, set()]
    rows = [(n, sorted(s)) for n, s in enumerate(sets)]
    nodes = spark.createDataFrame(rows, "node long, shingles array<bigint>")
    links = nodes.where("node % 6 = 1").selectExpr("node as a", "node - 1 as b")
    pairs = {(r["a"], r["b"]) for r in st.sharing_pairs(st.rare_shingles(nodes), links).collect()}
    apart = [(i, j) for i in range(len(sets)) for j in range(i) if not (i % 6 == 1 and j == i - 1)]
    similar = {(i, j) for i, j in apart if sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])}
    assert len(similar) > 100 and similar <= pairs
    assert len(pairs) < len(apart) / 2 and pairs <= set(apart)
