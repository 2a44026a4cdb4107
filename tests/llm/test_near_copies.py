import random

import numpy as np
import pytest

from tableworks.llm import near_copies as nc

from . import brute


def test_fingerprints_equal_brute_force(documents):
    for row in nc.with_fingerprints(documents).collect():
        assert row["fingerprint_bits"] % 2**64 == brute.fingerprint(row["text"])


@pytest.mark.parametrize("text", ["", " \t", "One", "One two", "A B C", "É Ü x\x0by z", "a b c d e"])
def test_fingerprint_of_short_texts(text):
    assert nc.fingerprint(text.encode()) == brute.fingerprint(text)


def clustered(n, seed):
    dice = random.Random(seed)
    points = {dice.getrandbits(64) for _ in range(n)}
    for base in list(points)[: n // 10]:
        for _ in range(5):
            base ^= 1 << dice.randrange(64) | 1 << dice.randrange(64)
            points.add(base)
    return sorted(points)


def roots(points, links):
    root = {p: p for p in points}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(p) for p in points]


def test_local_stars_connect_what_is_close(monkeypatch):
    monkeypatch.setattr(nc, "LEAF_SIZE", 32)
    points = clustered(600, 1)
    a, b = nc.local_stars(np.array(points, np.uint64))
    want = [points[k] for k in brute.groups(points)]
    assert roots(points, zip(a.tolist(), b.tolist(), strict=True)) == want


def test_shards_hold_every_close_pair():
    points = clustered(500, 2)
    tree = nc.VantageTree(np.array(points, np.uint64), 16)
    shard, point = tree.deal(np.array(points, np.uint64))
    held = {}
    for s, p in zip(shard.tolist(), point.tolist(), strict=True):
        held.setdefault(p, set()).add(s)
    assert tree.shards > 4
    for i, p in enumerate(points):
        for q in points[:i]:
            if bin(p ^ q).count("1") <= 3:
                assert held[p] & held[q]


def test_dense_points_as_brute_force():
    dice = random.Random(3)
    base = dice.getrandbits(64)
    points = sorted({base ^ sum(1 << dice.randrange(64) for _ in range(4)) % 2**64 for _ in range(150)})
    want = brute.groups(points)
    found = nc._dense_labels(np.array(points, np.uint64), 3)
    assert found.tolist() == want
    assert nc._leaf_labels(np.array(points, np.uint64), 3).tolist() == want


def test_components_of_long_paths(spark):
    links = [(i + 1, i) for i in range(60)] + [(200, 100), (300, 100), (300, 299)]
    found = {r["node"]: r["root"] for r in nc.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(1, 61)} | {200: 100, 300: 100, 299: 100}


def test_no_links(spark):
    assert nc.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_shards_that_are_split_again(spark, monkeypatch):
    for name, value in (("SHARD_SIZE", 50), ("MAX_SHARDS", 3), ("SAMPLE_PER_SHARD", 8), ("LEAF_SIZE", 16)):
        monkeypatch.setattr(nc, name, value)
    points = clustered(900, 5)
    signed = [(p - 2**64 if p >= 2**63 else p,) for p in points]
    links = nc.star_links(spark.createDataFrame(signed, "fingerprint_bits long"))
    assert "part" in links._jdf.queryExecution().toString()
    found = [(r["a"] % 2**64, r["b"] % 2**64) for r in links.collect()]
    assert roots(points, found) == [points[k] for k in brute.groups(points)]
    assert len(found) > 100


@pytest.mark.parametrize("shard,most", [(8192, 1 << 14), (40, 1 << 14), (40, 2)])
def test_near_copies_as_brute_force(documents, monkeypatch, shard, most):
    monkeypatch.setattr(nc, "SHARD_SIZE", shard)
    monkeypatch.setattr(nc, "MAX_SHARDS", most)
    monkeypatch.setattr(nc, "SAMPLE_PER_SHARD", 8 if shard == 40 else 64)
    rows = documents.orderBy("doc_id").collect()
    groups = brute.groups([brute.fingerprint(row["text"]) for row in rows])
    want = {row["doc_id"]: rows[k]["doc_id"] for row, k in zip(rows, groups, strict=True)}
    found = {r["doc_id"]: r["component_id"] for r in nc.near_copies(documents).collect()}
    assert found == want
    kept = nc.one_of_each(documents)
    assert kept.columns == documents.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values()))


def test_odd_rows(odd, none):
    found = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in nc.near_copies(odd).collect()]
    assert len(found) == odd.count()
    empty = {(i, c) for i, f, c in found if f == "0" * 16}
    assert empty == {(2, 2), (3, 2), (None, 2)}
    assert sum(i == 1 and c == 1 for i, _, c in found) == 2
    kept = nc.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 4, 5, 6]
    assert nc.near_copies(none).count() == 0 and nc.one_of_each(none).count() == 0
