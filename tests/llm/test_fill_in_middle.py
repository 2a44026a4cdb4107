import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tableworks.llm import fill_in_middle as fim
from tableworks.llm import queries

LINE = re.compile(r"[^\n]*\n|[^\n]+")


def brute(doc_id, text, seed=7, percent=100, spm=50):
    text = text or ""
    units = LINE.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(m in text for m in fim.MARKERS) or h[2] % 100 >= percent:
        return len(units), "plain", None, None, text
    p, m, s = ("".join(part) for part in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


SHAPES = {
    "array": np.array([0, 7, 300, 65_535]),
    "runs": np.r_[5:4000, 9000:9100],
    "bitmap": np.arange(0, 60_000, 2),
    "sparse containers": np.r_[3, 70_000:70_500, 1_000_000, 1 << 33],
    "whole container": np.arange(1 << 16, 3 << 16),
    "none": np.zeros(0, np.int64),
}


@pytest.mark.parametrize("name", SHAPES)
def test_select_is_indexing(name):
    values = SHAPES[name].astype(np.int64)
    found = fim.BoundarySet(values)
    ranks = np.random.default_rng(1).permutation(len(values))
    assert len(found) == len(values)
    assert found.select(ranks).tolist() == values[ranks].tolist()


def test_containers_are_the_smallest():
    kinds = {"array": fim.ArrayContainer, "runs": fim.RunContainer, "bitmap": fim.BitmapContainer}
    for name, kind in kinds.items():
        assert type(fim.container(SHAPES[name])) is kind


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.text("a\né😀<P>", max_size=30), st.integers(0, 2**32 - 1), st.integers(0, 2**32 - 1)), min_size=1))
def test_cuts_as_brute_force(rows):
    texts, *drawn = zip(*rows, strict=True)
    count, cuts = fim.line_cuts([t.encode() for t in texts], [np.array(d) for d in drawn])
    for i, text in enumerate(texts):
        units = LINE.findall(text)
        assert count[i] == len(units)
        for cut, draw in zip(cuts, drawn, strict=True):
            assert cut[i] == len("".join(units[: draw[i] % (len(units) + 1)]))


def test_documents_as_brute_force(documents):
    back = fim.restored(F.col("output"), F.col("form"))
    rows = fim.fill_in_middle(documents).withColumn("back", back).collect()
    assert {"spm", "psm"} <= {r["form"] for r in rows}
    for r in rows:
        want = brute(r["doc_id"], r["text"])
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == want
        assert r["back"] == (r["text"] or "")


HARD = ["a\n<", "<S\n<", "<\n<\nS>\nP>\n", "<P\n>\n", "x<M>y\n", "\n\n\n", "é\n😀\n\x00\n", "<", "a" * 9 + "\r\nb"]


def test_hard_texts_come_back(spark):
    rows = [(k, text) for k in range(60) for text in HARD]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    back = fim.restored(F.col("output"), F.col("form"))
    for r in fim.fill_in_middle(docs, percent=70, spm_percent=40).withColumn("back", back).collect():
        assert r["back"] == r["text"]
        assert r["output"] == brute(r["doc_id"], r["text"], percent=70, spm=40)[-1]


def test_long_text_of_many_lines(spark):
    text = "line é\n" * 400_000 + "\n" * 200_000
    docs = spark.createDataFrame([(3, text), (4, text)], "doc_id long, text string")
    for r in fim.fill_in_middle(docs).collect():
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == brute(r["doc_id"], text)


def test_odd_rows(odd, none):
    named = odd.withColumnsRenamed({"lang": "form", "source": "_cut"})
    found = fim.fill_in_middle(named)
    assert found.columns.count("form") == 1
    rows = found.collect()
    assert len(rows) == odd.count()
    for r in rows:
        want = brute(r["doc_id"], r["text"])
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == want
        assert r["Score"] == "old" and r["a.b"] == 7 and r["_cut"] in (None, "s", "t")
    assert fim.fill_in_middle(none).count() == 0


def test_overlapping_markers_are_refused(odd):
    for markers in (("<P>", "<P>", "<M>"), ("aba", "<S>", "<M>"), ("", "x", "y"), ("ab", "bc", "d")):
        with pytest.raises(ValueError):
            fim.fill_in_middle(odd, markers=markers)


def test_no_shuffle(spark):
    plan = queries.op11_fill_in_middle(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Exchange" not in plan
