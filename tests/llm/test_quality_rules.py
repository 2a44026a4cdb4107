import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tableworks.llm import quality_rules as qr

from . import brute

COUNTS = [field.split()[0] for field in qr.COUNTS.split(", ")]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("ab \n\té#|\u0085", max_size=60)), max_size=6))
def test_counts_equal_brute_force(texts):
    found = qr.text_counts(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        assert {name: int(found[name][i]) for name in COUNTS} == brute.counts(text)


def test_counts_of_documents(documents):
    for row in qr.quality_rules(documents).collect():
        assert {name: row[name] for name in COUNTS} == brute.counts(row["text"])


def test_far_values_go_and_close_ones_stay(spark):
    plain = " ".join(f"word{k % 7} of number{k}" for k in range(20))
    loud = " ".join(f"word{k}### $$$ ***" for k in range(20))
    rows = [(k, plain.replace("number", f"n{k}x"), "en", "a") for k in range(300)] + [(999, loud, "en", "a")]
    found = qr.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    kept = {r["doc_id"]: r["kept"] for r in found.collect()}
    assert not kept.pop(999) and all(kept.values())


def merged_by_hand(rows):
    """Counts of every language and source with both priors, in fractions."""
    from collections import Counter
    from fractions import Fraction as Q

    own, langs, every = {}, {}, Counter()
    for lang, source, bucket in rows:
        own.setdefault((lang, source), Counter())[bucket] += 1
        langs.setdefault(lang, Counter())[bucket] += 1
        every[bucket] += 1

    def mixed(counts, prior):
        total = sum(prior.values())
        return {b: counts.get(b, 0) + qr.PRIOR * Q(n) / total for b, n in prior.items()}

    found = {}
    for (lang, source), counts in own.items():
        mix = mixed(counts, mixed(langs[lang], every))
        whole, upto, ends = sum(mix.values()), 0, {}
        for b in sorted(mix):
            upto += mix[b]
            for k in (1, 3):
                if 4 * upto >= k * whole:
                    ends.setdefault(k, b)
        found[lang, source] = ends[1], ends[3]
    return found


def test_fences_lean_on_their_language_by_size(spark):
    """Groups of very different sizes, null keys among them, against fractions."""
    import random

    dice = random.Random(4)
    groups = [("en", "a", 900, 4), ("en", "b", 12, 9), ("en", None, 1, 30), ("de", "a", 300, 6), (None, "c", 40, 2)]
    rows = [(lang, source, dice.randint(1, 3) * scale) for lang, source, n, scale in groups for _ in range(n)]
    cells = spark.createDataFrame(rows, "lang string, source string, bucket long").withColumn("metric", F.lit("word_length"))
    parts = []
    for level, keys in enumerate((["lang", "source"], ["lang"], [])):
        counted = cells.groupBy(*keys, "metric", "bucket").agg(F.count("*").alias("n"))
        named = {k: F.col(k) if k in keys else F.lit(None).cast("string") for k in ("lang", "source")}
        parts.append(counted.select(F.lit(level).alias("level"), *[c.alias(k) for k, c in named.items()], "metric", "bucket", "n"))
    found = qr.fences(parts[0].unionByName(parts[1]).unionByName(parts[2])).collect()
    want = merged_by_hand(rows)
    for row in found:
        q1, q3 = want.pop((row["lang"], row["source"]))
        step = qr.REACH * max(q3 - q1, 400)
        assert (row["word_length_low"], row["word_length_high"]) == (q1 - step, q3 + step)
    assert not want


def test_every_group_has_fences_of_its_own(spark):
    """At the size where results are compared with SQL, too."""
    from tableworks.llm.texts import with_text_columns

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    counted = with_text_columns(docs, "text", qr.text_counts, qr.COUNTS)
    found = qr.fences(qr.sketches(counted, "lang", "source")).collect()
    assert len(found) == counted.where(~qr.base_failed()).select("lang", "source").distinct().count()
    ends = [name for name in found[0].asDict() if name.endswith(("_low", "_high"))]
    by_lang = {}
    for row in found:
        by_lang.setdefault(row["lang"], set()).add(tuple(row[e] for e in ends))
    assert sum(map(len, by_lang.values())) >= 2 * len(by_lang)


def test_sketches_merge(spark, documents):
    from tableworks.llm.texts import with_text_columns

    counted = with_text_columns(documents, "text", qr.text_counts, qr.COUNTS)
    found = qr.sketches(counted, "lang", "source")
    totals = {level: n for level, n in found.groupBy("level").sum("n").collect()}
    assert len(set(totals.values())) == 1 and set(totals) == {0, 1, 2}


def test_odd_rows(odd, none):
    found = qr.quality_rules(odd)
    assert [c for c in found.columns if c.lower() == "kept"] == ["kept"]
    rows = found.collect()
    assert len(rows) == odd.count()
    for row in rows:
        assert {name: row[name] for name in COUNTS} == brute.counts(row["text"])
        assert row["Score"] == "old" and row["a.b"] == 7
        assert row["kept"] in (True, False)
    assert [r["kept"] for r in rows if r["doc_id"] == 1] == [True] * 2
    assert qr.quality_rules(none).count() == 0
