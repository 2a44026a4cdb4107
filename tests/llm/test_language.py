import numpy as np
from pyspark.sql import functions as F

from tableworks.llm import language as lg
from tableworks.llm.shared import training_row

from .conftest import SF


def bundle(text):
    """The same vector by a loop over the letters."""
    letters = [int(lg.letter_numbers()[ord(c)]) for c in text]
    seen = [0]
    for k in letters:
        if k or seen[-1]:
            seen.append(k)
    if seen[-1]:
        seen.append(0)
    base = lg._vectors()[2]
    total = np.zeros(lg.DIMENSIONS)
    for a, b, c in zip(seen, seen[1:], seen[2:], strict=False):
        total += np.roll(base[a], 2) * np.roll(base[b], 1) * base[c]
    return total


def test_bundles_equal_a_loop():
    for text in ("a", "The cat, the hat.", "été à l'école -- ß", "x1y  zz"):
        codes, counts = lg._counted([text])
        assert np.allclose(counts[0] @ lg.trigram_vectors(codes), bundle(text))


def test_cosine_with_prototypes():
    texts = {"en": "the cat sat on the mat", "de": "der hund ist nicht im haus"}
    counts = {}
    for name, text in texts.items():
        values, n = np.unique(lg.trigrams(text), return_counts=True)
        counts[name] = lg.bundle(values, n)
    found = lg.Profiles(counts).predict(["the mat", "ist im haus", "", "12 !"])
    assert found[0] == ["en", "de", "und", "und"]
    a, b = bundle("the mat"), bundle(texts["en"])
    assert abs(found[1][0] - a @ b / np.linalg.norm(a) / np.linalg.norm(b)) < 1e-4
    assert found[1][2:] == [0.0, 0.0]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(SF.replace("0.001", "0.01") + "/documents.parquet")
    profiles = lg.learn(docs.where(training_row(F.col("doc_id"))))
    rest = lg.identify(docs.where(~training_row(F.col("doc_id"))), profiles)
    assert rest.where("lang_pred = lang").count() >= 0.97 * rest.count()


def test_odd_rows(spark, odd, none):
    profiles = lg.learn(odd)
    assert profiles.names == ["en", "es"]
    rows = lg.identify(odd, profiles).collect()
    assert len(rows) == odd.count()
    for row in rows:
        letters = any(c.isalpha() for c in row["text"] or "")
        assert (row["lang_pred"] in profiles.names) == letters and 0 <= row["score"] <= 1
    assert all(r["lang_pred"] == "und" for r in lg.identify(odd, lg.learn(none)).collect())
    assert lg.identify(none, profiles).count() == 0
    nothing = spark.createDataFrame([(None, None)], "text string, lang string")
    assert lg.learn(nothing).names == []


def test_pages_of_languages(spark, odd, monkeypatch):
    """Seven languages, two to a page or so, against all of them at once."""
    words = ["der hund", "the cat", "le chien", "el gato", "il cane", "o cachorro", "hunden er", ""]
    rows = [(f"l{n % 7}", f"{words[n % 8]} {words[n % 7]} {'xyz'[n % 3] * n}") for n in range(40)]
    docs = spark.createDataFrame([*rows, (None, None)], "lang string, text string")
    odd = odd.withColumnsRenamed({name: "_Score" for name in odd.columns if name == "source"})
    whole = lg.learn(docs)
    monkeypatch.setattr(lg, "PAGE", 2)
    paged = lg.learn(docs)
    names = [name for page in paged.pages() for name in page.names]
    assert isinstance(paged, lg.PagedProfiles) and sorted(names) == whole.names
    for table in (docs, odd):
        want, found = lg.identify(table, whole), lg.identify(table, paged)
        assert found.columns == want.columns
        assert sorted(map(repr, found.collect())) == sorted(map(repr, want.collect()))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") <= 1
