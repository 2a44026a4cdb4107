import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from tableworks.llm import pieces
from tableworks.llm.queries import MODEL_PATH

from . import brute
from .conftest import SF
from .test_decontaminate import best
from .test_similar_texts import similar_groups


def test_is_registered():
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    assert [name.split("_")[0] for name in contract.queries() if name.startswith("op")] == [f"op{k}" for k in range(1, 14)]


def test_stages_as_brute_force(spark, tmp_path):
    """Every stage against plain Python on its own input; quality's verdict against its SQL."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        rows = {r["doc_id"]: r for r in docs.collect()}
        assert len(rows) == docs.count()
        if name != "pieces":
            assert docs.columns == columns
            kept = {k: r["text"] for k, r in rows.items()}
        if name == "quality_rules":
            judged = contract.queries()["op6_quality_rules"](spark, SF)
            assert set(kept) == {r["doc_id"] for r in judged.where("kept").collect()}
        elif name == "near_copies":
            ids = sorted(before)
            groups = similar_groups([before[k] for k in ids])
            assert set(kept) == {ids[g] for g in groups}
        elif name == "decontaminate":
            assert set(kept) == {k for k, t in before.items() if max(best(t, i) for i in items) < 0.8}
        elif name == "secrets":
            assert all(not brute.secrets(t) for t in kept.values())
            clean = [k for k, t in before.items() if not brute.secrets(t)]
            assert all(kept[k] == before[k] for k in clean)
            assert all(r["n_chars"] == len(r["text"]) for r in rows.values())
        else:
            vocabulary = pieces.load(MODEL_PATH)
            for k, row in rows.items():
                assert vocabulary.decode(np.array(row["pieces"], np.int64)).decode() == before[k]
        before = kept
    assert before


CLASHING = "kept string, n_words long, base_failed string, _rank string, _root long, _bits int, fingerprint_bits long, row string, node string"


def test_columns_of_any_name_keep_their_values(spark, odd):
    values = ("old", 5, "x", "r", 7, 8, 9, "row", "n")
    names = [part.split()[0] for part in CLASHING.split(", ")]
    extra = spark.createDataFrame([values], CLASHING)
    docs = odd.drop("kept").crossJoin(F.broadcast(extra))
    types = dict(docs.dtypes)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert dict(docs.dtypes) == types
        assert {tuple(r) for r in docs.select(*names).collect()} == {values}


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows_pass_through_every_stage(spark, odd, empty):
    docs = odd.where(F.lit(False)) if empty else odd
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, SF)
        if name != "pieces":
            assert found.columns == odd.columns
        assert found.count() <= odd.count()


def test_run(spark):
    found = corpus_pipeline.run(spark, SF)
    assert found.where("NOT round_trip").count() == 0 and found.count() > 100
