import numpy as np
from pyspark.sql import functions as F

from tableworks.llm import quality_model as qm
from tableworks.llm.shared import training_row

from .conftest import SF


def plain_score(network, text):
    """The same probability, position by position."""
    block = qm.SEGMENT * qm.STEP
    segments = max(1, -(-len(text) // block))
    data = text + bytes(segments * block + qm.WIDTH - len(text))
    best = []
    for s in range(segments):
        found = []
        for k in range(qm.SEGMENT):
            at = s * block + k * qm.STEP
            if s == segments - 1 and k == qm.SEGMENT - 1:
                continue  # would look beyond the text's own segments
            window = network.embedding[list(data[at : at + qm.WIDTH])].ravel()
            found.append(window @ network.filters + network.bias)
        best.append(np.max(found, axis=0))
    chunks = [np.maximum(np.max(best[s : s + 2], axis=0), 0) for s in range(segments)]
    features = np.concatenate([np.max(chunks, axis=0), np.mean(chunks, axis=0)])
    return 1 / (1 + np.exp(-(features @ network.out + network.out_bias[0])))


def test_scores_equal_the_plain_form():
    network = qm.ByteNetwork(1)
    texts = [b"", b"a", b"x" * 255, bytes(range(256)) * 5, "é ü".encode() * 300]
    assert np.allclose(network.scores(texts), [plain_score(network, t) for t in texts], atol=1e-5)


def test_the_end_of_a_long_text_counts():
    network = qm.ByteNetwork(1)
    long = b"plain words " * 50_000
    assert network.scores([long])[0] != network.scores([long + b"@@## zz!!" * 40])[0]


def test_gradients_are_those_of_the_loss():
    texts, labels = [b"hello world of text " * 20, b"!! ?? !!" * 90, b"z"], np.array([1, 0, 1], np.float32)
    network = qm.ByteNetwork(2)
    for p, grad in zip(network.parameters, network.gradients(texts, labels), strict=True):
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        losses = []
        old = p[at]
        for step in (2e-3, -2e-3):
            p[at] = old + step
            s = network.scores(texts)
            losses.append(-np.mean(labels * np.log(s) + (1 - labels) * np.log(1 - s)))
        p[at] = old
        assert np.isclose(grad[at], (losses[0] - losses[1]) / 4e-3, rtol=0.05, atol=1e-4)


def test_held_out_accuracy(spark):
    folder = SF.replace("0.001", "0.1")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet").join(labels, "doc_id")
    network = qm.fit(docs, labels.where(training_row(F.col("doc_id"))))
    rest = qm.score(docs.where(~training_row(F.col("doc_id"))).select("text", "quality"), network).collect()
    right = np.mean([r["predicted"] == r["quality"] for r in rest])
    low = [r["predicted"] == 0 for r in rest if r["quality"] == 0]
    assert right >= 0.95 and np.mean(low) >= 0.8


def test_odd_rows(odd, none):
    network = qm.fit(odd, odd.select("doc_id", F.when(F.col("doc_id") == 5, 0).otherwise(1).alias("quality")))
    rows = qm.score(odd, network).collect()
    assert len(rows) == odd.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert len({r["score"] for r in rows if not r["text"]}) == 1
    assert qm.score(none, network).count() == 0
    untrained = qm.fit(odd, none.select("doc_id", F.lit(1).alias("quality")))
    assert {r["score"] for r in qm.score(odd, untrained).collect()} == {0.5}
    one_class = qm.fit(odd, odd.select("doc_id", F.lit(1).alias("quality")))
    assert {r["predicted"] for r in qm.score(odd, one_class).collect()} == {1}
