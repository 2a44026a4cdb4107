"""Quality classifier: a convolutional network over bytes, trained and applied in numpy.

A text is a row of bytes. Learned filters of ``WIDTH`` embedded bytes run over all of it with a
step of ``STEP``; chunks of two neighbouring segments, each overlapping the next by one, cover the
whole text, and each chunk keeps every filter's largest response. The maximum and the mean over
the chunks enter a logistic unit, which gives one probability.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import hashed_sample
from .texts import as_bytes, quoted, with_text_columns

EMBEDDING, WIDTH, STEP, FILTERS = 6, 8, 4, 24
#: Filter positions in a segment; a chunk is two segments.
SEGMENT = 64
#: Labelled rows that training may use, passes over them, rows in a step.
SAMPLE_ROWS, EPOCHS, BATCH, RATE, SEED = 1600, 5, 32, 0.01, 5

SCORED = "score double, predicted int"


class ByteNetwork:
    def __init__(self, seed: int = SEED):
        draw = np.random.default_rng(seed)
        self.embedding = draw.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32)
        self.filters = draw.normal(0, 0.25, (WIDTH * EMBEDDING, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.out = draw.normal(0, 0.1, 2 * FILTERS).astype(np.float32)
        self.out_bias = np.zeros(1, np.float32)

    @property
    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, self.filters, self.bias, self.out, self.out_bias]

    @staticmethod
    def layout(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All bytes, each text filled up to whole segments and one more window; segments each."""
        block = SEGMENT * STEP
        segments = np.array([max(1, -(-len(text) // block)) for text in texts])
        padded = [t + bytes(n * block - len(t)) for t, n in zip(texts, segments.tolist(), strict=True)]
        return np.frombuffer(b"".join(padded) + bytes(WIDTH), np.uint8), segments

    def responses(self, data: np.ndarray) -> np.ndarray:
        """Filters by position; windows run over a text's end into what follows it.

        What follows is either filling or, for a text that fills its segments, the next text:
        those last windows see WIDTH - STEP foreign bytes, so they are masked by the caller.
        """
        embedded = self.embedding[data].ravel()
        count = (len(data) - WIDTH) // STEP
        stride = embedded.strides[0]
        windows = np.lib.stride_tricks.as_strided(
            embedded, (count, WIDTH * EMBEDDING), (STEP * EMBEDDING * stride, stride)
        )
        return windows @ self.filters + self.bias

    def pooled(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        data, segments = self.layout(texts)
        acts = self.responses(data).reshape(-1, SEGMENT, FILTERS)
        # The last position of a text's last segment looks at bytes of the next text.
        acts[np.cumsum(segments) - 1, -1] = acts[np.cumsum(segments) - 1, 0]
        return data, segments, acts

    def features(self, texts: list[bytes]) -> np.ndarray:
        _, segments, acts = self.pooled(texts)
        best = acts.max(axis=1)
        ends = np.cumsum(segments)
        # A chunk is a segment and the next one of the same text; the last chunk has one.
        chunks = best.copy()
        chunks[:-1] = np.maximum(best[:-1], best[1:])
        chunks[ends - 1] = best[ends - 1]
        chunks = np.maximum(chunks, 0)
        starts = ends - segments
        top = np.maximum.reduceat(chunks, starts)
        mean = np.add.reduceat(chunks, starts) / segments[:, None]
        return np.concatenate([top, mean], axis=1)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        logits = self.features(texts).astype(np.float64) @ self.out + self.out_bias[0]
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))

    def gradients(self, texts: list[bytes], labels: np.ndarray) -> list[np.ndarray]:
        """Of the mean log loss; only the positions that were largest in a chunk pass it on."""
        data, segments, acts = self.pooled(texts)
        where = acts.argmax(axis=1)
        best = np.take_along_axis(acts, where[:, None], axis=1)[:, 0]
        place = where + np.arange(len(acts))[:, None] * SEGMENT
        ends = np.cumsum(segments)
        follows = np.arange(len(acts)) + 1
        follows[ends - 1] = ends - 1
        later = best[follows] > best
        chunks = np.where(later, best[follows], best)
        place = np.where(later, place[follows], place)
        active = np.maximum(chunks, 0)
        starts = ends - segments
        top = np.maximum.reduceat(active, starts)
        mean = np.add.reduceat(active, starts) / segments[:, None]
        found = np.concatenate([top, mean], axis=1)
        error = 1 / (1 + np.exp(-(found @ self.out + self.out_bias[0]))) - labels
        error = (error / len(texts)).astype(np.float32)
        grads = [np.zeros_like(p) for p in self.parameters]
        grads[3], grads[4] = found.T @ error, np.array([error.sum()], np.float32)
        owner = np.repeat(np.arange(len(texts)), segments)
        down = error[owner, None] * self.out[None, FILTERS:] / segments[owner, None]
        first = (active == top[owner]).astype(np.float32)
        first /= np.add.reduceat(first, starts)[owner]
        down = down + first * error[owner, None] * self.out[None, :FILTERS]
        down = down * (chunks > 0)
        rows, columns = np.nonzero(down)
        step, at = down[rows, columns], place[rows, columns]
        window = data[(at * STEP)[:, None] + np.arange(WIDTH)[None, :]]
        inputs = self.embedding[window].reshape(len(at), -1)
        onehot = np.zeros((len(at), FILTERS), np.float32)
        onehot[np.arange(len(at)), columns] = step
        grads[1], grads[2] = inputs.T @ onehot, onehot.sum(axis=0)
        back = (step[:, None] * self.filters[:, columns].T).reshape(len(at), WIDTH, EMBEDDING)
        back = back.reshape(-1, EMBEDDING)
        for k in range(EMBEDDING):
            grads[0][:, k] = np.bincount(window.ravel(), back[:, k], 256)
        return grads


def train(texts: list[bytes], labels: list[int]) -> ByteNetwork:
    """Adam with a fixed seed. Classes weigh the same; without both of them scores stay constant."""
    network, goal = ByteNetwork(), np.array(labels, np.float32)
    if not len(goal) or goal.min() == goal.max():
        network.out[:] = 0
        network.out_bias[:] = 0.0 if not len(goal) else (4.0 if goal[0] else -4.0)
        return network
    draw = np.random.default_rng(SEED)
    rare = float(goal.mean() < 0.5)
    few, many = np.flatnonzero(goal == rare), np.flatnonzero(goal != rare)
    means = [np.zeros_like(p) for p in network.parameters]
    squares = [np.zeros_like(p) for p in network.parameters]
    step = 0
    for _ in range(EPOCHS):
        balanced = np.concatenate([many, draw.choice(few, len(many))])
        draw.shuffle(balanced)
        for at in range(0, len(balanced), BATCH):
            own = balanced[at : at + BATCH]
            step += 1
            grads = network.gradients([texts[k] for k in own], goal[own])
            for p, g, m, s in zip(network.parameters, grads, means, squares, strict=True):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return network


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    rows: int = SAMPLE_ROWS,
) -> ByteNetwork:
    """A network from about ``rows`` rows with a label, at most half as many again.

    The labels are sampled first, so that no more than these rows' texts move. A key with several
    labels or texts has them all.
    """
    known = labels.where(quoted(label).isNotNull() & quoted(key).isNotNull())
    sampled = hashed_sample(
        known.select(quoted(key).alias("_key"), quoted(label).cast("int").alias("_label")), rows
    )
    texts = docs.select(
        quoted(key).alias("_own"), F.coalesce(quoted(text).cast("string"), F.lit("")).alias("_text")
    )
    # The sample has a proven bound.
    found = texts.join(F.broadcast(sampled), F.col("_own") == F.col("_key")).select("_text", "_label")
    drawn = found.orderBy(F.xxhash64("_text"), "_text", "_label").limit(rows * 3 // 2).collect()
    return train([row[0].encode() for row in drawn], [int(row[1] > 0) for row in drawn])


def score(docs: DataFrame, network: ByteNetwork, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 from a score of 0.5).

    Null texts are scored as empty ones. Columns of these names give way.
    """
    held = docs.sparkSession.sparkContext.broadcast(network)

    def work(texts: pa.Array) -> dict[str, np.ndarray]:
        found = as_bytes(texts)
        # Sums depend on how rows were batched, in the last digits.
        scores = held.value.scores(found).round(6)
        return {"score": scores, "predicted": (scores >= 0.5).astype(np.int32)}

    return with_text_columns(docs, text, work, SCORED)
