"""Quality scores by a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover all of it. Every byte is
embedded, learned filters slide over each chunk, and each filter's maximum over the chunk is
kept. The chunks' maxima are combined by their mean and their maximum over the document,
and a logistic layer makes one probability of both. Nothing but the bytes enters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterstar.llm.common import free_name, labelled_sample, over_texts

CHUNK, OVERLAP = 512, 64
WIDTH, STRIDE = 8, 2
EMBEDDING, FILTERS = 8, 24
CHUNKS_AT_ONCE = 256

# The sample that is learnt from: about this many labelled texts of up to this many bytes.
SAMPLE_TEXTS, SAMPLE_BYTES = 3000, 32_768
EPOCHS, BATCH, RATE, DECAY, CROPPED = 6, 16, 0.01, 1e-5, 0.3


def chunks(data: bytes) -> np.ndarray:
    """Rows of CHUNK bytes, each OVERLAP into the one before; the last ends in zeros."""
    step = CHUNK - OVERLAP
    n = max(1, -(-(len(data) - OVERLAP) // step))
    padded = np.zeros(step * n + OVERLAP, np.uint8)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::step]


@dataclass
class Network:
    """The parameters: `embedding` (256, e), `filters` (width * e, f), `bias` (f), and the
    logistic layer over 2 f combined maxima, `weights` and `intercept`."""

    embedding: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    weights: np.ndarray
    intercept: np.ndarray

    @classmethod
    def start(cls, rng: np.random.Generator) -> Network:
        embedding = rng.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32)
        embedding[0] = 0  # padding
        filters = rng.normal(0, (WIDTH * EMBEDDING) ** -0.5, (WIDTH * EMBEDDING, FILTERS))
        weights = rng.normal(0, 0.1, 2 * FILTERS)
        return cls(embedding, filters.astype(np.float32), np.zeros(FILTERS, np.float32),
                   weights.astype(np.float32), np.zeros(1, np.float32))

    def windows(self, rows: np.ndarray) -> np.ndarray:
        """The byte windows of chunks: (chunks, places, width)."""
        return np.lib.stride_tricks.sliding_window_view(rows, WIDTH, axis=1)[:, ::STRIDE]

    def maxima(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each filter's largest response in each chunk, not below 0, and its place."""
        best = np.empty((len(rows), FILTERS), self.filters.dtype)
        place = np.empty((len(rows), FILTERS), np.int64)
        for a in range(0, len(rows), CHUNKS_AT_ONCE):
            part = self.windows(rows[a : a + CHUNKS_AT_ONCE])
            embedded = self.embedding[part].reshape(-1, WIDTH * EMBEDDING)
            out = (embedded @ self.filters).reshape(len(part), -1, FILTERS)
            at = out.argmax(1)
            place[a : a + len(part)] = at
            best[a : a + len(part)] = np.take_along_axis(out, at[:, None], 1)[:, 0]
        return np.maximum(best + self.bias, 0), place

    def combined(self, best: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Mean and maximum over each document's chunks."""
        counts = np.diff(starts, append=len(best))[:, None]
        mean = np.add.reduceat(best, starts) / counts
        return np.concatenate([mean, np.maximum.reduceat(best, starts)], axis=1)

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        rows = [chunks(t) for t in texts]
        starts = np.cumsum([0, *map(len, rows)])[:-1]
        best, _ = self.maxima(np.concatenate(rows))
        z = self.combined(best, starts) @ self.weights + self.intercept
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))


def gradients(net: Network, texts: list[bytes], labels: np.ndarray) -> tuple[list[np.ndarray], float]:
    """Of the mean logistic loss, in the order of the parameters; and the loss.

    Only a filter's best place in a chunk has a gradient, so the way back touches one window
    per chunk and filter.
    """
    rows = [chunks(t) for t in texts]
    counts = np.array([len(r) for r in rows])
    starts = np.cumsum(counts) - counts
    stacked = np.concatenate(rows)
    owner = np.repeat(np.arange(len(rows)), counts)
    best, place = net.maxima(stacked)
    combined = net.combined(best, starts)
    z = combined @ net.weights + net.intercept
    p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    loss = -np.mean(labels * np.log(p + 1e-9) + (1 - labels) * np.log(1 - p + 1e-9))
    dz = ((p - labels) / len(labels)).astype(np.float32)
    d_weights, d_intercept = combined.T @ dz, dz.sum(keepdims=True)
    d_mean = dz[:, None] * net.weights[:FILTERS] / counts[:, None]
    d_max = dz[:, None] * net.weights[FILTERS:]
    # Chunks that tie for a document's maximum share its gradient.
    top = (best >= combined[owner, FILTERS:]).astype(np.float32)
    top /= np.add.reduceat(top, starts)[owner]
    d_best = (d_mean[owner] + d_max[owner] * top) * (best > 0)
    chunk, unit = np.nonzero(d_best)
    g = d_best[chunk, unit]
    window = net.windows(stacked)[chunk, place[chunk, unit]]
    embedded = net.embedding[window].reshape(len(chunk), -1)
    d_filters = np.zeros((FILTERS, WIDTH * EMBEDDING), np.float32)
    np.add.at(d_filters, unit, embedded * g[:, None])
    d_embedding = np.zeros_like(net.embedding)
    back = (net.filters.T[unit] * g[:, None]).reshape(-1, EMBEDDING)
    np.add.at(d_embedding, window.ravel(), back)
    d_embedding[0] = 0
    d_bias = np.bincount(unit, weights=g, minlength=FILTERS).astype(np.float32)
    return [d_embedding, d_filters.T, d_bias, d_weights, d_intercept], float(loss)


def _cropped(text: bytes, rng: np.random.Generator) -> bytes:
    """Now and then a short run of a training text, so that short texts are not unknown."""
    size = int(rng.integers(24, 320))
    if rng.random() > CROPPED or len(text) <= size:
        return text
    start = int(rng.integers(0, len(text) - size))
    return text[start : start + size]


def train(texts: list[bytes], labels: np.ndarray, seed: int = 11) -> Network | float:
    """A network fitted to texts and labels 0 or 1; their mean if there is only one label."""
    if not len(labels) or labels.min() == labels.max():
        return float(labels.mean()) if len(labels) else 0.5
    rng = np.random.default_rng(seed)
    net = Network.start(rng)
    net.intercept[:] = np.log(labels.mean() / (1 - labels.mean()))
    names = ("embedding", "filters", "bias", "weights", "intercept")
    first = [np.zeros_like(getattr(net, n)) for n in names]
    second = [np.zeros_like(getattr(net, n)) for n in names]
    step, steps = 0, EPOCHS * -(-len(texts) // BATCH)
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for a in range(0, len(order), BATCH):
            pick = order[a : a + BATCH]
            seen = [_cropped(texts[i], rng) for i in pick]
            grads, _ = gradients(net, seen, labels[pick].astype(np.float32))
            step += 1
            rate = RATE * (1 - step / (steps + 1))
            for n, g, m, v in zip(names, grads, first, second):
                value = getattr(net, n)
                g = g + DECAY * value
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                value -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def fit(docs: DataFrame, labelled: DataFrame, texts: int = SAMPLE_TEXTS,
        text_bytes: int = SAMPLE_BYTES) -> Network | float:
    """A network from `docs` (id, text) and `labelled` (id, label).

    Learns from at most about `texts` labelled texts of at most `text_bytes` bytes, chosen by
    a hash of id and text; they are gathered on the driver, about 10 MB of them.
    """
    rows = labelled_sample(docs, labelled, texts, most_bytes=text_bytes).collect()
    # The order must not depend on the order of tasks.
    rows.sort(key=lambda r: (r["id"], r["text"], r["label"]))
    return train([r["text"].encode() for r in rows], np.array([r["label"] for r in rows], np.float64))


def score_documents(docs: DataFrame, labels: DataFrame, text_column: str = "text",
                    id_column: str = "doc_id", label_column: str = "quality",
                    learn_from: Column | None = None, score_column: str = "score",
                    keep_text: bool = True) -> DataFrame:
    """`docs` with `score`, the probability of label 1, of every whole text.

    `labels` has the id and a label 0 or 1; it is joined by id to learn, filtered by
    `learn_from` (a condition on the id). Null ids and other labels are not learnt from.
    With labels of one kind the score is that label, without any it is 0.5. Null and empty
    texts are one chunk of padding. Ids may repeat; other columns are kept and not looked at.
    An empty table gives no rows. If `docs` has a column of the score's name, the new one gets
    underscores before its own.
    """
    score_column = free_name(docs, score_column)
    plain = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    wanted = labels.select(F.col(id_column).alias("id"), F.col(label_column).alias("label"))
    wanted = wanted.filter("id is not null and label in (0, 1)")
    if learn_from is not None:
        wanted = wanted.filter(learn_from)
    net = fit(plain, wanted)
    if isinstance(net, float):
        scored = docs.withColumn(score_column, F.lit(net))
        return scored if keep_text else scored.drop(text_column)

    def make():
        def run(batch: pa.RecordBatch) -> dict:
            texts = batch.column(batch.schema.get_field_index(text_column)).to_pylist()
            data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
            return {score_column: np.concatenate([*_parts(net, data)])}

        return run

    scored = over_texts(docs, text_column, f"`{score_column}` double", make, keep=True)
    return scored if keep_text else scored.drop(text_column)


def _parts(net: Network, data: list[bytes], limit: int = 1 << 20) -> Iterator[np.ndarray]:
    """Scores of runs of texts of bounded size: chunks of one run are held at a time."""
    start, size = 0, 0
    for i, text in enumerate(data):
        size += len(text)
        if size > limit or i - start >= 500:
            yield net.probabilities(data[start : i + 1])
            start, size = i + 1, 0
    if start < len(data):
        yield net.probabilities(data[start:])
