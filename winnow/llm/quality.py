"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded, learned filters run over overlapping windows along the whole text,
their responses are max-pooled within overlapping chunks, and the mean and the maximum
over all chunks are combined into one probability.  Training is plain back-propagation
with Adam on a bounded sample: about ``sample_docs`` documents per label, drawn by a
hash of their id, each with all of its chunks, so features are pooled in training as
they are in scoring.  The driver holds the texts of the sample; fewer ``sample_docs``
need less.  Weights restore the shares of the labels.  The fitted numbers are a few
kilobytes and travel with the job.

Defined cases: null and empty texts are scored as one window of zero bytes; a text of
any length is scored as a whole, in blocks; with one label only, or none, the score is
the share of label 1 (0.5 if nothing is known); documents that repeat a label are used
once per label row; repeated rows are scored each; an empty table gives an empty
result; only the named columns are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.llm.langid import joined_bytes
from winnow.llm.sampling import bounded_sample, remainder

CHUNK, STEP = 512, 448
WIDTH, STRIDE = 8, 2
DEPTH, FILTERS = 8, 24
SAMPLE_DOCS = 2_000
STEPS, BATCH, RATE = 750, 64, 0.006
THRESHOLD = 0.3
BLOCK_CHUNKS = 128
PREDICTIONS = "doc_id long, held_out boolean, score double, predicted int"
PLACES = (CHUNK - WIDTH) // STRIDE + 1


def chunk_starts(size: int) -> np.ndarray:
    """Starts of chunks that overlap and together cover ``size`` bytes."""
    return np.arange(0, max(1, size - (CHUNK - STEP)), STEP)


def chunks_of(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """``chunks x CHUNK`` bytes, filled up with zeros after the end."""
    at = starts[:, None] + np.arange(CHUNK)[None, :]
    return np.where(at < len(data), data[np.minimum(at, max(0, len(data) - 1))], 0) if len(data) else np.zeros(at.shape, np.uint8)


class Network:
    """The parameters with forward and backward passes."""

    def __init__(self, seed: int = 3, prior: float = 0.5) -> None:
        rng = np.random.default_rng(seed)
        self.bytes = rng.normal(0, 0.5, (256, DEPTH)).astype(np.float32)
        self.kernel = rng.normal(0, (WIDTH * DEPTH) ** -0.5, (WIDTH * DEPTH, FILTERS)).astype(np.float32)
        self.shift = np.zeros(FILTERS, np.float32)
        self.out = np.zeros(2 * FILTERS, np.float32)
        self.bias = np.array([np.log(prior / (1 - prior))], np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.bytes, self.kernel, self.shift, self.out, self.bias]

    def windows(self, chunks: np.ndarray) -> np.ndarray:
        """``(chunks * PLACES) x (WIDTH * DEPTH)`` embedded windows."""
        embedded = self.bytes[chunks]  # chunks x CHUNK x DEPTH
        view = np.lib.stride_tricks.sliding_window_view(embedded.reshape(len(chunks), -1), WIDTH * DEPTH, axis=1)
        return np.ascontiguousarray(view[:, ::STRIDE * DEPTH]).reshape(-1, WIDTH * DEPTH)

    def pooled(self, chunks: np.ndarray) -> np.ndarray:
        """Largest response of each filter within each chunk."""
        response = (self.windows(chunks) @ self.kernel).reshape(len(chunks), PLACES, FILTERS)
        return np.maximum(response.max(1) + self.shift, 0)

    def probability(self, mean: np.ndarray, top: np.ndarray) -> np.ndarray:
        z = np.concatenate([mean, top], 1) @ self.out + self.bias[0]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def score(self, data: np.ndarray) -> float:
        """Probability of label 1 for the whole of one text."""
        starts = chunk_starts(len(data))
        total, top = np.zeros(FILTERS, np.float64), np.zeros(FILTERS, np.float32)
        for at in range(0, len(starts), BLOCK_CHUNKS):
            part = self.pooled(chunks_of(data, starts[at:at + BLOCK_CHUNKS]))
            total += part.sum(0)
            top = np.maximum(top, part.max(0))
        return float(self.probability((total / len(starts)).astype(np.float32)[None], top[None])[0])

    def gradients(self, chunks: np.ndarray, doc: np.ndarray, label: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        """Gradients of the weighted log loss; ``doc`` names the document of each chunk, in order."""
        n, k = len(label), len(chunks)
        place, peak = np.empty((k, FILTERS), np.int64), np.empty((k, FILTERS), np.float32)
        for at in range(0, k, BLOCK_CHUNKS):
            block = slice(at, at + BLOCK_CHUNKS)
            response = (self.kernel.T @ self.windows(chunks[block]).T).reshape(FILTERS, -1, PLACES)
            best = response.argmax(2)
            place[block] = best.T
            peak[block] = np.take_along_axis(response, best[:, :, None], 2)[:, :, 0].T + self.shift
        held = np.maximum(peak, 0)
        count = np.bincount(doc, minlength=n).astype(np.float32)
        first = np.concatenate([[0], np.cumsum(count)[:-1]]).astype(int)
        mean = np.add.reduceat(held, first, axis=0) / count[:, None]
        top = np.maximum.reduceat(held, first, axis=0)
        slope = ((self.probability(mean, top) - label) * weight / n).astype(np.float32)
        features = np.concatenate([mean, top], 1)
        back = slope[:, None] * self.out
        at_top = held == top[doc]
        shared = np.add.reduceat(at_top.astype(np.float32), first, axis=0)
        g = back[doc, :FILTERS] / count[doc, None] + at_top * (back[:, FILTERS:] / shared)[doc]
        g *= peak > 0
        # Summed by filter, place in the window and byte; both gradients follow from these sums.
        seen = chunks[np.arange(k)[:, None, None], place[:, :, None] * STRIDE + np.arange(WIDTH)]
        cell = np.arange(FILTERS * WIDTH).reshape(FILTERS, WIDTH) * 256 + seen
        sums = np.bincount(cell.ravel(), np.repeat(g.ravel(), WIDTH), FILTERS * WIDTH * 256).reshape(FILTERS, WIDTH, 256).astype(np.float32)
        kernel = (sums @ self.bytes).reshape(FILTERS, WIDTH * DEPTH)
        embedding = np.tensordot(sums, self.kernel.T.reshape(FILTERS, WIDTH, DEPTH), ((0, 1), (0, 1)))
        return [embedding, kernel.T, g.sum(0), features.T @ slope, np.array([slope.sum()], np.float32)]


def train(docs: list[np.ndarray], labels: np.ndarray, shares: np.ndarray, steps: int = STEPS, seed: int = 3) -> Network:
    """Fits to whole documents given as arrays of bytes; ``shares`` are those of labels 0 and 1."""
    net, rng = Network(seed, float(np.clip(shares[1], 0.01, 0.99))), np.random.default_rng(seed)
    counts = np.bincount(labels, minlength=2)
    if not counts.all():
        return net
    weights = (shares / (counts / counts.sum()))[labels]
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in net.parameters()]
    waiting = np.zeros(0, np.int64)
    for step in range(1, steps + 1):
        if len(waiting) < min(BATCH, len(docs)):
            waiting = np.concatenate([waiting, rng.permutation(len(docs))])
        take, waiting = waiting[:BATCH], waiting[BATCH:]
        chunks = [chunks_of(docs[i], chunk_starts(len(docs[i]))) for i in take]
        doc = np.repeat(np.arange(len(take)), [len(c) for c in chunks])
        grads = net.gradients(np.concatenate(chunks), doc, labels[take].astype(np.float32), weights[take])
        rate = RATE * (1 - step / (steps + 1))
        for p, g, m in zip(net.parameters(), grads, moments):
            m[0] = 0.9 * m[0] + 0.1 * g
            m[1] = 0.99 * m[1] + 0.01 * g * g
            p -= rate * (m[0] / (1 - 0.9 ** step)) / (np.sqrt(m[1] / (1 - 0.99 ** step)) + 1e-6)
    return net


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, steps: int = STEPS) -> Network:
    """Learns ``label`` of ``(doc_id, label)`` from the whole texts of the sampled ``docs``."""
    known = labels.where("doc_id is not null and label in (0, 1)").select("doc_id", F.col("label").cast("int"))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    total = sum(counts.values())
    shares = np.array([counts.get(0, 0), counts.get(1, 0)]) / max(1, total) if total else np.array([0.5, 0.5])
    # The draw is bounded, so its ids can be sent to every task.
    drawn = F.broadcast(bounded_sample(known, "label", sample_docs))
    text = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    rows = text.join(drawn, "doc_id").select(F.col("doc_id").cast("long"), "label", "text").toArrow()
    rows = rows.take(np.lexsort((rows["label"].to_numpy(), rows["doc_id"].to_numpy())))
    texts = [np.frombuffer(t, np.uint8) for t in rows["text"].to_pylist()]
    return train(texts, rows["label"].to_numpy().astype(np.int64), shares, steps)


def _predict(net: Network, threshold: float):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            data, starts, sizes = joined_bytes(batch.column(2))
            score = np.array([net.score(data[a:a + n]) for a, n in zip(starts.tolist(), sizes.tolist())], np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    return run


def predict(docs: DataFrame, net: Network, held_out: Column, threshold: float = THRESHOLD) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long"), held_out.alias("held_out"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.mapInArrow(_predict(net, threshold), PREDICTIONS)


def learnt(docs: DataFrame, labels: DataFrame, **options) -> Network:
    """Fits on the labels whose documents are not held out."""
    return fit(docs, labels.where(remainder("doc_id", 5) != 0), **options)


def scored(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Scores of all documents."""
    return predict(docs, learnt(docs, labels, **options), remainder("doc_id", 5) == 0)


def _score_only(net: Network):
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield pd.Series([net.score(np.frombuffer((t or "").encode("utf-8", "surrogatepass"), np.uint8)) for t in part], dtype="float64")

    return run


def kept(docs: DataFrame, net: Network, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are not rejected, with the columns of ``docs``."""
    score = F.pandas_udf(_score_only(net), "double")
    return docs.where(score(F.col("text")) >= threshold)
