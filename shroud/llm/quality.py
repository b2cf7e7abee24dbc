"""Quality by random-indexing word vectors and a small network.

A text is a sequence of runs: letters, capitals, digits, punctuation and line breaks, each hashed to
one of ``vocab`` buckets (capitals and digits by length, others by content). Every bucket has a
random sparse ternary index vector; its word vector is the sum of the index vectors of what stands
up to two places away, over the whole corpus. Each task counts neighbour pairs and multiplies by the
index vectors once; Spark sums the tasks' vectors by bucket, so what comes to the driver is vocab
rows, whatever the corpus. A document is pooled: the mean of its unit vectors and of their squares,
and its length. A two-layer numpy network (hidden ReLU) is fitted on at most ``most_rows`` labelled
rows outside the held-out fold; a tenth of them sets the temperature of its probabilities.

Defined cases: null and empty texts pool to zeros and are scored like any text. Without labels of
both classes the score is the smoothed share of label 1. A null id belongs to fold crc32('') mod 3.
Repeated rows score alike; other columns are ignored; an empty table gives an empty result.
A document with labels of both kinds counts as label 1; the order of rows and labels decides nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays as A
from .common import crc_fold
from .learn import fetch, labelled, log_loss_temperature, sigmoid

VOCAB, DIMS, REACH = 2048, 32, 2


def _byte_classes() -> np.ndarray:
    c = np.full(256, 4, np.uint8)  # punctuation
    c[48:58], c[65:91], c[97:123], c[128:] = 3, 2, 1, 1
    c[np.frombuffer(A.SPACE, np.uint8)] = 0
    c[10] = 5
    return c


def runs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's runs, and row offsets."""
    data, off = A.text_bytes(texts)
    cls = _byte_classes()
    c = np.zeros(len(data) + 2, np.uint8)
    c[1:-1] = cls[data]
    mid = c[1:-1]
    first, last = (mid > 0) & (mid != c[:-2]), (mid > 0) & (mid != c[2:])
    cut = off[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    first[cut], last[cut - 1] = mid[cut] > 0, mid[cut - 1] > 0
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    rows = np.searchsorted(start, off)
    if not len(start):
        return np.zeros(0, np.int64), rows
    h = A.hash_spans(data, start, end, A.fold_table(False, bytes(b for b in range(256) if cls[b] == 0)))
    kind, size = mid[start], np.minimum(end - start, 12)
    by_size = (kind == 2) | (kind == 3)
    h[by_size] = A.splitmix((kind[by_size].astype(np.uint64) << np.uint64(8)) | size[by_size].astype(np.uint64), 21)
    return (h >> np.uint64(53)).astype(np.int64), rows


def index_vectors(seed: int) -> np.ndarray:
    """Ternary and sparse: two +1 and two -1 a bucket."""
    rng, out = np.random.default_rng(seed), np.zeros((VOCAB, DIMS))
    for r in out:
        r[rng.choice(DIMS, 4, replace=False)] = (1, 1, -1, -1)
    return out


def _neighbours(seed: int):
    def run(batches: Iterator[pa.RecordBatch]):
        count = np.zeros(VOCAB * VOCAB, np.int64)
        for b in batches:
            _, off = A.text_bytes(b.column("text"))
            for i, j in A.pieces(off, 1 << 22):
                ids, rows = runs(b.column("text").slice(i, j - i))
                row = np.repeat(np.arange(j - i), np.diff(rows))
                for d in range(1, REACH + 1):
                    same = row[:-d] == row[d:]
                    count += np.bincount(ids[:-d][same] * VOCAB + ids[d:][same], minlength=VOCAB * VOCAB)
        pair = count.reshape(VOCAB, VOCAB)
        vec = np.rint((pair + pair.T) @ index_vectors(seed)).astype(np.int64)
        some = np.flatnonzero(vec.any(1))
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(some), *(pa.array(vec[some, k]) for k in range(DIMS))],
                                             names=["bucket", *(f"v{k}" for k in range(DIMS))])
    return run


def word_vectors(docs: DataFrame, seed: int) -> np.ndarray:
    """Unit vectors of all buckets, from every document."""
    cols = [f"v{k}" for k in range(DIMS)]
    per_task = docs.select("text").mapInArrow(_neighbours(seed), "bucket long, " + ", ".join(f"{c} long" for c in cols))
    total = per_task.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in cols]).toArrow()  # vocab rows at most
    out = np.zeros((VOCAB, DIMS))
    if total.num_rows:
        out[np.asarray(total.column("bucket"))] = np.stack([np.asarray(total.column(c), np.float64) for c in cols], 1)
    out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)
    return out


def pool(vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
    n = np.diff(rows)
    out = np.zeros((len(n), 2 * DIMS + 1))
    full = np.flatnonzero(n)
    if len(full):
        x = vectors[ids]
        out[full, :DIMS] = np.add.reduceat(x, rows[full]) / n[full, None]
        out[full, DIMS:-1] = np.add.reduceat(x * x, rows[full]) / n[full, None]
    out[:, -1] = np.log1p(n)
    return out


@dataclass
class Network:
    mean: np.ndarray
    std: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x - self.mean) / self.std @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logit(x) / self.temperature)


def fit(x: np.ndarray, y: np.ndarray, hidden: int, epochs: int, seed: int) -> Network:
    rng, n, d = np.random.default_rng(seed), len(y), x.shape[1]
    prior = (y.sum() + 0.5) / (n + 2)
    net = Network(x.mean(0) if n else np.zeros(d), x.std(0) + 1e-6 if n else np.ones(d), rng.normal(0, (2 / d) ** 0.5, (d, hidden)),
                  np.zeros(hidden), np.zeros(hidden), float(np.log(prior / (1 - prior))))
    if n == 0 or y.min() == y.max():
        return net
    net.w2 = rng.normal(0, hidden**-0.5, hidden)
    order = rng.permutation(n)
    held, train = order[:n // 10], order[n // 10:]
    z = (x - net.mean) / net.std
    par = [net.w1, net.b1, net.w2, np.array([net.b2])]
    m, s, step = [np.zeros_like(p) for p in par], [np.zeros_like(p) for p in par], 0
    for epoch in range(epochs):
        rate = 0.01 * 0.5 ** (4 * epoch / epochs)
        for i in range(0, len(train), 128):
            pick = rng.choice(train, min(128, len(train)), replace=False)
            a = z[pick] @ par[0] + par[1]
            h = np.maximum(a, 0)
            err = (sigmoid(h @ par[2] + par[3]) - y[pick]) / len(pick)
            back = np.outer(err, par[2]) * (a > 0)
            grad = [z[pick].T @ back + 1e-4 * par[0], back.sum(0), h.T @ err + 1e-4 * par[2], np.array([err.sum()])]
            step += 1
            for k, g in enumerate(grad):  # Adam
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.999 * s[k] + 0.001 * g * g
                par[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)
    net.b2 = float(par[3][0])
    net.temperature = log_loss_temperature(net.logit(x[held]), y[held])
    return net


def _pooled(vectors: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            _, off = A.text_bytes(b.column("text"))
            for i, j in A.pieces(off, 1 << 22):
                x = pool(vectors, *runs(b.column("text").slice(i, j - i)))
                yield pa.RecordBatch.from_arrays([b.column("id").slice(i, j - i).cast(pa.int64()), b.column("y").slice(i, j - i),
                                                  pa.array(list(x), pa.list_(pa.float64()))], names=["id", "y", "x"])
    return run


def _score(vectors: np.ndarray, net: Network):
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            _, off = A.text_bytes(b.column("text"))
            for i, j in A.pieces(off, 1 << 22):
                score = net.score(pool(vectors, *runs(b.column("text").slice(i, j - i))))
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, j - i), b.column("held_out").slice(i, j - i), pa.array(score),
                                                  pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])
    return run


def score_quality(docs: DataFrame, labels: DataFrame, hidden: int = 32, epochs: int = 12, most_rows: int = 20_000, seed: int = 4) -> DataFrame:
    """docs(doc_id, text), labels(doc_id, quality) -> doc_id, held_out, score, predicted."""
    vectors = word_vectors(docs, seed)
    sample = fetch(labelled(docs, labels, "quality", 3, 1, most_rows).mapInArrow(_pooled(vectors), "id long, y int, x array<double>"))
    x = np.stack(sample.column("x").to_pylist()) if sample.num_rows else np.zeros((0, 2 * DIMS + 1))
    net = fit(x, np.asarray(sample.column("y"), np.float64), hidden, epochs, seed)
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text", (crc_fold("doc_id", 3) == 1).alias("held_out")).mapInArrow(
        _score(vectors, net), f"doc_id {kind}, held_out boolean, score double, predicted int")
