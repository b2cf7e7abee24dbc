"""Toxicity by a factorization machine over hashed terms.

A text is the set of its terms (runs of letters and digits, lower-cased), hashed to ``dims``
buckets. The model is w0 + sum w_i + sum_{i<j} <v_i, v_j>: the factors learn pairs, such as an insult
next to the mention of a group, that single weights miss. Every term has a weight and factors.
The linear part learns first (FTRL, ``l1`` a pass over the rows). The errors it makes on rows not yet
learned start the factors: the leading eigenvectors of the sums over pairs of terms, damped by ``l2`` for terms in
few texts, so that pairs of terms that tell nothing alone are found in any vocabulary. Then weights
and factors are fitted together.

Fitted on at most ``most_rows`` labelled rows outside the held-out fold; every text is scored whole.

Defined cases: a null or empty text has no terms and scores the prior. Without labels of both
classes the score is the smoothed share of label 1. A null id belongs to fold crc32('') mod 5.
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
from .decontaminate import tokens
from .learn import fetch, labelled, sigmoid


def terms(texts: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct term buckets of each text, and row offsets."""
    h, rows = tokens(texts)
    b = (h >> np.uint64(64 - bits)).astype(np.int64)
    sets = [np.unique(b[i:j]) for i, j in zip(rows[:-1], rows[1:])]
    size = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if len(sets) else b[:0]), np.concatenate([[0], np.cumsum(size)])


def _row_sums(x: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of x over each row's items; empty rows are 0."""
    total = np.zeros((len(rows) - 1, *x.shape[1:]), np.float64)
    full = np.flatnonzero(np.diff(rows))
    if len(full):
        total[full] = np.add.reduceat(x, rows[full], axis=0)
    return total


@dataclass
class Machine:
    bits: int
    w0: float
    w: np.ndarray  # dims
    v: np.ndarray  # dims x factors

    def logit(self, idx: np.ndarray, rows: np.ndarray) -> np.ndarray:
        out = self.w0 + _row_sums(self.w[idx], rows)
        if self.v.shape[1]:
            f = self.v[idx]
            out += 0.5 * (_row_sums(f, rows) ** 2 - _row_sums(f * f, rows)).sum(1)
        return out


PAIR_SHIFT = 0.1  # of the pair matrix, so that its greatest and not its largest eigenvalues lead


def _slices(rows: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows of about a million terms."""
    i = 0
    while i < len(rows) - 1:
        j = max(i + 1, int(np.searchsorted(rows, rows[i] + (1 << 20), "right")) - 1)
        yield i, j
        i = j


def pair_directions(idx: np.ndarray, rows: np.ndarray, err: np.ndarray, bits: int, factors: int, l2: float, steps: int, rng: np.random.Generator) -> np.ndarray:
    """Leading eigenvectors of the pair matrix sum_r err_r x x' / |x| without its diagonal, each term
    scaled by the root of its count plus ``l2``: where the loss falls fastest when factors leave zero."""
    dims = 1 << bits
    size = np.maximum(np.diff(rows), 1)
    weight = err / size
    scale = 1 / np.sqrt(np.bincount(idx, np.repeat(1 / size, np.diff(rows)), dims) + l2)
    diagonal = np.bincount(idx, np.repeat(weight, np.diff(rows)), dims) * scale * scale

    def times(u: np.ndarray) -> np.ndarray:
        su, out = u * scale[:, None], np.zeros_like(u)
        for i, j in _slices(rows):
            at, cut = idx[rows[i]:rows[j]], rows[i:j + 1] - rows[i]
            part = _row_sums(su[at], cut) * weight[i:j, None]
            for k in range(factors):
                out[:, k] += np.bincount(at, np.repeat(part[:, k], np.diff(cut)), dims)
        return out * scale[:, None] - u * diagonal[:, None]

    u = np.linalg.qr(rng.normal(size=(dims, factors)) * (scale[:, None] < 1 / np.sqrt(l2)))[0]
    for _ in range(steps):
        u = np.linalg.qr(times(u) + PAIR_SHIFT * u)[0]
    value, turn = np.linalg.eigh(u.T @ times(u))
    return (u @ turn) * np.sqrt(np.maximum(value, 0)) * scale[:, None]


def pair_factors(idx: np.ndarray, rows: np.ndarray, y: np.ndarray, ahead: np.ndarray, bits: int, factors: int, l2: float, steps: int, rng: np.random.Generator) -> np.ndarray:
    """Pair directions of one half of the rows, at the lengths that fit the other half (Newton steps on
    the log loss beside the logits ``ahead``): directions that only held by chance get length 0."""
    half = rng.random(len(y)) < 0.5
    err = np.where(half, y - sigmoid(ahead), 0)
    v = pair_directions(idx, rows, err, bits, factors, l2, steps, rng)
    v /= np.maximum(np.sqrt((v * v).sum(0) / 2), 1e-12)
    q = np.concatenate([0.5 * (_row_sums(v[idx[rows[i]:rows[j]]], c := rows[i:j + 1] - rows[i]) ** 2 - _row_sums(v[idx[rows[i]:rows[j]]] ** 2, c))
                        for i, j in _slices(rows)])[~half]
    t, off, c = y[~half], ahead[~half], np.zeros(factors)
    for _ in range(12):
        p = sigmoid(off + q @ c)
        c = np.maximum(0, c - 0.5 * np.linalg.solve(q.T @ (q * (p * (1 - p))[:, None]) + l2 * np.eye(factors), q.T @ (p - t) + 0.1 * l2 * c))
    return v * np.sqrt(c)


def fit(idx: np.ndarray, rows: np.ndarray, y: np.ndarray, bits: int, factors: int, epochs: int, l1: float, l2: float, steps: int, seed: int) -> Machine:
    dims, n, rng = 1 << bits, len(y), np.random.default_rng(seed)
    prior = (y.sum() + 0.5) / (n + 2)
    w0 = float(np.log(prior / (1 - prior)))
    z, g2, w = np.zeros(dims), np.zeros(dims), np.zeros(dims)
    m = Machine(bits, w0, w, np.zeros((dims, 0)))
    if n == 0 or y.min() == y.max():
        return m

    def batches():
        order = rng.permutation(n)
        for i in range(0, n, 128):
            pick = order[i:i + 128]
            cut = np.concatenate([[0], np.cumsum(rows[pick + 1] - rows[pick])])
            yield pick, np.concatenate([idx[rows[k]:rows[k + 1]] for k in pick]), cut, y[pick]

    def linear(u: np.ndarray, g: np.ndarray, l1: float) -> None:  # FTRL-proximal
        s = (np.sqrt(g2[u] + g * g) - np.sqrt(g2[u])) / 0.3
        z[u] += g - s * w[u]
        g2[u] += g * g
        w[u] = np.where(np.abs(z[u]) <= l1, 0, -(z[u] - np.sign(z[u]) * l1) / ((1 + np.sqrt(g2[u])) / 0.3))

    ahead = np.zeros(n)
    for passed in range(epochs):  # gradients add up over the passes, so the penalty does
        for pick, at, cut, t in batches():
            logit = m.logit(at, cut)
            if not passed:
                ahead[pick] = logit  # before the batch is learned
            err = sigmoid(logit) - t
            m.w0 -= 0.05 * float(err.mean())
            u, inv = np.unique(at, return_inverse=True)
            linear(u, np.bincount(inv, np.repeat(err, np.diff(cut)), len(u)), l1 * (passed + 1))
    m.v = pair_factors(idx, rows, y, ahead, bits, factors, l2, steps, rng)
    gv = np.full_like(m.v, 1e-2)
    for passed in range(epochs, 2 * epochs):  # weights and factors together
        for _, at, cut, t in batches():
            row = np.repeat(np.arange(len(t)), np.diff(cut))
            order = np.argsort(at, kind="stable")
            first = np.flatnonzero(np.diff(at[order], prepend=-1))  # of each term among the batch's, by term
            if not len(first):
                continue
            u, f = at[order[first]], m.v[at]
            total = _row_sums(f, cut)
            err = sigmoid(m.logit(at, cut)) - t
            m.w0 -= 0.02 * float(err.mean())
            linear(u, np.add.reduceat(err[row[order]], first), l1 * (passed + 1))
            g = np.add.reduceat((err[row, None] * (total[row] - f))[order], first, axis=0) / len(t) + 1e-3 * m.v[u]
            gv[u] += g * g
            m.v[u] -= 0.02 * g / np.sqrt(gv[u])
    return m


def _score(m: Machine):
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            _, off = A.text_bytes(b.column("text"))
            for i, j in A.pieces(off, 1 << 22):
                score = sigmoid(m.logit(*terms(b.column("text").slice(i, j - i), m.bits)))
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, j - i), b.column("held_out").slice(i, j - i), pa.array(score),
                                                  pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])
    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, bits: int = 18, factors: int = 8, epochs: int = 8, l1: float = 1.0,
                   l2: float = 30.0, steps: int = 8,
                   most_rows: int = 20_000, seed: int = 2) -> DataFrame:
    """docs(doc_id, text), labels(doc_id, toxic) -> doc_id, held_out, score, predicted."""
    sample = fetch(labelled(docs, labels, "toxic", 5, 0, most_rows).mapInArrow(_features(bits), "id long, y int, terms array<int>"))
    lists = sample.column("terms").combine_chunks()
    idx = np.asarray(lists.flatten(), np.int64)
    rows = np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths().fill_null(0), np.int64))]) if len(lists) else np.zeros(1, np.int64)
    m = fit(idx, rows, np.asarray(sample.column("y"), np.float64), bits, factors, epochs, l1, l2, steps, seed)
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text", (crc_fold("doc_id", 5) == 0).alias("held_out")).mapInArrow(
        _score(m), f"doc_id {kind}, held_out boolean, score double, predicted int")


def _features(bits: int):
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            _, off = A.text_bytes(b.column("text"))
            for i, j in A.pieces(off, 1 << 22):
                idx, rows = terms(b.column("text").slice(i, j - i), bits)
                yield pa.RecordBatch.from_arrays([
                    b.column("id").slice(i, j - i).cast(pa.int64()), b.column("y").slice(i, j - i),
                    pa.ListArray.from_arrays(pa.array(rows, pa.int32()), pa.array(idx, pa.int32()))], names=["id", "y", "terms"])
    return run
