"""Language-model scoring by the subword lattice of an existing unigram vocabulary.

A text is its words (A-Z lower-cased) and one end. A word is spelled with a leading word start, and
the model draws pieces of the vocabulary independently until it draws the end; so the text's
probability is the sum over all segmentations into pieces, which is the product of the words' sums
(no piece goes over a word start). A word's sum comes from a forward recursion in log space over the
lattice of its bytes: log alpha[j] = logsum over pieces of alpha[i] + log p(piece). Byte pieces are
arcs too, so every word has a segmentation and every text a probability above 0; the
probabilities of all texts sum to at most 1.

The vocabulary and its scores are given and fixed. Scores that are log probabilities (they sum to
about 1) weight the pieces as they are; scores that only order the pieces, as those of merges do,
weight them by 1 / (rank + 2.7), byte pieces last. The weights are then fitted to the training
texts: a round spreads every word's count over the arcs of its lattice by forward and backward
sums, and the expected counts plus ``strength`` times the first weights, normalised, are the next
weights. Rounds run over the table of distinct words with their counts, dealt over the cluster;
only one number a piece reaches the driver.

Scores of all texts: the words seen most often, at most ``head`` of them, go to all tasks as hash,
count and log probability; all other words of a text are joined by the word itself, so no word is
left out at any size, and no frequent word is a join key. Words of the head are told by a 64-bit hash
(``head`` times the distinct words must stay far below 2**64).

Defined cases: a null or empty text is the end alone. A null id counts as the empty text in the fold.
Repeated rows are scored alike and both train. Without training texts the first weights score, and N
and V are 0. An empty table gives an empty result. Other columns are ignored. Words of any length
are taken whole, in time linear in their length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays as A
from .common import Scratch, crc_fold

NEVER = -1e30  # log probability of what no piece spells
MATRIX = 64  # bytes of the longest word that is scored side by side with others of its length
LOG10 = math.log(10)
_BYTES = A.fold_table(False, b"")
_START = 0x20  # the word start; no word holds this byte


@dataclass
class Vocabulary:
    """Pieces as bytes, word start as 0x20, and their first weights; the last entry is the end."""

    pieces: list[bytes]
    weight: np.ndarray


def load_vocabulary(path: str) -> Vocabulary:
    """The pieces of a sentencepiece file that lower-cased words can hold."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    never = {*b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", *A.SPACE}
    found: dict[bytes, tuple[bool, float]] = {}
    for i in range(sp.get_piece_size()):
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            continue
        text = sp.id_to_piece(i)
        piece = bytes([int(text[1:-1], 16)]) if sp.is_byte(i) else text.replace("▁", " ").encode()
        if never & {*piece[0 if sp.is_byte(i) else piece[:1] == b" ":]}:
            continue
        found.setdefault(piece, (not sp.is_byte(i), sp.get_score(i)))
        if not sp.is_byte(i) and not found[piece][0]:
            found[piece] = (True, sp.get_score(i))
    return vocabulary([(p, s, whole) for p, (whole, s) in found.items()])


def vocabulary(scored: list[tuple[bytes, float, bool]]) -> Vocabulary:
    """(piece, score, not a byte piece) -> weights. Bytes without a piece of their own get the last rank."""
    have = {p for p, _, _ in scored}
    if bytes([_START]) not in have:
        raise ValueError("a vocabulary needs the word start as a piece")
    spare = [(bytes([b]), 0.0, False) for b in range(256) if bytes([b]) not in have and b not in A.SPACE and not 65 <= b <= 90]
    scored = sorted([*scored, *spare], key=lambda x: (not x[2], -x[1], x[0]))
    total = sum(math.exp(min(s, 1.0)) for _, s, whole in scored if whole)
    if 0.5 < total < 1.5 and all(s <= 0 for _, s, _ in scored):
        low = min(s for _, s, _ in scored)
        w = np.array([math.exp(s if whole else low) for _, s, whole in scored])
    else:
        w = 1 / (np.arange(len(scored)) + 2.7)
    w = np.append(w, w.max())
    return Vocabulary([p for p, _, _ in scored], w / w.sum())


class Lattice:
    """Lattices of many words at a time."""

    def __init__(self, pieces: list[bytes]):
        self.size = len(pieces)
        blob = np.frombuffer(b"".join(pieces), np.uint8)
        end = np.cumsum([len(p) for p in pieces])
        start = end - [len(p) for p in pieces]
        self.lengths = sorted({len(p) for p in pieces})
        self.known = {}
        self.sieve = {}
        for n in self.lengths:
            of = np.flatnonzero(end - start == n)
            h = self._hash(blob, start[of], n)
            order = np.argsort(h)
            self.known[n] = h[order], of[order].astype(np.int32)
            self.sieve[n] = np.zeros(1 << 16, bool)
            self.sieve[n][self._cell(h)] = True

    @staticmethod
    def _hash(data: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        p, inv = A._power_tables(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTES[data] * p[:len(data)], out=total[1:])
        return (total[at + n] - total[at]) * inv[at]

    @staticmethod
    def _cell(h: np.ndarray) -> np.ndarray:
        return ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(48)).astype(np.int64)

    def arcs(self, data: np.ndarray, left: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, positions, pieces): where pieces match; ``left``: bytes from a position to its word's end."""
        p, inv = A._power_tables(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTES[data] * p[:len(data)], out=total[1:])
        at = np.arange(len(data))
        for n in self.lengths:
            at = at[left[at] >= n]
            if not len(at):
                return
            h = (total[at + n] - total[at]) * inv[at]
            on = np.flatnonzero(self.sieve[n][self._cell(h)])
            hashes, piece = self.known[n]
            h = h[on]
            slot = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            on, slot = on[hashes[slot] == h], slot[hashes[slot] == h]
            yield n, at[on], piece[slot]

    def run(self, words: list[bytes], logp: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Log probability of each word; with counts, also the expected number of draws of each piece."""
        size = np.array([len(w) + 1 for w in words], np.int64)
        data = np.frombuffer(b"".join(b" " + w for w in words), np.uint8)
        start = np.cumsum(size) - size
        word = np.repeat(np.arange(len(words)), size)
        byte = np.arange(len(data)) - start[word]
        # words of equal length lie side by side: node i of all of them, then node i + 1 of all of them
        order = np.argsort(size, kind="stable")
        sizes, first, many = np.unique(size[order], return_index=True, return_counts=True)
        group = np.searchsorted(sizes, size)
        lane = np.empty(len(words), np.int64)
        lane[order] = np.arange(len(words)) - np.repeat(first, many)
        base = np.cumsum(many * (sizes + 1)) - many * (sizes + 1)
        node = base[group[word]] + byte * many[group[word]] + lane[word]
        slot = (np.cumsum(sizes) - sizes)[group[word]] + byte  # byte i of a group
        n_nodes = int((many * (sizes + 1)).sum())
        found = list(self.arcs(data, size[word] - byte))
        cost, on = np.full((len(found), n_nodes), NEVER), []
        for k, (_, at, piece) in enumerate(found):
            cost[k, node[at]] = logp[piece]
            on.append(np.bincount(slot[at], minlength=int(sizes.sum())) > 0)
        alpha, beta, seen = np.full(n_nodes, NEVER), np.full(n_nodes, NEVER), 0
        for n, m, b in zip(sizes.tolist(), many.tolist(), base.tolist()):
            by_end, by_begin = [[] for _ in range(n + 1)], [[] for _ in range(n + 1)]
            for k, (w, _, _) in enumerate(found):
                for i in np.flatnonzero(on[k][seen:seen + n]).tolist():
                    by_end[i + w].append((k, i, i))
                    by_begin[i].append((k, i, i + w))
            seen += n
            for x, arcs, path in ((alpha, by_end, range(1, n + 1)), (beta, by_begin, range(n - 1, -1, -1)))[:1 if counts is None else 2]:
                x[b + (path[0] - path.step) * m:][:m] = 0.0
                if n > MATRIX:
                    for lane_of in range(m):
                        self._long(x[b + lane_of:b + (n + 1) * m:m], cost[:, b + lane_of:b + (n + 1) * m:m], arcs, path)
                    continue
                for j in path:
                    if arcs[j]:
                        x[b + j * m:b + (j + 1) * m] = self._logsum(
                            [x[b + i * m:b + (i + 1) * m] + cost[k, b + c * m:b + (c + 1) * m] for k, c, i in arcs[j]])
        last = base[group] + size * many[group] + lane
        total = alpha[last]
        if counts is None:
            return total, None
        draws = np.zeros(self.size)
        for n, at, piece in found:
            of, a = word[at], node[at]
            share = np.exp(alpha[a] + logp[piece] + beta[a + n * many[group[of]]] - total[of]) * counts[of]
            draws += np.bincount(piece, share, self.size)
        return total, draws

    @staticmethod
    def _logsum(terms: list[np.ndarray]) -> np.ndarray:
        if len(terms) == 1:
            return terms[0]
        x = np.stack(terms)
        top = x.max(0)
        x -= top
        return top + np.log(np.exp(x, out=x).sum(0))

    @staticmethod
    def _long(x: np.ndarray, cost: np.ndarray, arcs: list, path: range) -> None:
        """One long word, byte by byte; x and cost by node."""
        value, cost = x.tolist(), [c.tolist() for c in cost]
        for j in path:
            terms = [value[i] + cost[k][c] for k, c, i in arcs[j]]
            if terms:
                top = max(terms)
                value[j] = top + math.log(sum(math.exp(t - top) for t in terms))
        x[:] = value


# ---- words ------------------------------------------------------------------------------
def _lowered(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw, off = A.text_bytes(texts)
    data = raw.copy()
    data[(raw >= 65) & (raw <= 90)] += 32
    return data, off


def take_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The spans as an Arrow array of strings."""
    size = end - start
    off = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    flat = data[np.repeat(start - off[:-1], size) + np.arange(off[-1])]
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(flat)))


def _distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The number of each item's value, the distinct values, and where each is first seen."""
    of, uniq = pd.factorize(h)
    first = np.empty(len(uniq), np.int64)
    first[of[::-1]] = np.arange(len(of))[::-1]
    return of, uniq, first


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text, trains = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        for i, j in A.pieces(A.text_bytes(text)[1], 1 << 22):
            data, off = _lowered(text.slice(i, j - i))
            start, end, rows = A.word_bounds(data, off, A._SEP)
            of, uniq, first = _distinct(A.hash_spans(data, start, end, A._EXACT))
            n = np.bincount(of, minlength=len(uniq))
            learnt = np.bincount(of[np.repeat(trains[i:j], np.diff(rows))], minlength=len(uniq))
            words = take_spans(data, start[first], end[first]).cast(pa.string())
            yield pa.RecordBatch.from_arrays([words, pa.array(learnt), pa.array(n.astype(np.int64))], ["word", "c", "n"])


def _word_batches(batches: Iterator[pa.RecordBatch], most_bytes: int = 1 << 18) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in batches:
        _, off = A.text_bytes(batch.column(0))
        for i, j in A.pieces(off, most_bytes):
            part = batch.slice(i, j - i)
            yield part, [w.encode() for w in part.column(0).to_pylist()]


def fit(words: DataFrame, n_docs: int, vocab: Vocabulary, rounds: int, strength: float) -> np.ndarray:
    """Log weights of the pieces and the end after ``rounds`` of expected counts; words(word, c)."""
    sc = words.sparkSession.sparkContext
    weight, pieces, size = vocab.weight, sc.broadcast(vocab.pieces), len(vocab.pieces)
    seen = words.filter("c > 0").select("word", "c")
    for _ in range(rounds):
        logp = np.log(weight[:-1])

        def draws(batches, logp=logp):
            net, total = Lattice(pieces.value), np.zeros(size)
            for part, texts in _word_batches(batches):
                total += net.run(texts, logp, part.column(1).to_numpy().astype(np.float64))[1]
            on = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(on.astype(np.int32)), pa.array(total[on])], ["piece", "n"])
        sums = seen.mapInArrow(draws, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).toArrow()
        drawn = strength * vocab.weight
        drawn[sums.column("piece").to_numpy()] += sums.column("n").to_numpy()
        drawn[-1] += n_docs
        weight = drawn / drawn.sum()
    return np.log(weight)


def _grade(n) -> F.Column:
    """A coarse, ascending grade of a count: 16 steps a doubling, so a few hundred grades in all."""
    return F.floor(F.log2(n) * 16).cast("int")


def _head_grade(scored: DataFrame, head: int) -> int:
    """The least grade such that at most ``head`` words have it or a higher one."""
    left, least = head, 1 << 30
    for grade, n in sorted(scored.groupBy(_grade("n")).count().collect(), reverse=True):
        left -= n
        if left < 0:
            break
        least = grade
    return least


def score_texts(docs: DataFrame, vocabulary_path: str, mod: int = 5, held: int = 1, rounds: int = 4, strength: float = 100.0,
                head: int = 1 << 19) -> DataFrame:
    """docs(doc_id, text) -> doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    scratch, vocab = Scratch(spark), load_vocabulary(vocabulary_path)
    docs = docs.select("doc_id", "text", (crc_fold("doc_id", mod) == held).alias("held_out"))
    words = docs.select("text", ~F.col("held_out")).mapInArrow(_count_words, "word string, c long, n long")
    words = scratch.write(words.groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n")))
    n_docs = docs.filter(~F.col("held_out")).count()
    tokens, types = words.filter("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    tokens, types = tokens + n_docs, types + (n_docs > 0)
    logw = fit(words, n_docs, vocab, rounds, strength)
    below = math.log10(tokens + 0.5 * (types + 1))
    pieces = spark.sparkContext.broadcast(vocab.pieces)

    def spell(batches):
        net = Lattice(pieces.value)
        for part, texts in _word_batches(batches):
            data, off = A.text_bytes(part.column(0))
            h = A.hash_spans(data, off[:-1], off[1:], A._EXACT)
            c = part.column(1).to_numpy()
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(h.view(np.int64)), pa.array(np.log10(c + 0.5) - below),
                                              pa.array(net.run(texts, logw[:-1])[0] / LOG10)], ["word", "c", "n", "h", "base", "lattice"])
    scored = scratch.write(words.mapInArrow(spell, "word string, c long, n long, h long, base double, lattice double"))
    least = _head_grade(scored, head)
    top = scored.filter(_grade("n") >= least).select("h", "c", "base", "lattice").toArrow().combine_chunks()
    h = top.column("h").to_numpy().view(np.uint64)
    order = np.argsort(h)
    common = spark.sparkContext.broadcast((h[order], top.column("c").to_numpy()[order] > 0, top.column("base").to_numpy()[order],
                                           top.column("lattice").to_numpy()[order]))
    rare = A.arrow_schema("rare array<struct<word:string,n:long>>").field(0).type

    def sums(batches):
        hashes, seen, base, lattice = common.value
        for batch in batches:
            text = batch.column(1)
            for i, j in A.pieces(A.text_bytes(text)[1], 1 << 22):
                part = batch.slice(i, j - i)
                data, off = _lowered(part.column(1))
                start, end, rows = A.word_bounds(data, off, A._SEP)
                no, uniq, _ = _distinct(A.hash_spans(data, start, end, A._EXACT))
                row = np.repeat(np.arange(j - i), np.diff(rows))
                at = np.searchsorted(hashes, uniq)
                hit = np.zeros(len(uniq), bool)
                inside = at < len(hashes)
                hit[inside] = hashes[at[inside]] == uniq[inside]
                hit, at = hit[no], at[no]
                at, of = at[hit], row[hit]
                rest = np.flatnonzero(~hit)
                pair, pairs, first = _distinct(row[rest] * (len(uniq) + 1) + no[rest])
                n = np.bincount(pair, minlength=len(pairs))
                first = rest[first]
                spelled = take_spans(data, start[first], end[first]).cast(pa.string())
                offsets = np.searchsorted(row[first], np.arange(j - i + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([spelled, pa.array(n.astype(np.int64))], ["word", "n"]))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(2), pa.array(np.diff(rows) + 1), pa.array(np.bincount(of, seen[at], j - i).astype(np.int64)),
                    *(pa.array(np.bincount(of, x[at], j - i).astype(np.float64)) for x in (base, lattice)), lists.cast(rare)],
                    ["doc_id", "held_out", "n_tokens", "n_known", "base", "lattice", "rare"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    part = docs.select("doc_id", "text", "held_out").mapInArrow(
        sums, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, lattice double, rare array<struct<word:string,n:long>>")
    part = scratch.write(part.withColumn("row", F.monotonically_increasing_id()))
    tail = part.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.n").alias("t").join(
        scored.filter(_grade("n") < least).select("word", "c", "base", "lattice").alias("s"), "word")
    tail = tail.groupBy("row").agg(F.sum(F.when(F.col("c") > 0, F.col("t.n")).otherwise(0)).alias("known"),
                                   F.sum(F.col("t.n") * F.col("s.base")).alias("more_base"), F.sum(F.col("t.n") * F.col("s.lattice")).alias("more"))
    out = part.drop("rare").join(tail, "row", "left").na.fill(0, ["known", "more_base", "more"])
    end = math.log10(n_docs + 0.5) - below
    return out.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.col("known") + int(n_docs > 0)).alias("n_known"),
                      F.lit(tokens).cast("long").alias("train_tokens"), (F.col("base") + F.col("more_base") + end).alias("base_score"),
                      (F.col("lattice") + F.col("more") + float(logw[-1]) / LOG10).alias("score"))

