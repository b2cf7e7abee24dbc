"""Benchmark decontamination by CGK embedding, bit sampling and exact edit verification.

Texts are runs of letters and digits, lower-cased (other ASCII characters part them). A walk over a
window reads the word under its pointer at every step and moves on by a random bit of the step and
the word (the CGK embedding: small edit distance becomes small Hamming distance of what was read).
A repetition samples a few steps of the walk; a window and an item that read the same words there
share a bucket. Items are classed by size (powers of two). Windows start at every ``stride``-th word
of a document (a quarter of the class size), and an item stands in the index with every start in
its first half, so any copy has windows that start level with one of them; steps are sampled so
that walks stay inside the shortest such part. The sampled words are compared one after the other, so nearly all windows are out
after the first ones. How many repetitions a class needs for the target recall is measured on the
items themselves, with random edits up to the limit, set at random places in running text. Items
below ``SHORT`` words, and classes that miss the target after ``most_reps`` repetitions, are searched
exactly instead: e edits leave one of e + 1 parts of an item as it was, so every window that equals
a part is a candidate, and none is lost. What shares a bucket is verified exactly: the
least edit distance, in words, of the item to any part of the text around the window must be at
most ``max_edit`` times the item's length.

Items are the query set: they are read in blocks of at most ``block_items``, and each block is
held against all documents by one more pass over the batch, with no join and no shuffle.

Defined cases: null or empty texts, and items without words, match nothing. Repeated items each
match. Repeated rows are judged alike. Extra columns pass through; columns named as the results
are replaced. Without items nothing is contaminated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays as A

PAD = np.uint64(0x5851F42D4C957F2D)
CHUNK = 1 << 18  # words whose windows are walked at a time
SHORT = 8  # items of fewer words leave no room for a walk
SPAN = "array<struct<item_id:bigint,start_word:bigint,end_word:bigint,distance:int>>"

_SEP = np.array([not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128) for b in range(256)])
_TABLE = A.fold_table(True, bytes(np.flatnonzero(_SEP).astype(np.uint8)))


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, off = A.text_bytes(texts)
    start, end, rows = A.word_bounds(data, off, _SEP)
    return A.hash_spans(data, start, end, _TABLE), rows


def _stride(cls: int) -> int:
    return max(1, (1 << cls) // 4)


def _starts(cls: int, size: np.ndarray) -> np.ndarray:
    """Number of an item's starts in the index: its first half, or one stride of a short item."""
    return np.maximum(_stride(cls), size // 2 if cls > 3 else np.ones_like(size))


def _reach(cls: int) -> int:
    """Steps of a walk. The pointer moves half a word a step and is to stay inside what follows the last start."""
    return max(2, (3 << cls) // 4 if cls > 3 else (9 << cls) // 8)


class Sampler:
    """One repetition: the walk's random bits and the sampled steps of a size class."""

    def __init__(self, rep: int, cls: int, n_samples: int, seed: int):
        rng = np.random.default_rng([seed, rep, cls])
        reach = _reach(cls)
        self.bit = np.random.default_rng([seed, rep]).integers(0, 2**63, max(64, reach), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        # one step from each of n_samples equal parts, so that the walk moves on between them
        part = np.linspace(0, reach, min(n_samples if cls > 3 else n_samples - 1, reach) + 1).astype(int)
        self.steps = [int(rng.integers(lo, hi)) for lo, hi in zip(part[:-1], part[1:])]

    def walk(self, tok: np.ndarray, at: np.ndarray, stop: np.ndarray, begin: int, step: int) -> tuple[np.ndarray, np.ndarray]:
        """From the pointers before step ``begin`` to those before ``step``, and the words read there."""
        for j in range(begin, step):
            word = np.where(at < stop, tok[np.minimum(at, len(tok) - 1)], PAD)
            at = at + ((word * self.bit[j]) >> np.uint64(63)).astype(np.int64)
        return at, np.where(at < stop, tok[np.minimum(at, len(tok) - 1)], PAD)


def _mix(key: np.ndarray, word: np.ndarray) -> np.ndarray:
    return (key ^ word) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(0x9FB21C651E98DF25)


def keys(s: Sampler, tok: np.ndarray, at: np.ndarray, stop: np.ndarray) -> list[np.ndarray]:
    """The running bucket key after each sampled step."""
    key, out, j = np.zeros(len(at), np.uint64), [], 0
    for step in s.steps:
        at, word = s.walk(tok, at, stop, j, step)
        key, j = _mix(key, word), step
        out.append(key)
    return out


def _spans(tok: np.ndarray, m: int) -> np.ndarray:
    """A hash of every m words in a row."""
    p, inv = A._power_tables(len(tok) + 1)
    total = np.zeros(len(tok) + 1, np.uint64)
    np.cumsum(tok * p[:len(tok)], out=total[1:])
    return A.splitmix((total[m:] - total[:-m]) * inv[:max(0, len(tok) - m + 1)])


def edit_window(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Least edit distance of the item to a part of the text, and that part."""
    n = len(text)
    cost, begin, order = np.zeros(n + 1, np.int64), np.arange(n + 1), np.arange(n + 1)
    for i, w in enumerate(item):
        up = cost + 1
        diag = np.concatenate([[i + 1], cost[:-1] + (text != w)])
        src = np.concatenate([[0], begin[:-1]])
        take = diag <= up
        best, frm = np.where(take, diag, up), np.where(take, src, begin)
        run = best - order  # then steps to the right, one each
        low = np.minimum.accumulate(run)
        where = np.maximum.accumulate(np.where(run == low, order, 0))
        cost, begin = low + order, frm[where]
    end = int(np.argmin(cost))
    return int(cost[end]), int(begin[end]), end


class Index:
    """A block of items, by size class and repetition."""

    def __init__(self, ids: list, texts: list[str], max_edit: float, recall: float, n_samples: int, most_reps: int, seed: int):
        tok, rows = tokens(pa.array(texts, pa.large_string()))
        self.items = [(i, tok[a:b]) for i, a, b in zip(ids, rows[:-1], rows[1:]) if b > a]
        self.words = [t.tolist() for _, t in self.items]
        self.max_edit = max_edit
        self.parts: list[tuple] = []
        self.tables: list[tuple] = []  # stride, repetitions: (sampler, sieves, keys ascending, item, start in the item)
        size = np.array([len(t) for _, t in self.items], np.int64)
        cls = np.array([int(n).bit_length() - 1 for n in size], np.int64)
        if not len(size):
            return
        flat = np.concatenate([t for _, t in self.items])
        at = np.cumsum(size) - size
        exact = np.flatnonzero(size < SHORT).tolist()
        for c in np.unique(cls[size >= SHORT]):
            stride = _stride(int(c))
            of = np.flatnonzero((cls == c) & (size >= SHORT))
            n_reps = self._reps(of, int(c), recall, n_samples, most_reps, seed)
            if n_reps is None:
                exact += of.tolist()
                continue
            n = _starts(int(c), size[of])
            item = np.repeat(of, n)
            start = np.arange(len(item)) - np.repeat(np.cumsum(n) - n, n)
            reps = []
            for rep in range(n_reps):
                s = Sampler(rep, int(c), n_samples, seed)
                k = keys(s, flat, at[item] + start, at[item] + size[item])
                order = np.argsort(k[-1], kind="stable")
                reps.append((s, [self._sieve(x) for x in k], k[-1][order], item[order], start[order]))
            self.tables.append((stride, reps))
        self.parts = self._parts(exact)

    def _parts(self, exact: list[int]) -> list[tuple]:
        """(words, sieve, keys ascending, item, offset) of the parts of which an edited copy keeps one."""
        by_size: dict[int, list[tuple]] = {}
        for i in exact:
            x = self.items[i][1]
            cut = np.linspace(0, len(x), int(self.max_edit * len(x)) + 2).astype(int)
            for lo, hi in zip(cut[:-1], cut[1:]):
                by_size.setdefault(int(hi - lo), []).append((int(_spans(x, int(hi - lo))[lo]), i, int(lo)))
        out = []
        for m, found in sorted(by_size.items()):
            found.sort()
            key, item, offset = np.array([k for k, _, _ in found], np.uint64), np.array([i for _, i, _ in found]), np.array([o for _, _, o in found])
            out.append((m, self._sieve(key), key, item, offset))
        return out

    @staticmethod
    def _sieve(key: np.ndarray) -> np.ndarray:
        """65,536 flags of the partial keys; true for every key of an item."""
        out = np.zeros(1 << 16, bool)
        out[(key >> np.uint64(48)).astype(np.int64)] = True
        return out

    def _reps(self, of: np.ndarray, c: int, recall: float, n_samples: int, most: int, seed: int, trials: int = 400) -> int | None:
        """Repetitions that find the wanted part of randomly edited items of the class in running
        text; None if ``most`` are not enough."""
        rng, stride = np.random.default_rng([seed, c, 99]), _stride(c)
        flat, a_at, a_end, a_of, b_at, b_end, b_of, n = [], [], [], [], [], [], [], 0
        for t in range(trials):
            x = self.items[int(rng.choice(of))][1]
            y = list(x)
            for _ in range(int(self.max_edit * len(x))):
                p = int(rng.integers(0, len(y))) if y else 0
                kind, w = int(rng.integers(0, 3)), np.uint64(rng.integers(0, 2**63))
                y[p:p + (kind != 0)] = [w] if kind != 1 else []
            here = range(int(_starts(c, np.array(len(x)))))
            a_at += [n + o for o in here]
            a_end += [n + len(x)] * len(here)
            n += len(x)
            around = rng.integers(0, 2**63, 4 * stride + 2 * len(x), dtype=np.uint64)
            text = np.concatenate([around[:2 * stride], np.array(y, np.uint64), around[2 * stride:]])
            there = range(int(rng.integers(0, stride)), 2 * stride + len(y), stride)
            b_at += [n + o for o in there]
            b_end += [n + len(text)] * len(there)
            n += len(text)
            a_of += [t] * len(here)
            b_of += [t] * len(there)
            flat += [x, text]
        flat, found = np.concatenate(flat), set()
        for rep in range(most):
            s = Sampler(rep, c, n_samples, seed)
            ka, kb = (keys(s, flat, np.array(at, np.int64), np.array(end, np.int64))[-1].tolist() for at, end in ((a_at, a_end), (b_at, b_end)))
            found |= {t for t, _ in set(zip(a_of, ka)) & set(zip(b_of, kb))}
            if len(found) >= recall * trials:
                return rep + 1
        return None

    def find(self, tok: np.ndarray, rows: np.ndarray) -> dict[int, list[tuple]]:
        """Row -> verified (item id, start, end, distance), in words of the row's text."""
        stop_of = np.repeat(rows[1:], np.diff(rows))
        hits = []
        for lo in range(0, len(tok), CHUNK):
            for stride, reps in self.tables:
                begin = np.arange(-(-lo // stride) * stride, min(lo + CHUNK, len(tok)), stride)
                stop = stop_of[begin]
                for s, sieve, last, of, start in reps:
                    live, at, j, key = np.arange(len(begin)), begin, 0, np.zeros(len(begin), np.uint64)
                    for step, flags in zip(s.steps, sieve):
                        at, word = s.walk(tok, at, stop[live], j, step)
                        key, j = _mix(key, word), step
                        on = flags[(key >> np.uint64(48)).astype(np.int64)]
                        live, at, key = live[on], at[on], key[on]
                        if not len(live):
                            break
                    if len(live):
                        a, b = np.searchsorted(last, key), np.searchsorted(last, key, "right")
                        for p, x, y in zip(begin[live[b > a]], a[b > a], b[b > a]):
                            hits += [(int(i), int(p - o)) for i, o in zip(of[x:y], start[x:y])]
            end = min(lo + CHUNK, len(tok))
            for m, sieve, last, of, offset in self.parts:
                key = _spans(tok[lo:min(end + m - 1, len(tok))], m)
                on = np.flatnonzero(sieve[(key >> np.uint64(48)).astype(np.int64)])
                a, b = np.searchsorted(last, key[on]), np.searchsorted(last, key[on], "right")
                for p, x, y in zip(on[b > a] + lo, a[b > a], b[b > a]):
                    hits += [(int(i), int(p - o)) for i, o in zip(of[x:y], offset[x:y])]
        out: dict[int, list[tuple]] = {}
        done: dict[tuple[int, int], int] = {}
        for i, p in sorted(set(hits)):
            name, item = self.items[i]
            row = int(np.searchsorted(rows, p + len(item) // 2, "right")) - 1  # p may lie before the text
            if not 0 <= row < len(rows) - 1 or p < done.get((i, row), -1):
                continue  # inside a part that is already verified
            slack = int(self.max_edit * len(item))
            lo, hi = max(int(rows[row]), p - slack), min(int(rows[row + 1]), p + len(item) + slack)
            near = set(tok[lo:hi].tolist())
            if sum(w in near for w in self.words[i]) < len(item) - slack:
                continue  # too few of its words are there for any alignment
            cost, a, b = edit_window(item, tok[lo:hi])
            if cost <= slack:
                base = int(rows[row])
                span = (name, lo + a - base, lo + b - base, cost)
                if span not in out.setdefault(row, []):
                    out[row].append(span)
                done[i, row] = lo + b
        return out


def _scan(index: Index, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            _, off = A.text_bytes(batch.column("text"))
            for i, j in A.pieces(off, 1 << 23):
                part = batch.slice(i, j - i)
                tok, rows = tokens(part.column("text"))
                hits = index.find(tok, rows) if index.items and len(tok) else {}
                old = part.column("dc_spans").to_pylist()
                new = [[*(old[r] or []), *({"item_id": a, "start_word": b, "end_word": c, "distance": d} for a, b, c, d in hits.get(r, []))]
                       for r in range(j - i)]
                cols = [part.column(c) for c in part.schema.names[:-1]]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(new, schema.field("dc_spans").type)], schema=pa.schema(
                    [*(part.schema.field(k) for k in range(len(cols))), schema.field("dc_spans")]))
    return run


def find_contamination(docs: DataFrame, items: DataFrame, max_edit: float = 0.15, recall: float = 0.99, n_samples: int = 4,
                       most_reps: int = 32, block_items: int = 5_000, seed: int = 5) -> DataFrame:
    """docs(text, ...) and items(item_id, text) -> docs with contaminated, item_ids (sorted, distinct)
    and spans (item, words of the text, distance)."""
    docs = docs.drop("contaminated", "item_ids", "spans")
    columns = docs.columns
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text is not null")
    n_blocks = max(1, -(-items.count() // block_items))
    out = docs.withColumn("dc_spans", F.array().cast(SPAN))
    schema = A.arrow_schema(f"dc_spans {SPAN}")
    for b in range(n_blocks):
        block = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == b) if n_blocks > 1 else items
        rows = block.sort("item_id", "text").collect()
        index = Index([r.item_id for r in rows], [r.text for r in rows], max_edit, recall, n_samples, most_reps, seed)
        out = out.mapInArrow(_scan(index, schema), out.schema)
    ids = F.array_sort(F.array_distinct(F.transform("dc_spans", lambda s: s.item_id)))
    return out.select(*columns, (F.size("dc_spans") > 0).alias("contaminated"), ids.alias("item_ids"), F.col("dc_spans").alias("spans"))
