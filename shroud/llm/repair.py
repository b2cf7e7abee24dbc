"""Token-id files compressed by a Re-Pair grammar.

Documents are range-partitioned and sorted by doc_id and encoded in that order; every run of about
``shard_tokens`` ids is a shard. In a shard, frequent pairs of neighbouring symbols are replaced by
new symbols, many pairs a round, until no pair is frequent; a pair never spans two documents. A
shard's file holds the rules, the expansion length of each rule, each document's place among the
symbols and its length in ids, and the symbols. A document is decoded alone from its own symbols;
expansion lengths give the ids before any symbol without expanding it, so reads start at any id.

Files are binary payloads in a table that Spark writes to the shared folder, one row a shard, so
any file system does and a lost executor's shards are written again. ``start`` adds the ids of all
earlier shards, from the small table of shard lengths.

Defined cases: a null text is empty and gives the end id alone. Null ids come first. Rows of equal
id stand next to each other, ordered by their texts' hash. An empty table writes no shard.
Other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import arrays as A
from .common import Scratch
from .tokens import encoder

MAGIC = b"RPR1"
HEAD = "<4sIIIII"  # magic, documents, ids, rules, symbols, first rule's symbol
BUCKETS = 1 << 18


def _frequent(seq: np.ndarray, last: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions where a frequent pair starts, the pair's rank there, and the pairs by frequency.
    Hashed counts find the few pairs worth counting exactly."""
    ok = ~last[:-1]
    code = (seq[:-1].astype(np.uint64) << np.uint64(32)) | seq[1:]
    bucket = ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(46)).astype(np.int32)
    bucket[~ok] = BUCKETS
    count = np.bincount(bucket, minlength=BUCKETS + 1)[:BUCKETS]
    bar = max(least, int(np.partition(count, -most)[-most])) if most < BUCKETS else least
    while True:
        at = np.flatnonzero(np.append(count >= bar, False)[bucket])
        if not len(at):
            return at, at, np.zeros(0, np.uint64)
        pair, rank, n = np.unique(code[at], return_inverse=True, return_counts=True)
        if bar == least or n.max() >= least:
            break
        bar = least  # the fullest buckets held rare pairs only
    order = np.argsort(-n, kind="stable")[:most]
    order = order[n[order] >= least]
    new = np.full(len(pair), -1)
    new[order] = np.arange(len(order))
    rank = new[rank]
    return at[rank >= 0], rank[rank >= 0], pair[order]


def compress(ids: np.ndarray, doc_len: np.ndarray, most: int = 4000, least: int = 24) -> bytes:
    seq = ids.astype(np.uint32)
    base = int(seq.max(initial=0)) + 1
    size = np.asarray(doc_len, np.int64)
    last = np.zeros(len(seq), bool)
    last[np.cumsum(size)[size > 0] - 1] = True
    pairs: list[np.ndarray] = []
    while len(seq) > 1:  # every round shortens the sequence
        at, rank, pair = _frequent(seq, last, least, most)
        if not len(at):
            break
        run = np.concatenate([[True], at[1:] != at[:-1] + 1])  # of overlapping places every second one is kept
        begin = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
        keep = (np.arange(len(at)) - begin) % 2 == 0
        at, rank = at[keep], rank[keep]
        seq[at] = base + sum(map(len, pairs)) + rank
        stay = np.ones(len(seq), bool)
        stay[at + 1] = False
        last[at] = last[at + 1]
        seq, last = seq[stay], last[stay]
        pairs.append(pair)
    pair = np.concatenate(pairs) if pairs else np.zeros(0, np.uint64)
    rules = np.stack([pair >> np.uint64(32), pair & np.uint64(0xFFFFFFFF)], 1).astype("<u4")
    length = np.ones(base + len(rules), np.int64)
    for i, (a, b) in enumerate(rules.tolist()):
        length[base + i] = length[a] + length[b]
    stop = np.cumsum(last)  # symbols of each document: ends are where ``last`` holds
    ends = np.zeros(len(size), np.int64)
    ends[size > 0] = np.flatnonzero(last) + 1 if len(stop) else 0
    ends = np.maximum.accumulate(ends) if len(ends) else ends
    kind = "<u2" if base + len(rules) <= 1 << 16 else "<u4"
    body = b"".join([rules.tobytes(), length[base:].astype("<u4").tobytes(), ends.astype("<u4").tobytes(),
                     size.astype("<u4").tobytes(), seq.astype(kind).tobytes()])
    return struct.pack(HEAD, MAGIC, len(size), len(ids), len(rules), len(seq), base) + body


class Shard:
    """Reads a shard's payload."""

    def __init__(self, payload: bytes):
        magic, docs, self.n_ids, n_rules, n_seq, self.base = struct.unpack_from(HEAD, payload)
        if magic != MAGIC:
            raise ValueError("not a shard")
        at = struct.calcsize(HEAD)

        def take(n: int, kind: str) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, kind, n, at)
            at += out.nbytes
            return out
        self.rules = take(2 * n_rules, "<u4").reshape(-1, 2)
        self.length, self.ends, self.doc_len = take(n_rules, "<u4"), take(docs, "<u4"), take(docs, "<u4")
        self.seq = take(n_seq, "<u2" if self.base + n_rules <= 1 << 16 else "<u4")

    def _expand(self, seq: np.ndarray) -> np.ndarray:
        seq = seq.astype(np.uint32)
        while True:
            big = seq >= self.base
            if not big.any():
                return seq
            at = np.cumsum(1 + big) - 1 - big
            out = np.empty(len(seq) + int(big.sum()), np.uint32)
            out[at] = seq
            rule = self.rules[seq[big] - self.base]
            out[at[big]], out[at[big] + 1] = rule[:, 0], rule[:, 1]
            seq = out

    def document(self, k: int) -> np.ndarray:
        """Ids of document k, from its own symbols only."""
        return self._expand(self.seq[self.ends[k - 1] if k else 0:self.ends[k]])

    def read(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from position ``start`` of the shard, from the symbols that cover them only."""
        size = np.ones(len(self.seq), np.int64)
        big = self.seq >= self.base
        size[big] = self.length[self.seq[big] - self.base]
        stop = np.cumsum(size)
        a, b = np.searchsorted(stop, start, "right"), np.searchsorted(stop, start + n)
        skip = start - int(stop[a - 1] if a else 0)
        return self._expand(self.seq[a:b + 1])[skip:skip + n]

    def documents(self) -> tuple[np.ndarray, np.ndarray]:
        return self._expand(self.seq), self.doc_len.astype(np.int64)


FILE = "part int, chunk int, n_docs long, n_ids long, doc_ids binary, known binary, payload binary"


def _encode(path: str, end_id: int, shard_tokens: int):
    schema = A.arrow_schema(FILE)

    def run(batches: Iterator[pa.RecordBatch]):
        enc, part, chunk, held, n = encoder(path), TaskContext.get().partitionId(), 0, [], 0

        def flush():
            docs = pa.concat_arrays([h[0] for h in held])
            ids, size = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
            return pa.RecordBatch.from_pylist([{
                "part": part, "chunk": chunk, "n_docs": len(size), "n_ids": len(ids),
                "doc_ids": docs.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes(),
                "known": docs.is_valid().to_numpy(zero_copy_only=False).tobytes(), "payload": compress(ids, size)}], schema=schema)

        for batch in batches:
            _, off = A.text_bytes(batch.column("text"))
            for i, j in A.pieces(off, min(1 << 22, 4 * shard_tokens)):
                ids, rows = enc.encode(batch.column("text").slice(i, j - i))
                size = np.diff(rows)
                full = np.full(len(ids) + len(size), end_id, np.uint32)
                full[np.arange(len(ids)) + np.repeat(np.arange(len(size)), size)] = ids
                held.append((batch.column("doc_id").slice(i, j - i).cast(pa.int64()), full, size + 1))
                n += len(full)
                if n >= shard_tokens:
                    yield flush()
                    chunk, held, n = chunk + 1, [], 0
        if held:
            yield flush()
    return run


def _read_back(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for row in batch.to_pylist():
                ids, size = Shard(row["payload"]).documents()
                stop = np.cumsum(size)
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(stop.tolist(), size.tolist())]
                known = np.frombuffer(row["known"], bool)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["part"]] * len(size), pa.int32()), pa.array([row["chunk"]] * len(size), pa.int32()),
                    pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=~known), pa.array(stop - size), pa.array(size),
                    pa.array(crc, pa.int64())], schema=schema)
    return run


def write_shards(scratch: Scratch, docs: DataFrame, tokenizer: str, end_id: int = 2, shard_tokens: int = 1 << 20,
                 partitions: int | None = None) -> DataFrame:
    """Writes docs(doc_id, text) as shards in ascending doc_id order and returns the written table."""
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    return scratch.write(rows.mapInArrow(_encode(tokenizer, end_id, shard_tokens), FILE))


def read_shards(files: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, and the shard."""
    ddl = "part int, chunk int, doc_id long, place long, n_tokens long, ids_crc32 long"
    rows = files.select("doc_ids", "known", "payload", "part", "chunk").mapInArrow(_read_back(A.arrow_schema(ddl)), ddl)
    in_part = Window.partitionBy("part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = files.select("part", "chunk", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    first = sizes.withColumn("at", F.coalesce(F.sum("n_ids").over(in_part), F.lit(0))).join(parts, "part").select(
        "part", "chunk", (F.col("first") + F.col("at")).alias("first"))
    return rows.join(first, ["part", "chunk"]).select(
        "doc_id", (F.col("first") + F.col("place")).alias("start"), "n_tokens", "ids_crc32", "part", "chunk")
