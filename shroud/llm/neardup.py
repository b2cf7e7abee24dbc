"""MinHash near-duplicate classes with sequential Bayesian verification.

1. One pass over the texts turns each into its set of word shingles (64-bit hashes), the set's
   size, a 128-bit order-free digest of the set (``node``) and ``rows * bands`` minhashes.
2. Equal digests are one node, so exact copies, however many, cost one row from here on.
3. A band of ``rows`` minhashes is a bucket. Every member of a bucket is paired with the
   bucket's least node only, never with all others.
4. A pair's signatures are compared ``batch`` at a time. With m of n equal and a flat prior, the
   posterior chance of similarity >= threshold is P(Bin(n + 1, threshold) <= m); a pair is
   dropped once it is below the miss probability shared out over the batches.
5. Survivors are verified exactly on the full sets: first one pair a node, which joins most
   groups, then those survivors that still lie in different components.
6. Buckets whose members are still in different components are compared whole, by signature, in
   the memory of a task: members with a plausible partner get their texts, and their pairs are
   verified there on the full sets. Only links leave the task, fewer than its members. So no link of
   a bucket is lost by pairing with the least node first, and pairs below the threshold, however many,
   never become rows. A large bucket is cut into blocks of about ``block`` members and
   ``block_shingles`` shingles at most, and each pair of blocks is a group of its own, so no task
   holds more than two blocks.
   Inside a component nothing is left to test: its members are already one class.

Signatures keep one byte a minhash. Bytes that agree by chance only make a pair look more alike, so
they cost an exact check and never a link.

A pair at the threshold shares no bucket with probability (1 - threshold**rows)**bands:
5e-6 for 6 x 40 at 0.8.

Defined cases: null or empty text, or no word: an empty set, linked with nothing. Fewer words
than a shingle: the whole sequence is the one shingle. Repeated rows and equal ids: each row
gets its class; rows of equal text share it. A null id counts only where a class has no other:
``component_id`` is then null. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays as A
from .common import Scratch
from .graph import joined

CHUNK = 1 << 19  # shingles hashed at a time
TEXT_BYTES = 1 << 21  # of texts split into words at a time
BAND_BITS = (1 << 31) - 1  # of a bucket's key that tell which bands two members share


def shingles(word_hash: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of each row, repeats included, and their row offsets."""
    n_words = np.diff(rows)
    count = np.where(n_words >= size, n_words - size + 1, (n_words > 0).astype(np.int64))
    out_rows = np.concatenate([[0], np.cumsum(count)])
    row = np.repeat(np.arange(len(count)), count)
    at = rows[:-1][row] + np.arange(out_rows[-1]) - out_rows[:-1][row]
    last = rows[1:][row]
    h = np.zeros(len(at), np.uint64)
    for k in range(size):  # a position beyond a short row adds a mark of its own
        part = np.where(at + k < last, word_hash[np.minimum(at + k, len(word_hash) - 1)], np.uint64(k + 1)) if len(word_hash) else h
        h = h * np.uint64(0xD6E8FEB86659FD93) + part
    return A.splitmix(h, 3), out_rows


def text_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted shingle set of each text."""
    h, rows = shingles(*A.words(texts), size)
    return [np.unique(h[i:j]) for i, j in zip(rows[:-1], rows[1:])]


def _digest(s: np.ndarray) -> bytes:
    return b"".join(int(A.splitmix(s, k).sum(dtype=np.uint64)).to_bytes(8, "big") for k in (11, 12))


def _slices(batch: pa.RecordBatch, most: int):
    """The rows of a batch in slices of about ``most`` bytes of text, or one longer text: the word
    arrays of a slice are many times its texts."""
    n = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    for i, j in A.pieces(np.concatenate([[0], np.cumsum(n, dtype=np.int64)]), most):
        yield batch.slice(i, j - i)


def _sketch(size: int, n_rows: int, n_bands: int):
    n_hash = n_rows * n_bands
    rng = np.random.default_rng(8)
    mul = rng.integers(1, 2**63, n_hash, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 2**63, n_hash, dtype=np.uint64)

    def run(batches):
        for batch in (part for whole in batches for part in _slices(whole, TEXT_BYTES)):
            rows = A.words(batch.column("text"))
            for i, j in A.pieces(rows[1], CHUNK):
                w = rows[0][rows[1][i]:rows[1][j]]
                h, r = shingles(w, rows[1][i:j + 1] - rows[1][i], size)
                sets = [np.unique(h[a:b]) for a, b in zip(r[:-1], r[1:])]
                full = np.flatnonzero(np.diff(r) > 0)
                sig = np.zeros((len(sets), n_hash), np.uint32)
                if len(full):
                    cat = np.concatenate([sets[k] for k in full])
                    at = np.concatenate([[0], np.cumsum([len(sets[k]) for k in full])[:-1]])
                    for k in range(n_hash):
                        sig[full, k] = np.minimum.reduceat(cat * mul[k] + add[k], at) >> np.uint64(32)
                key = np.zeros((len(sets), n_bands), np.uint64)
                for k in range(n_rows):
                    key = key * np.uint64(0xD6E8FEB86659FD93) + sig[:, k::n_rows]
                key = A.splitmix(key + np.arange(n_bands, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25), 5)
                low = (sig & np.uint32(255)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(i, j - i), batch.column("text_key").slice(i, j - i),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([x.tobytes() if len(s) else None for x, s in zip(low, sets)], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * n_bands, pa.int32()), pa.array(key.ravel().view(np.int64)))],
                    names=["doc_id", "text_key", "n_shingles", "node", "sig", "keys"])
    return run


def least_matches(n_hash: int, batch: int, threshold: float, miss: float) -> list[tuple[int, int]]:
    """(n, m): after n compared minhashes a pair needs m equal ones to stay."""
    steps = list(range(batch, n_hash, batch)) + [n_hash]
    out = []
    for n in steps:
        tail, m = 0.0, 0
        for m in range(n + 2):
            tail += math.exp(math.lgamma(n + 2) - math.lgamma(m + 1) - math.lgamma(n + 2 - m)
                             + m * math.log(threshold) + (n + 1 - m) * math.log(1 - threshold))
            if tail >= miss / len(steps):
                break
        out.append((n, m))
    return out


def _matrix(col: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint8).reshape(-1, width)


def _plausible(x: np.ndarray, i: np.ndarray, y: np.ndarray, j: np.ndarray, need: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs (i, j) that no batch prunes, and their equal bytes."""
    alive, same, done = np.arange(len(i)), np.zeros(len(i), np.int64), 0
    for n, m in need:
        same[alive] += (x[i[alive], done:n] == y[j[alive], done:n]).sum(1)
        alive, done = alive[same[alive] >= m], n
    return alive, same[alive]


def _bayes(n_hash: int, need: list[tuple[int, int]]):
    def run(batches):
        for b in batches:
            if b.num_rows:
                x, y, every = _matrix(b.column("sig_a"), n_hash), _matrix(b.column("sig_b"), n_hash), np.arange(b.num_rows)
                at, same = _plausible(x, every, y, every, need)
                yield pa.RecordBatch.from_arrays([b.column("a").take(pa.array(at)), b.column("b").take(pa.array(at)), pa.array(same)],
                                                 names=["a", "b", "same"])
    return run


def _pairs(t: pa.Table, n_hash: int, need: list[tuple[int, int]], percent: int, most: int):
    """Row positions (a, b, equal bytes) of plausible pairs of different components and blocks of each
    group, at most ``most`` tried at a time; rows come sorted by group. A pair that shares several
    buckets counts only in the one of the first band it shares."""
    group = [t.column(c).to_numpy() for c in ("key", "i", "j")]
    first = np.flatnonzero(np.concatenate([[True], np.any([g[1:] != g[:-1] for g in group], 0)]))
    stop = np.repeat(np.append(first[1:], len(t)), np.diff(np.append(first, len(t))))
    sig, comp = _matrix(t.column("sig"), n_hash), np.frombuffer(b"".join(t.column("comp").to_pylist()), "V16")
    own, n, cut = t.column("own").to_numpy(), t.column("n_shingles").to_numpy(), group[1] != group[2]
    bands = np.asarray(t.column("bands").combine_chunks().flatten()).reshape(len(t), -1)
    here = (group[0] & BAND_BITS).astype(bands.dtype)
    later = stop - np.arange(len(t)) - 1
    total = np.concatenate([[0], np.cumsum(later)])
    for lo, hi in A.pieces(total, most):
        a = np.repeat(np.arange(lo, hi), later[lo:hi])
        b = a + 1 + np.arange(len(a)) - (total[a] - total[lo])
        ok = (comp[a] != comp[b]) & (~cut[a] | (own[a] != own[b])) & (100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b]))
        a, b = a[ok], b[ok]
        at, same = _plausible(sig, a, sig, b, need)
        if len(at):
            a, b = a[at], b[at]
            once = bands[a, (bands[a] == bands[b]).argmax(1)] == here[a]
            if once.any():
                yield a[once], b[once], same[once]


def _by_group(work):
    """Run ``work`` on tables of whole groups; rows come sorted by group."""
    def run(batches):
        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([held, t]) if held is not None else t
            if not len(t):
                continue
            last = [t.column(c).to_numpy() for c in ("key", "i", "j")]
            new = np.flatnonzero(np.any([c != c[-1] for c in last], 0))
            cut = int(new[-1]) + 1 if len(new) else 0  # the last group may go on in the next batch
            held = t.slice(cut)
            if cut:
                yield from work(t.slice(0, cut))
        if held is not None and len(held):
            yield from work(held)
    return run


def _partnered(n_hash: int, need: list[tuple[int, int]], percent: int, most: int = 1 << 18):
    """The members of each group that have a plausible partner there."""
    def work(t: pa.Table):
        has = np.zeros(len(t), bool)
        for a, b, _ in _pairs(t, n_hash, need, percent, most):
            has[a] = has[b] = True
        if has.any():
            yield from t.filter(pa.array(has)).to_batches()
    return _by_group(work)


def _links(n_hash: int, need: list[tuple[int, int]], percent: int, size: int, most: int = 1 << 18):
    """Pairs of each group whose full sets reach the threshold. Likelier pairs come first, and a pair
    whose components an earlier one has already linked is left out, so links stay fewer than members."""
    def work(t: pa.Table):
        node, text, comp = t.column("node"), t.column("text"), t.column("comp").to_pylist()
        above, sets = {}, {}

        def top(c):
            while above.get(c, c) != c:
                above[c] = c = above.get(above[c], above[c])
            return c

        for a, b, same in _pairs(t, n_hash, need, percent, most):
            sets = {k: v for k, v in sets.items() if k >= a[0]}  # rows before a[0] are done with
            wanted = [int(k) for k in np.union1d(a, b) if k not in sets]
            for i in range(0, len(wanted), 256):
                part = wanted[i:i + 256]
                sets.update(zip(part, text_sets(text.take(pa.array(part)).combine_chunks(), size)))
            out = []
            for k in np.argsort(-same, kind="stable"):
                i, j = int(a[k]), int(b[k])
                x, y = top(comp[i]), top(comp[j])
                if x != y:
                    both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                        above[x] = y
                        out.append((i, j))
            if out:
                i, j = zip(*out)
                yield pa.RecordBatch.from_arrays([node.take(pa.array(i)).combine_chunks(), node.take(pa.array(j)).combine_chunks()], names=["a", "b"])
    return _by_group(work)


def _exact(size: int, threshold: float):
    percent = round(threshold * 100)

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part, keep = b.slice(i, 256), []
                for x, y in zip(text_sets(part.column("text_a"), size), text_sets(part.column("text_b"), size)):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * both >= percent * (len(x) + len(y) - both) and both > 0)
                part = part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
                if part.num_rows:
                    yield part
    return run


def near_duplicates(docs: DataFrame, shingle: int = 5, threshold: float = 0.8, rows: int = 6, bands: int = 40,
                    batch: int = 40, miss: float = 1e-6, block: int = 512, block_shingles: int = 1 << 22) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_shingles, component_id, kept: one row per row of docs."""
    spark, n_hash = docs.sparkSession, rows * bands
    scratch = Scratch(spark)
    ids = dict(docs.dtypes)["doc_id"]
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"))
    sketch = scratch.write(docs.mapInArrow(
        _sketch(shingle, rows, bands), f"doc_id {ids}, text_key long, n_shingles long, node binary, sig binary, keys array<bigint>"))
    named = scratch.write(sketch.select("doc_id", "n_shingles", "node", "text_key"))
    nodes = scratch.write(sketch.filter("node is not null").groupBy("node").agg(
        F.min(F.struct("text_key", "n_shingles", "sig", "keys")).alias("x")).select("node", "x.*"))
    scratch.drop(sketch)
    entry = nodes.select(F.explode("keys").alias("key"), "node", "n_shingles")
    crowd = entry.groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("members"), F.sum("n_shingles").alias("shingles")).filter("members > 1")
    bucket = scratch.write(entry.drop("n_shingles").join(crowd, "key"))  # only buckets with two members or more

    sig, text_key = nodes.select("node", "sig"), nodes.select("node", "text_key")
    need = least_matches(n_hash, batch, threshold, miss)

    def plausible(pairs: DataFrame) -> DataFrame:
        signed = (pairs.join(sig.withColumnsRenamed({"node": "a", "sig": "sig_a"}), "a")
                  .join(sig.withColumnsRenamed({"node": "b", "sig": "sig_b"}), "b"))
        return signed.select("a", "b", "sig_a", "sig_b").mapInArrow(_bayes(n_hash, need), "a binary, b binary, same long")

    def texts(wanted: DataFrame) -> DataFrame:
        keyed = wanted.distinct().join(text_key, "node")
        return scratch.write(docs.select("text_key", "text").join(keyed, "text_key").dropDuplicates(["node"]).select("node", "text"))

    def confirmed(pairs: DataFrame) -> DataFrame:
        """Pairs whose full sets reach the threshold. Only the texts of their nodes are fetched."""
        text = texts(pairs.select(F.col("a").alias("node")).union(pairs.select("b")))
        full = (pairs.select("a", "b").join(text.withColumnsRenamed({"node": "a", "text": "text_a"}), "a")
                .join(text.withColumnsRenamed({"node": "b", "text": "text_b"}), "b"))
        out = scratch.write(full.select("a", "b", "text_a", "text_b").mapInArrow(_exact(shingle, threshold), "a binary, b binary"))
        scratch.drop(text)
        return out

    def apart(pairs: DataFrame, label: DataFrame) -> DataFrame:
        """Pairs of different components."""
        return (pairs.join(label.select(F.col("node").alias("a"), F.col("comp").alias("ca")), "a", "left")
                .join(label.select(F.col("node").alias("b"), F.col("comp").alias("cb")), "b", "left")
                .filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).drop("ca", "cb"))

    star = scratch.write(bucket.filter("node > hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct())
    near = scratch.write(plausible(star))
    one = scratch.write(near.groupBy("b").agg(F.max(F.struct("same", "a")).alias("x")).select(F.col("x.a").alias("a"), "b"))
    label = joined(scratch, None, confirmed(one)).filter("node > comp")  # others are their own component
    rest = scratch.write(apart(near.join(one, ["a", "b"], "left_anti"), label))
    if rest.take(1):
        label = joined(scratch, label, confirmed(rest)).filter("node > comp")

    member = bucket.join(label, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    mixed = member.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("key")
    member = member.join(mixed, "key").join(nodes.select(
        "node", "n_shingles", "sig", F.expr(f"transform(keys, k -> CAST(k & {BAND_BITS} AS INT))").alias("bands")), "node")
    n_blocks = F.greatest(F.ceil(F.col("members") / block), F.ceil(F.col("shingles") / block_shingles)).cast("int")
    member = member.withColumn("own", F.pmod(F.xxhash64("node"), n_blocks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
    member = member.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "comp", "n_shingles", "sig", "bands")
    group, percent = ["key", "i", "j"], round(threshold * 100)
    open_ = scratch.write(member.repartition(*group).sortWithinPartitions(*group).mapInArrow(_partnered(n_hash, need, percent), member.schema))
    scratch.drop(bucket)
    if open_.take(1):
        member = open_.join(texts(open_.select("node")), "node")
        links = member.repartition(*group).sortWithinPartitions(*group).mapInArrow(_links(n_hash, need, percent, shingle), "a binary, b binary")
        label = joined(scratch, label, scratch.write(links)).filter("node > comp")

    classes = named.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("least")).join(label, "node", "left") \
        .withColumn("comp", F.coalesce("comp", "node"))
    least = classes.groupBy("comp").agg(F.min("least").alias("component_id"))
    of = classes.join(least, "comp").select("node", "component_id", F.col("comp").alias("group"))
    out = named.join(of, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "group", "text_key")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """docs without near duplicates: of each group the row of the least id (of the least text hash
    among equal ids or where all ids are null) stays, once. Rows without shingles all stay."""
    scratch = Scratch(docs.sparkSession)
    found = scratch.write(near_duplicates(docs, **options))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key"))
    chosen = found.filter("group is not null").groupBy("group").agg(best.alias("x")).select(
        F.col("x.doc_id").alias("nd_id"), F.col("x.text_key").alias("nd_key"))
    single = found.filter("group is null").select(F.col("doc_id").alias("nd_id"), F.col("text_key").alias("nd_key")).distinct()
    keyed = docs.withColumn("nd_text", F.xxhash64(F.coalesce("text", F.lit(""))))
    keep = chosen.select("*", F.lit(True).alias("nd_once")).union(single.select("*", F.lit(False)))
    out = keyed.join(keep, keyed.doc_id.eqNullSafe(keep.nd_id) & (keyed.nd_text == keep.nd_key))
    if found.filter("group is not null").groupBy("doc_id", "text_key").count().filter("count > 1").take(1):
        once = out.filter("nd_once").dropDuplicates(["nd_id", "nd_key"])
        out = once.union(out.filter("not nd_once"))
    return out.select(*docs.columns)
