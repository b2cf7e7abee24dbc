"""URL rules by a Bloom filter cascade.

A rule is a host and a path prefix. The keys of a url are the suffixes of its host joined with the
prefixes of its path, for the label counts and path lengths that the rule list has. Level 0 of a
cascade holds the listed keys; level 1 the keys of the corpus that pass level 0 though they are not
listed; level 2 the listed keys that pass level 1; and so on, until a level lets nothing wrong
through. Over the keys it was built for (every key of the corpus and every listed one) the
cascade's answer is exact, and asking it takes no join: the bit sets are scalar subqueries.

One cascade tells the listed keys, one tells among those the blocked ones. A bit set is broadcast
only up to ``most_bits``, and a url is asked for ``most_shapes`` pairs of label count and path length; a
list that needs more is matched by a join instead, with the same result.

Defined cases: a null url or one without ``://`` has an empty host and path and fits no rule. Where
no rule fits, the verdict is the method's: the url is not listed, so it is allowed. Repeated rows
are judged alike; an empty table gives an empty result; an empty list allows all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))
N_HASH = 4


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*(/?[^?#]*)", 1)


def _bit(key: Column, level: int, i: int, bits: int) -> Column:
    first, step = F.xxhash64(F.lit(level), key), F.xxhash64(F.lit(level), key, F.lit("step"))
    return (F.pmod(first, F.lit(bits)) + i * F.pmod(step, F.lit(bits))) % bits


def bit_set(keys: DataFrame, level: int, bits: int) -> Column:
    """Words of 64 bits, dense, as a scalar subquery."""
    pos = keys.select(F.explode(F.array(*[_bit(F.col("key"), level, i, bits) for i in range(N_HASH)])).alias("p"))
    words = pos.groupBy(F.floor(F.col("p") / 64).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(p % 64 AS INT))")).alias("b"))
    dense = keys.sparkSession.range(-(-bits // 64)).withColumnRenamed("id", "w").join(words, "w", "left")
    return dense.agg(F.transform(F.sort_array(F.collect_list(F.struct("w", F.coalesce("b", F.lit(0)).alias("b")))), lambda x: x.b)).scalar()


class Cascade:
    """Exact membership of ``listed`` keys over ``universe`` (both: column key, distinct)."""

    def __init__(self, scratch: Scratch, listed: DataFrame, universe: DataFrame, bits_per_key: int, most_bits: int):
        self.levels: list[tuple[Column, int]] = []
        self.too_large: DataFrame | None = None
        inside, outside = listed, universe.join(listed, "key", "left_anti")
        while True:
            n = inside.count()
            if not n:
                break
            bits = max(64, n * bits_per_key)
            if bits > most_bits:
                self.levels, self.too_large = [], listed
                break
            level = len(self.levels)
            self.levels.append((bit_set(scratch.write(inside), level, bits), bits))
            inside, outside = scratch.write(outside.filter(self._passes(F.col("key"), level))), inside

    def _passes(self, key: Column, level: int) -> Column:
        words, bits = self.levels[level]
        hit = F.lit(True)
        for i in range(N_HASH):
            p = _bit(key, level, i, bits)
            hit = hit & (F.getbit(F.get(words, F.floor(p / 64).cast("int")), (p % 64).cast("int")) == 1)
        return hit

    def holds(self, key: Column) -> Column:
        """A key that passes level i and fails level i + 1 is listed if i is even."""
        out = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            out = F.when(self._passes(key, i), out).otherwise(F.lit(i % 2 == 1))
        return out


def _key(host: Column, path: Column, n: int, m: int) -> Column:
    """The last n labels of the host and the first m characters of the path; null where too short."""
    labels = F.split(host, r"\.")
    return F.when((F.size(labels) >= n) & (F.length(path) >= m), F.concat(F.array_join(F.slice(labels, -n, n), "."), F.substring(path, 1, m)))


def judge_urls(pages: DataFrame, rules: DataFrame, bits_per_key: int = 10, most_bits: int = 1 << 27, most_shapes: int = 24) -> DataFrame:
    """pages(page_id, url) and rules(key, verdict) -> page_id, host, path, rule, verdict."""
    scratch = Scratch(pages.sparkSession)
    rules = rules.select("key", "verdict").filter("key like '%/%'").dropDuplicates(["key"])
    cut = F.instr("key", "/")
    shapes = sorted((r.n, r.m) for r in rules.select(
        F.size(F.split(F.substring("key", F.lit(1), cut - 1), r"\.")).alias("n"), (F.length("key") - cut + 1).alias("m")).distinct().collect())
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    if not shapes:
        return rows.select("*", F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict"))
    rows = rows.withColumn("keys", F.array_compact(F.array(*[_key(F.col("host"), F.col("path"), n, m) for n, m in shapes])))
    universe = scratch.write(rows.select(F.explode("keys").alias("key")).distinct())
    listed = scratch.write(rules.select("key"))
    blocked = scratch.write(rules.filter("verdict = 'block'").select("key"))
    if len(shapes) <= most_shapes:
        member = Cascade(scratch, listed, universe.union(listed).distinct(), bits_per_key, most_bits)
        bad = Cascade(scratch, blocked, listed, bits_per_key, most_bits)
    if len(shapes) > most_shapes or member.too_large is not None or bad.too_large is not None:
        known = universe.join(rules, "key").withColumnRenamed("key", "rule")
        hits = rows.select("host", "path", F.explode("keys").alias("rule")).distinct().join(known, "rule")
        best = hits.groupBy("host", "path").agg(F.max_by(F.struct("rule", "verdict"), F.length("rule")).alias("x"))
        return rows.join(best, ["host", "path"], "left").select("page_id", "host", "path", "x.rule", F.coalesce("x.verdict", F.lit("allow")).alias("verdict"))
    held = []
    for i in range(len(shapes)):  # a subquery may not stand inside a lambda
        key = F.get("keys", F.lit(i))
        held.append(F.when(key.isNotNull() & member.holds(key), F.struct(F.length(key).alias("n"), key.alias("key"))))
    rows = rows.withColumn("rule", F.array_max(F.array(*held))["key"])
    return rows.select("page_id", "host", "path", "rule", F.when(F.col("rule").isNotNull() & bad.holds(F.col("rule")), "block").otherwise("allow").alias("verdict"))
