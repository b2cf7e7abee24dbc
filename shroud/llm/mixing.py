"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Sizes are words. A source's target is its weight's share of the mix, at most ``cap`` times the
source. The mix is cut into equal blocks of one word, and the blocks are dealt to sources by
highest quotients target / (2 j - 1), so each source's quota is within a word of its target. A
source takes its quota in runs of ``block`` words, shorter ones if it has few words. Its runs are dealt on to its shards by the same
rule (over groups of shards first, so no group to rank exceeds the square root of the shards).
A shard holds about ``shard_words`` words of one source; there are as many as the source needs,
so a hot source is spread over many tasks. Within a shard, documents follow each other in seeded
order, the shard is cut into equal blocks, and its quota is taken: whole passes first, then the
blocks that a seeded permutation puts first.

The candidates of an apportionment of N seats over n parties are few: divisors S / (N + n/2)
and S / (N - n/2) give at least and at most N seats, so only the quotients between the two
(about 3 n) need ranking, however many seats there are.

Defined cases: a null or empty text has size 0 and is taken 0 times. A null source is a source of
its own, after all others. A table without words has targets 0. Rows of equal id and text are
rows of their own; which of them a block falls on is not told apart. Other columns of the input
pass through unless the caller asks for fewer; the internal columns start with ``mix_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD

FEW = 128  # a source has at least so many blocks, of one word if need be
PRIMES = (2147483647, 2147483629, 2147483587)  # above any number of blocks of a shard, so coprime to it


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """One row a source: mix_source, mix_no (its place by code point), mix_words, mix_target.

    Sources sorted by cap / weight are capped from the front: a source is capped if the rate that
    is left for it and all later ones would lift it above its cap."""
    per = sizes.groupBy("mix_source").agg(F.sum("mix_size").alias("mix_words"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("mix_no") % len(weights)).cast("int") + 1)
    everything = Window.partitionBy()
    per = (per.withColumn("mix_no", F.row_number().over(Window.orderBy(F.asc_nulls_last("mix_source"))) - 1)
           .withColumn("w", w).withColumn("top", F.col("mix_words") * F.lit(float(cap)))
           .withColumn("total", F.sum("mix_words").over(everything) * F.lit(float(share))))
    by_ratio = Window.orderBy(F.col("top") / F.col("w"), "mix_no")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    per = per.withColumn("rate", (F.col("total") - F.coalesce(F.sum("top").over(before), F.lit(0.0))) / F.sum("w").over(after))
    free = F.when(F.col("rate") * F.col("w") < F.col("top"), F.struct(F.col("top") / F.col("w"), "mix_no", "rate"))
    per = per.withColumn("rate", F.min(free).over(everything)["rate"])
    return per.select("mix_source", "mix_no", "mix_words",
                      F.least("top", F.coalesce(F.col("rate") * F.col("w"), F.col("top"))).alias("mix_target"))


def apportion(parties: DataFrame, group: list[str], weight: str, seats: str, key: list[str]) -> DataFrame:
    """Sainte-Lague: parties with ``mix_quota``; each group deals its ``seats`` by highest
    quotients weight / (2 j - 1), ties by key."""
    in_group = Window.partitionBy(*group)
    total, n = F.sum(weight).over(in_group), F.count(F.lit(1)).over(in_group)
    d = parties.filter(F.col(weight) > 0).withColumn("S", total.cast("double")).withColumn("n", n)
    few = F.col(seats) - F.col("n") / 2
    d = (d.withColumn("sure", F.when(few > 0, F.greatest(F.lit(0), F.floor(F.col(weight) * few / F.col("S") + 0.5) - 1)).otherwise(0))
         .withColumn("most", F.floor(F.col(weight) * (F.col(seats) + F.col("n") / 2) / F.col("S") + 0.5) + 1)
         .withColumn("open", F.col(seats) - F.sum("sure").over(in_group)))
    d = d.withColumn("j", F.explode(F.sequence(F.col("sure") + 1, F.greatest(F.col("most"), F.col("sure") + 1))))
    rank = F.row_number().over(in_group.orderBy(F.desc(F.col(weight) / (2 * F.col("j") - 1)), *key, "j"))
    won = F.sum((F.col("place") <= F.col("open")).cast("long"))
    carry = [c for c in parties.columns if c not in {*group, *key}]
    d = d.withColumn("place", rank).groupBy(*dict.fromkeys([*group, *key])).agg(
        *[F.first(c).alias(c) for c in carry], (F.first("sure") + won).alias("mix_quota"))
    return d


def _blocks() -> Column:
    """The blocks, of those that a document's words [mix_at, mix_at + mix_size) lie in, that the
    partial pass takes: structs of the first word and the end, counted in the document."""
    lo = "greatest(0L, mix_at * mix_blocks div mix_cell - 1)"
    hi = "least(mix_blocks - 1, (mix_at + mix_size) * mix_blocks div mix_cell + 1)"
    return F.expr(f"""
        IF(mix_size = 0 OR mix_quota % mix_blocks = 0, array(), filter(transform(
            filter(sequence({lo}, {hi}), j -> pmod(j * mix_step + mix_start, mix_blocks) < mix_quota % mix_blocks),
            j -> struct(greatest(j * mix_cell div mix_blocks - mix_at, 0L) AS lo,
                        least((j + 1) * mix_cell div mix_blocks - mix_at, mix_size) AS hi)),
            x -> x.lo < x.hi))""")


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, block: int = 32,
        shard_words: int = 200_000, seed: int = 1, columns: list[str] | None = None) -> DataFrame:
    """docs(doc_id, text, source, ...) -> the columns asked for (all), and mix_size, mix_words (of
    the source), mix_target, mix_shard, mix_passes (times the whole document is taken), mix_parts
    (word ranges taken once more), mix_taken (words taken, repeats counted)."""
    keep = docs.columns if columns is None else columns
    mark = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(*keep, F.col("source").alias("mix_source"), size.alias("mix_size"), mark.alias("mix_mark"))
    targets = source_targets(docs.select(F.col("source").alias("mix_source"), size.alias("mix_size")), weights, share, cap)
    targets = (targets.withColumn("mix_shards", F.greatest(F.lit(1), F.ceil(F.col("mix_words") / shard_words)))
               .withColumn("mix_block", F.greatest(F.lit(1), F.least(F.lit(block), F.floor(F.col("mix_words") / FEW))).cast("long"))
               .withColumn("seats", F.round(F.sum("mix_target").over(Window.partitionBy())).cast("long")))
    named = targets.withColumnRenamed("mix_source", "mix_of")
    rows = rows.join(named.drop("seats"), rows.mix_source.eqNullSafe(named.mix_of)).drop("mix_of", "mix_source")
    rows = rows.withColumn("mix_shard", F.pmod("mix_mark", "mix_shards"))

    cell = rows.groupBy("mix_no", "mix_shard").agg(F.sum("mix_size").alias("words"), F.first("mix_shards").alias("mix_shards"), F.first("mix_block").alias("mix_block"))
    cell = cell.withColumn("region", F.floor(F.col("mix_shard") / F.ceil(F.sqrt("mix_shards"))))
    top = apportion(targets.select("mix_no", "mix_target", "seats", "mix_block"), [], "mix_target", "seats", ["mix_no"])
    top = top.withColumn("mix_quota", F.round(F.col("mix_quota") / F.col("mix_block")).cast("long"))
    mid = cell.groupBy("mix_no", "region").agg(F.sum("words").alias("words")).join(
        top.select("mix_no", F.col("mix_quota").alias("seats")), "mix_no")
    mid = apportion(mid, ["mix_no"], "words", "seats", ["region"])
    low = cell.join(mid.select("mix_no", "region", F.col("mix_quota").alias("seats")), ["mix_no", "region"])
    low = apportion(low.select("mix_no", "region", "mix_shard", "words", "seats", "mix_block"), ["mix_no", "region"], "words", "seats", ["mix_shard"])
    blocks = F.greatest(F.lit(1), F.round(F.col("words") / F.col("mix_block"))).cast("long")
    pick = F.xxhash64(F.lit(seed), F.col("mix_no"), F.col("mix_shard"))
    low = low.select("mix_no", "mix_shard", F.col("words").alias("mix_cell"), blocks.alias("mix_blocks"),
                     F.least("mix_quota", F.floor(blocks * cap)).alias("mix_quota"),
                     F.element_at(F.array(*[F.lit(p) for p in PRIMES]), F.pmod(pick, F.lit(len(PRIMES))).cast("int") + 1).cast("long").alias("mix_step"),
                     F.pmod(pick, blocks).alias("mix_start"))

    order = Window.partitionBy("mix_no", "mix_shard").orderBy("mix_mark").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("mix_at", F.coalesce(F.sum("mix_size").over(order), F.lit(0)))
    rows = rows.join(low, ["mix_no", "mix_shard"], "left")  # a shard without words has no quota
    zero = F.col("mix_quota").isNull() | (F.col("mix_size") == 0)
    rows = (rows.withColumn("mix_parts", F.when(~zero, _blocks()))
            .withColumn("mix_passes", F.when(zero, F.lit(0)).otherwise(F.floor(F.col("mix_quota") / F.col("mix_blocks")))))
    part = F.coalesce(F.expr("aggregate(mix_parts, 0L, (a, x) -> a + x.hi - x.lo)"), F.lit(0))
    return rows.select(*keep, "mix_size", "mix_words", "mix_target", "mix_shard", "mix_passes", "mix_parts",
                       (F.col("mix_passes") * F.col("mix_size") + part).cast("long").alias("mix_taken"))


def taken_rows(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: one row for each whole pass over a document and one with the words of its
    partial pass; ``text`` (and ``n_chars`` where there is one) holds what was taken."""
    # the words are bound by the outer lambda, so a text is split once and not once a part
    part = F.expr(r"""array_join(flatten(transform(array(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+[\\x20\\x09-\\x0D]*', 0)),
        w -> flatten(transform(mix_parts, x -> slice(w, CAST(x.lo + 1 AS INT), CAST(x.hi - x.lo AS INT)))))), '')""")
    texts = F.concat(F.array_repeat("text", F.col("mix_passes").cast("int")),
                     F.when(F.size("mix_parts") > 0, F.array(part)).otherwise(F.array().cast("array<string>")))
    new = {"text": F.col("mix_text"), "n_chars": F.length("mix_text").cast("long")}
    return mixed.filter("mix_taken > 0").withColumn("mix_text", F.explode(texts)).select(
        *[new[c].alias(c) if c in new else F.col(c) for c in columns])
