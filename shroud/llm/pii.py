"""Personal data by bootstrapped contextual extraction, in SQL functions only.

Base matches (e-mail, ip, card, phone) are found by patterns and checked. They seed the method: the
words before and after a seed are lexical patterns, once with the shape of what stands there and once
without. Patterns and instances form a graph, and the scores go round: a pattern's confidence
for a kind is the part of its distinct instances that are known to be of that kind, an instance's
score joins the confidences of its patterns (1 - product of 1 - confidence), instances above
``accept`` become known and score the patterns of the next round, until a round finds none. Patterns
with a shape count from a confidence of 0.5, those of context alone only from ``accept``. Every free
occurrence of a known instance is added as a span of its kind, so a card number that stands directly
beside another (a base match of both, refused) is found by its occurrences elsewhere; base spans stay.
A kind with fewer than ``support`` distinct seeds is not bootstrapped.

Instances are words with a digit or an @ sign, and runs of two to four such words with one space
between; longer runs are tables of numbers, of which only the words are instances. Brackets, quotes
and closing punctuation around an instance do not belong to it. A run that is found takes the place of
its words. Context words are letters, digits, = and : out of the three space-separated pieces before
an instance and the two after it. A shape or context word of over 256 characters is told by its SHA-256.

A fifth kind, secret (words of 32 or more lower-case hex digits, letters and digits both), is seeded and
bootstrapped in the same graph, but reported apart: ``spans`` holds the four kinds of the contract.

Positions: a pattern splits the text into gaps, and prefix sums of the lengths of gaps and matches
are the offsets, in code points. Sums use doubling steps over the array, n log n for n matches.
The patterns start only where a run of their characters starts and use possessive repeats: the same
leftmost matches, in linear time on long runs.

Defined cases: a null text is empty. Repeated rows each give a row; equal tokens count once in the
graph; a token that is known as two kinds is of the first listed. An empty table gives an empty result.
Other columns are ignored. Null ids are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A word that holds a digit or an @ sign: what an unseen identifier may look like.
_IDENTIFIER = r"[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
TOKEN = rf"(?<![^\x20\x09-\x0D]){_IDENTIFIER}"
#: Two or more of them with one space between.
RUN = rf"(?<![^\x20\x09-\x0D]){_IDENTIFIER}(?:\x20{_IDENTIFIER})++"
RUN_WORDS = 4
SECRET = len(KINDS)
SECRET_SEED = "^(?=.*[a-f])(?=.*[0-9])[0-9a-f]{32,}$"
GUARD = {"email": "@", "phone": "+"}


def _prefix(arr: str, op: str) -> str:
    """Inclusive prefix combination of an array expression; op combines x and y. It takes as many
    doubling steps as the array is long."""
    step = op.replace("y", "get(q, i - shiftleft(1, s - 1))")
    return (f"get(transform(array({arr}), whole -> IF(size(whole) < 2, whole, aggregate(sequence(1, length(bin(size(whole) - 1))), whole, "
            f"(q, s) -> transform(q, (x, i) -> IF(i < shiftleft(1, s - 1), x, {step}))))), 0)")


def _raw(kind: str) -> str:
    """Every match as struct(s, e, t, before, after, alone); ``before`` and ``after`` are the ends of the gaps beside
    it, ``alone`` is false if only a space parts it from another match."""
    ends = _prefix(f"transform(m_{kind}, (x, i) -> length(get(g_{kind}, i)) + length(x))", "x + y")
    return f"""get(transform(array({ends}), ends -> transform(m_{kind}, (t, i) -> struct(
        CAST(get(ends, i) - length(t) AS BIGINT) AS s, CAST(get(ends, i) AS BIGINT) AS e, t AS t,
        substring_index(get(g_{kind}, i), ' ', -4) AS before, substring_index(get(g_{kind}, i + 1), ' ', 3) AS after,
        NOT (i > 0 AND get(g_{kind}, i) = ' ' OR i + 1 < size(m_{kind}) AND get(g_{kind}, i + 1) = ' ') AS alone))), 0)"""


def _free(kind: str) -> str:
    """Matches of ``kind`` without the brackets, quotes and closing punctuation around them."""
    left = "ltrim('(\"[<{', v.t)"
    return f"""transform({_raw(kind)}, v -> struct(v.s + length(v.t) - length({left}) AS s, 0 AS k,
        v.s + length(v.t) - length({left}) + length(rtrim('.,;:!?)\"]>}}', {left})) AS e, rtrim('.,;:!?)\"]>}}', {left}) AS t, v.before, v.after, v.alone))"""


_DIGITS = "regexp_replace(v.t, '[^0-9]', '')"
_LUHN = f"""aggregate(transform(split(reverse({_DIGITS}), ''), (d, i) ->
    IF(i % 2 = 0, CAST(d AS INT), IF(CAST(d AS INT) > 4, 2 * CAST(d AS INT) - 9, 2 * CAST(d AS INT)))), 0, (a, x) -> a + x) % 10 = 0"""
VALID = {
    "email": "true",
    "ip": "forall(split(v.t, '[.]'), p -> length(ltrim('0', p)) <= 3 AND CAST(concat('0', right(p, 3)) AS INT) <= 255)",
    "card": f"IF(length({_DIGITS}) BETWEEN 13 AND 19, {_LUHN}, false)",
    "phone": f"length({_DIGITS}) BETWEEN 9 AND 15",
}


def _context(occ: DataFrame) -> DataFrame:
    """The patterns of an occurrence: one and two words before and one after, with its shape; two words
    before, one before, and those on both sides, without it. The context of a run is not that of its words."""
    short = lambda c: F.when(F.length(c) > 256, F.sha2(F.encode(c, "UTF-8"), 256)).otherwise(c)
    words = lambda c: F.filter(F.split(F.lower(F.col(c)), r"[^\p{L}\p{N}=:]+"), lambda w: w != "")
    shape = short(F.regexp_replace(F.regexp_replace("t", r"\p{L}+", "a"), r"[0-9]+", "9"))
    occ = occ.withColumn("l", F.reverse(words("before"))).withColumn("r", words("after")).withColumn("shape", shape)
    one, two, nxt = short(F.get("l", F.lit(0))), short(F.get("l", F.lit(1))), short(F.get("r", F.lit(0)))
    return occ.withColumn("patterns", F.filter(F.array(
        F.concat(F.lit("1 "), one, F.lit(" "), "shape"), F.concat(F.lit("2 "), two, F.lit(" "), one, F.lit(" "), "shape"),
        F.concat(F.lit("> "), "shape", F.lit(" "), nxt),
        *[F.when(F.col("alone"), p) for p in (F.concat(F.lit("_1 "), one), F.concat(F.lit("_2 "), two, F.lit(" "), one),
                                              F.concat(F.lit("_> "), one, F.lit(" _ "), nxt))]),
        lambda p: p.isNotNull()))


def bootstrap(scratch: Scratch, occ: DataFrame, support: int, accept: float) -> DataFrame:
    """occ(t, kind or null, patterns) -> (t, kind), one row for each known instance: the seeds of kinds
    with enough of them, and what the patterns discover. Rounds go on until one adds nothing: what is
    known only grows, by instances of the input."""
    edges = scratch.write(occ.select("t", "kind", F.explode("patterns").alias("p")).distinct())
    seeds = occ.filter("kind is not null").groupBy("t").agg(F.min("kind").alias("kind"))
    known = scratch.write(seeds)
    enough = [r.kind for r in known.groupBy("kind").count().filter(F.col("count") >= support).collect()]
    known = scratch.write(known.filter(F.col("kind").isin(enough)))
    n = known.count()
    every = scratch.write(edges.groupBy("p").agg(F.count_distinct("t").alias("n")))
    least = F.when(F.col("p").startswith("_"), accept).otherwise(0.5)
    while True:
        score = (edges.select("p", "t").distinct().join(known, "t").groupBy("p", "kind").agg(F.count(F.lit(1)).alias("pos"))
                 .filter(F.col("pos") >= support).join(every, "p").withColumn("conf", F.col("pos") / (F.col("n") + 1.0)).filter(F.col("conf") >= least))
        inst = (edges.filter("kind is null").select("p", "t").join(known, "t", "left_anti")
                .join(score.select("p", F.col("kind").alias("k"), "conf"), "p")
                .groupBy("t", "k").agg((1 - F.exp(F.sum(F.log(1 - F.col("conf"))))).alias("score")))
        new = inst.groupBy("t").agg(F.max_by("k", F.struct("score", -F.col("k"))).alias("kind"), F.max("score").alias("score")).filter(F.col("score") >= accept)
        last, known = known, scratch.write(known.union(new.select("t", "kind")))
        scratch.drop(last)
        if n == (n := known.count()):
            return known


def _joined(spans: str) -> str:
    names = ", ".join(f"'{k}'" for k in (*KINDS, "secret"))
    return f"array_join(transform({spans}, x -> concat(get(array({names}), x.k), ':', x.s, ':', x.e)), ',')"


def find_personal_data(docs: DataFrame, support: int = 5, accept: float = 0.9) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans,
    n_found (spans that the method added to the base ones), n_secret, secrets (spans of the fifth kind)."""
    scratch = Scratch(docs.sparkSession)
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("rid", F.monotonically_increasing_id())
    d = d.withColumn("some", F.col("text").rlike("[0-9@]"))
    for k, p in {**PATTERNS, "token": TOKEN, "run": RUN}.items():
        on = F.col("some") & F.col("text").contains(GUARD[k]) if k in GUARD else F.col("some")
        d = d.withColumn(f"m_{k}", F.when(on, F.regexp_extract_all("text", F.lit(p), F.lit(0))).otherwise(F.array().cast("array<string>")))
        d = d.withColumn(f"g_{k}", F.when(F.size(f"m_{k}") > 0, F.split("text", p, -1)))
    d = d.drop("text", "some")
    for i, k in enumerate(KINDS):
        ok = f"filter(IF(size(m_{k}) = 0, array(), {_raw(k)}), v -> {VALID[k]})"
        d = d.withColumn(f"b_{k}", F.expr(f"transform({ok}, v -> struct({i} AS k, v.s, v.e, v.t, v.before, v.after, true AS alone))"))
    d = d.withColumn("base", F.concat(*[F.col(f"b_{k}") for k in KINDS]))
    # a token overlaps a base span if one that starts before it ends later, or one starts inside it
    runs = f"filter(IF(size(m_run) = 0, array(), {_free('run')}), v -> length(v.t) - length(replace(v.t, ' ', '')) < {RUN_WORDS})"
    d = d.withColumn("mixed", F.expr(f"""IF(size(m_token) = 0, array(), array_sort(concat(
        transform(base, v -> struct(v.s AS s, -1 AS k, v.e AS e, v.t AS t, v.before AS before, v.after AS after, v.alone AS alone)), {_free("token")}, {runs})))"""))
    d = d.withColumn("past", F.expr(_prefix("transform(mixed, z -> IF(z.k < 0, z.e, 0L))", "greatest(x, y)")))
    d = d.withColumn("next", F.expr(f"reverse({_prefix('transform(reverse(mixed), z -> IF(z.k < 0, z.s, 9223372036854775807L))', 'least(x, y)')})"))
    # zipped: looked up by position inside a lambda, the optimizer would compute the sums anew for every element
    d = d.withColumn("free", F.expr("""transform(filter(arrays_zip(mixed, past, next),
        z -> z.mixed.k = 0 AND z.past <= z.mixed.s AND z.next >= z.mixed.e), z -> z.mixed)"""))
    rows = scratch.write(d.select("rid", "doc_id", "base", "free"))
    occ = rows.select("rid", F.explode(F.expr(f"""concat(transform(base, v -> struct(true AS base, v.k AS kind, v.s, v.e, v.t, v.before, v.after, v.alone)),
        transform(free, v -> struct(false AS base, IF(v.t RLIKE '{SECRET_SEED}', {SECRET}, CAST(NULL AS INT)) AS kind, v.s, v.e, v.t, v.before, v.after, v.alone)))""")
                                            ).alias("v")).select("rid", "v.*")
    occ = scratch.write(_context(occ).select("rid", "base", "kind", "s", "e", "t", "patterns"))
    known = bootstrap(scratch, occ, support, accept)
    more = (occ.filter("not base").select("rid", "s", "e", "t").join(known, "t").groupBy("rid")
            .agg(F.array_sort(F.collect_list(F.struct("s", (-F.col("e")).alias("ne"), F.col("kind").alias("k"), "e"))).alias("found")))
    # a word inside a run that was found: some span that starts before it ends at its end or later
    more = more.withColumn("far", F.expr(f"concat(array(-1L), {_prefix('transform(found, z -> z.e)', 'greatest(x, y)')})"))
    more = more.select("rid", F.expr("""transform(filter(arrays_zip(found, far), z -> z.found IS NOT NULL AND z.far < z.found.e),
        z -> struct(z.found.k AS k, z.found.s AS s, z.found.e AS e))""").alias("found"))
    out = rows.join(more, "rid", "left").withColumn("found", F.coalesce("found", F.array().cast("array<struct<k:int,s:bigint,e:bigint>>")))
    out = out.withColumn("secret", F.expr(f"filter(found, x -> x.k = {SECRET})")).withColumn("found", F.expr(f"filter(found, x -> x.k < {SECRET})"))
    return out.select(
        "doc_id", *[F.expr(f"CAST(size(filter(base, x -> x.k = {i})) AS BIGINT)").alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(F.encode(F.expr(_joined("base")), "UTF-8"), 256).alias("base_sha256"),
        F.expr(_joined("array_sort(concat(transform(base, x -> struct(x.k AS k, x.s AS s, x.e AS e)), found))")).alias("spans"),
        F.size("found").cast("long").alias("n_found"), F.size("secret").cast("long").alias("n_secret"),
        F.expr(_joined("secret")).alias("secrets"))
