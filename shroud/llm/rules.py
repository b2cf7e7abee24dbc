"""Quality rules with risk-controlled thresholds.

Base statistics are counted in one pass over whole texts, in SQL functions only. The method adds
thresholds learnt from labelled documents. The cutoffs of all statistics form one sequence of
vectors, fixed beforehand: ``LEVELS`` starts with every cutoff at its loosest and tightens one of them a
step, in turns, so a document that one level rejects is rejected by all later ones. For each stratum
(language) the levels are tested in order on its labelled good documents that the base rules keep
(on others the method decides nothing): with k of n rejected by the union of the level's rules, P(Bin(n, risk) <= k), exact, must not exceed ``error`` divided by the
number of strata (Bonferroni). The last level that passes is the stratum's. A fixed sequence needs no
correction for the number of levels, and no labels are spent on choosing its order, so all of them are
the holdout. The union of the rules then rejects at most ``risk`` of these, with
confidence 1 - ``error`` over all strata at once. Without a false rejection a stratum of four needs 217 good
labels at a risk of 2 %; one with too few gets no cutoff, and nothing is rejected beyond the base rules.

Defined cases: null, empty and blank texts have no words, so the base rule rejects them. A null
language is a stratum of its own. Labels that are null or match no document are ignored; several
labels of one document count each. Repeated rows are judged alike. Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import GAP, WORD, Scratch

SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 5
#: Statistic -> (numerator, denominator, cutoffs in ascending order)
RULES = {
    "symbols": ("n_symbols", "n_words", (0.05, 0.1, 0.2, 0.3, 0.5, 0.75, 1.0, 1.5, 2.0)),
    "dup_lines": ("n_dup_lines", "n_lines", (0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.7)),
    "repeats": ("n_repeat_words", "n_words", (0.02, 0.05, 0.1, 0.15)),
    "upper": ("n_upper", "word_chars", (0.05, 0.1, 0.2, 0.3, 0.5, 0.7)),
}


def _without(chars: str) -> Column:
    return F.length("r_text") - F.length(F.translate("r_text", chars, ""))


def statistics(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The columns asked for and r_* counts. Windows are compared by 64-bit hashes within one text; their order
    matters only where a text has a window twice, so only those texts are sorted."""
    cols = [F.col(c) for c in columns]
    d = docs.withColumn("r_text", F.coalesce("text", F.lit("")))
    d = d.select(*cols, F.length(F.translate("r_text", "\t\n\x0b\x0c\r ", "")).cast("long").alias("r_word_chars"),
                 _without(SYMBOLS).cast("long").alias("r_n_symbols"), _without(UPPER).cast("long").alias("r_n_upper"),
                 F.filter(F.split("r_text", "\n"), lambda x: x.rlike(WORD)).alias("r_lines"),
                 F.transform(F.filter(F.split("r_text", GAP), lambda x: x != ""), lambda x: F.xxhash64(x)).alias("r_words"))
    at = ", ".join(f"get(r_words, i + {k})" for k in range(WINDOW))
    d = d.select("*", F.size("r_lines").cast("long").alias("r_n_lines"), F.size("r_words").cast("long").alias("r_n_words"),
                 (F.size("r_lines") - F.size(F.array_distinct("r_lines"))).cast("long").alias("r_n_dup_lines"),
                 F.expr(f"IF(size(r_words) < {WINDOW}, array(), transform(sequence(0, size(r_words) - {WINDOW}), i -> xxhash64({at})))")
                 .alias("r_win")).drop("r_lines", "r_words")
    d = d.withColumn("r_sorted", F.expr(
        "IF(size(array_distinct(r_win)) = size(r_win), NULL, sort_array(transform(r_win, (x, i) -> struct(x AS h, i AS i))))")).drop("r_win")
    d = d.withColumn("r_at", F.expr("""sort_array(filter(transform(r_sorted, (x, j) ->
        IF(x.h = get(r_sorted, j - 1).h OR x.h = get(r_sorted, j + 1).h, x.i, -1)), i -> i >= 0))""")).drop("r_sorted")
    covered = f"aggregate(transform(r_at, (x, j) -> IF(j = 0, {WINDOW}, least({WINDOW}, x - get(r_at, j - 1)))), 0L, (a, x) -> a + x)"
    return d.withColumn("r_n_repeat_words", F.coalesce(F.expr(covered), F.lit(0))).drop("r_at")


def base_failed() -> Column:
    return (F.col("r_n_words") < 10) | (100 * F.col("r_n_repeat_words") > 20 * F.col("r_n_words"))


def _rate(rule: str) -> Column:
    num, den, _ = RULES[rule]
    return F.coalesce(F.try_divide(F.col(f"r_{num}"), F.col(f"r_{den}")), F.lit(0.0))


def binomial_cdf(p: float) -> Column:
    """P(Bin(r_n, p) <= r_k) by the term recursion in logarithms."""
    odds = f"ln({p} / (1 - {p}))"
    return F.expr(f"""aggregate(sequence(0L, r_k), struct(r_n * ln(1 - {p}) AS t, CAST(0 AS DOUBLE) AS s), (a, i) -> struct(
        IF(i < r_n, a.t + ln((r_n - i) / (i + 1)) + {odds}, a.t) AS t, a.s + exp(a.t) AS s), a -> a.s)""")


def _levels() -> list[dict[str, int]]:
    """The sequence of vectors: for each statistic the place of its cutoff, loosest last in RULES."""
    at = {r: len(x[2]) - 1 for r, x in RULES.items()}
    out = [dict(at)]
    while any(at.values()):
        for r in RULES:
            if at[r]:
                at[r] -= 1
                out.append(dict(at))
    return out


LEVELS = _levels()


def first_level() -> Column:
    """The first level that rejects a document; null if none does."""
    hits = []
    for r, (_, _, cuts) in RULES.items():
        level = F.lit(None).cast("int")
        for i, cut in enumerate(cuts):  # the loosest cutoff that is exceeded counts: it comes first in LEVELS
            since = next(t for t, at in enumerate(LEVELS) if at[r] <= i)
            level = F.when(_rate(r) > cut, F.lit(since)).otherwise(level)
        hits.append(level)
    return F.least(*hits)


def thresholds(stats: DataFrame, labels: DataFrame, risk: float, error: float, stratum: str = "lang") -> DataFrame:
    """One row a stratum with a safe level: r_stratum, r_labels (its good ones), r_rejected (of them),
    r_level, r_p (the exact test's) and r_cut_<rule>."""
    good = labels.filter("quality = 1").select(F.col("doc_id").alias("r_doc"))
    held = stats.filter(~base_failed()).join(good, stats.doc_id == good.r_doc)
    per = held.groupBy(F.col(stratum).alias("r_stratum"), first_level().alias("r_level")).agg(F.count(F.lit(1)).alias("n"))
    counts = per.groupBy("r_stratum").agg(F.sum("n").alias("r_n"), *[
        F.sum(F.when(F.col("r_level") <= t, F.col("n")).otherwise(0)).alias(f"k{t}") for t in range(len(LEVELS))])
    counts = counts.withColumn("r_strata", F.count(F.lit(1)).over(Window.partitionBy()))
    long = counts.select("r_stratum", "r_n", "r_strata", F.posexplode(F.array(*[f"k{t}" for t in range(len(LEVELS))])).alias("r_level", "r_k"))
    long = long.filter(F.col("r_k") <= F.col("r_n") * risk).withColumn("r_p", binomial_cdf(risk))
    # more are rejected at every later level, so levels pass up to one and fail from the next on
    safe = long.filter(F.col("r_p") <= F.lit(error) / F.col("r_strata")).groupBy("r_stratum").agg(
        F.max(F.struct("r_level", F.col("r_n").alias("r_labels"), F.col("r_k").alias("r_rejected"), "r_p")).alias("x"))
    cuts = [F.element_at(F.array(*[F.lit(RULES[r][2][at[r]]) for at in LEVELS]), F.col("x.r_level") + 1).alias(f"r_cut_{r}") for r in RULES]
    return safe.select("r_stratum", "x.r_labels", "x.r_rejected", "x.r_level", "x.r_p", *cuts)


def judge(docs: DataFrame, labels: DataFrame, risk: float = 0.02, error: float = 0.05, stratum: str = "lang",
          columns: list[str] | None = None) -> DataFrame:
    """docs(doc_id, text, lang, ...) and labels(doc_id, quality) -> the columns asked for (all),
    r_* statistics, r_base_failed and r_kept."""
    stats = Scratch(docs.sparkSession).write(statistics(docs, columns or docs.columns))
    cuts = thresholds(stats, labels, risk, error, stratum)
    out = stats.join(cuts, stats[stratum].eqNullSafe(cuts.r_stratum), "left")
    above = F.coalesce(first_level() <= F.col("r_level"), F.lit(False))
    return out.withColumn("r_base_failed", base_failed()).withColumn("r_kept", ~base_failed() & ~above)
