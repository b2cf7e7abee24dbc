"""Classification (C1-C6): find columns that hold sensitive data and propose tags.

One scan per table: every (column, classifier) pair is a ``count_if`` inside a single
aggregate, so a table is read once whatever the number of classifiers, the map side
keeps one partial row per task, and the shuffle moves one row per task. Texts are tested
whole. No Python runs per row: regexes are Java regexes, the card check digit is a
higher-order function, the name dictionary is an array lookup.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Built-in classifier patterns (Java and RE2 both accept them: no
# look-around, [0-9] instead of \d) and the tags they propose.
EMAIL_PATTERN = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
US_SSN_PATTERN = r"(^|[^0-9])[0-9]{3}-[0-9]{2}-[0-9]{4}([^0-9]|$)"
PHONE_PATTERN = r"\+[0-9] \([0-9]{3}\) [0-9]{3}-[0-9]{4}"
CARD_RUN_PATTERN = r"[0-9]{16}"
IPV4_PATTERN = r"(^|[^0-9.])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}([^0-9.]|$)"

# Given names for the dictionary classifier (names cannot be found by a
# pattern; the classifier is only as good as this list).
GIVEN_NAMES = (
    "james", "mary", "john", "patricia", "robert", "jennifer", "michael", "linda", "william",
    "elizabeth", "david", "barbara", "richard", "susan", "joseph", "jessica", "thomas", "sarah",
    "maria", "anna", "peter", "laura", "hans", "klaus", "pierre", "marie", "sophie", "lucas",
    "juan", "carlos", "sofia", "emma", "noah", "olivia", "liam", "mateo", "lea", "jan",
)

REGEX, CARD, DICTIONARY, COLUMN_NAME = "regex", "card", "dictionary", "column_name"


@dataclass(frozen=True)
class Classifier:
    name: str
    kind: str            # regex | card | dictionary | column_name
    pattern: str | None  # regex / column-name pattern; unused for card and dictionary
    tag_key: str
    tag_value: str
    min_share: float
    # a literal the pattern cannot match without: a plain substring search skips the
    # regex on most texts (the e-mail regex costs 4x more than scanning for '@')
    guard: str | None = None


BUILTIN = (
    Classifier("email", REGEX, EMAIL_PATTERN, "class", "email_address", 0.01, guard="@"),
    Classifier("us_ssn", REGEX, US_SSN_PATTERN, "class", "us_ssn", 0.01, guard="-"),
    Classifier("phone", REGEX, PHONE_PATTERN, "class", "phone_number", 0.01, guard="+"),
    Classifier("credit_card", CARD, None, "class", "credit_card", 0.01),
    Classifier("ipv4", REGEX, IPV4_PATTERN, "class", "ip_address", 0.01),
)
NAME_DICTIONARY = Classifier("person_name", DICTIONARY, None, "class", "person_name", 0.05)


def from_rows(rows: Iterable) -> list[Classifier]:
    """Classifiers from a relation (name, kind, pattern, tag_key, tag_value, min_share)."""
    out = []
    for r in rows:
        d = r.asDict() if hasattr(r, "asDict") else dict(r)
        out.append(Classifier(d["name"], d["kind"], d["pattern"], d["tag_key"], d["tag_value"], d["min_share"],
                              d.get("guard")))
    return out


def luhn_ok(run: Column) -> Column:
    """Check digit of a digit string, as a higher-order function over its digits:
    from the right, every second digit is doubled (minus 9 above 9); the sum ends in 0."""
    rev = F.reverse(run)

    def add(acc, i):
        d = rev.substr(i + 1, F.lit(1)).cast("int")
        doubled = F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)
        return acc + F.when(i % 2 == 0, d).otherwise(doubled)

    total = F.aggregate(F.sequence(F.lit(0), F.length(run) - 1), F.lit(0), add)
    return (total % 10) == 0


def extract_all(col: Column, pattern: str, guard: str | None = None) -> Column:
    """All matches of ``pattern`` in the whole text; with a guard literal the regex runs
    only on texts that contain it (others give an empty array)."""
    found = F.regexp_extract_all(col, F.lit(pattern), 0)
    if guard is None:
        return found
    return F.when(F.instr(col, guard) > 0, found).otherwise(F.array().cast("array<string>"))


def card_runs(col: Column) -> Column:
    return F.regexp_extract_all(col, F.lit(CARD_RUN_PATTERN), 0)


def has_valid_card(col: Column) -> Column:
    return F.exists(card_runs(col), luhn_ok)


def dictionary_hit(col: Column, words: Sequence[str]) -> Column:
    """Some token of the text (split on non-letters, lower case) is in the list."""
    tokens = F.split(F.lower(col), r"[^\p{L}]+")
    return F.arrays_overlap(tokens, F.array(*[F.lit(w) for w in sorted(set(words))]))


def hit_expr(c: Classifier, col: Column, words: Sequence[str] = GIVEN_NAMES) -> Column:
    if c.kind == REGEX:
        hit = col.rlike(c.pattern)
        return hit if c.guard is None else (F.instr(col, c.guard) > 0) & hit
    if c.kind == CARD:
        return has_valid_card(col)
    if c.kind == DICTIONARY:
        return dictionary_hit(col, words)
    raise ValueError(c.kind)


def string_paths(dt: T.DataType, path: str) -> list[tuple[str, Callable[[Column, Callable[[Column], Column]], Column]]]:
    """The string values inside a column as (path, test): ``test(column, predicate)`` holds if
    some value at the path satisfies the predicate. Fields read ``a.b``, array elements ``a[]``,
    map keys and values ``a{key}`` and ``a{value}``."""
    if isinstance(dt, T.StringType):
        return [(path, lambda c, pred: pred(c))]
    if isinstance(dt, T.StructType):
        return [(p, lambda c, pred, name=f.name, inner=inner: inner(c.getField(name), pred))
                for f in dt.fields for p, inner in string_paths(f.dataType, f"{path}.{f.name}")]
    if isinstance(dt, T.ArrayType):
        return [(p, lambda c, pred, inner=inner: F.exists(c, lambda x: inner(x, pred)))
                for p, inner in string_paths(dt.elementType, f"{path}[]")]
    if isinstance(dt, T.MapType):
        return [(p, lambda c, pred, part=part, inner=inner: F.exists(part(c), lambda x: inner(x, pred)))
                for part, inside, label in ((F.map_keys, dt.keyType, "key"), (F.map_values, dt.valueType, "value"))
                for p, inner in string_paths(inside, f"{path}{{{label}}}")]
    return []


FINDINGS_SCHEMA = "table_id string, column_name string, classifier string, tag_key string, tag_value string, " \
                  "n_nonnull bigint, n_hits bigint, share double"


def classify(df: DataFrame, table_id: str, classifiers: Sequence[Classifier],
             columns: Sequence[str] | None = None, words: Sequence[str] = GIVEN_NAMES) -> DataFrame:
    """Findings (table_id, column_name, classifier, tag_key, tag_value, n_nonnull,
    n_hits, share) for every string column x content classifier, plus column-name
    classifiers, which read the schema only. Strings inside structs, arrays and maps are
    columns named by their path (``string_paths``); there a row counts as non-null if it holds
    some value at the path, and as a hit if some value at the path hits.
    Every row and every whole text is tested."""
    wanted = set(columns) if columns is not None else set(df.columns)
    inside = [(path, f.name, test) for f in df.schema.fields if f.name in wanted and not isinstance(f.dataType, T.StringType)
              for path, test in string_paths(f.dataType, f.name)]
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    cols = [c for c in columns if c in plain] if columns is not None else plain
    if columns is not None and (lost := wanted - set(df.columns)):
        raise ValueError(f"no such column: {', '.join(sorted(lost))}")
    content = [c for c in classifiers if c.kind != COLUMN_NAME]
    by_name = [(col, c) for c in classifiers if c.kind == COLUMN_NAME for col in df.columns
               if re.search(c.pattern, col)]
    counted = list(dict.fromkeys(cols + [col for col, _ in by_name]))
    nn = {col: f"nn_{k}" for k, col in enumerate(counted)}
    aggs = [F.count(F.col(col)).alias(nn[col]) for col in counted]
    structs = []

    def finding(col, c, hits):
        return F.struct(F.lit(col).alias("column_name"), F.lit(c.name).alias("classifier"),
                        F.lit(c.tag_key).alias("tag_key"), F.lit(c.tag_value).alias("tag_value"),
                        F.col(nn[col]).alias("n_nonnull"), hits.alias("n_hits"))

    for i, col in enumerate(cols):
        for j, c in enumerate(content):
            name = f"h_{i}_{j}"
            aggs.append(F.count_if(F.coalesce(hit_expr(c, F.col(col), words), F.lit(False))).alias(name))
            structs.append(finding(col, c, F.col(name)))
    for i, (path, col, test) in enumerate(inside):
        nn[path] = f"pn_{i}"
        aggs.append(F.count_if(F.coalesce(test(F.col(col), F.isnotnull), F.lit(False))).alias(nn[path]))
        for j, c in enumerate(content):
            name = f"p_{i}_{j}"
            hit = test(F.col(col), lambda v, c=c: F.coalesce(hit_expr(c, v, words), F.lit(False)))
            aggs.append(F.count_if(F.coalesce(hit, F.lit(False))).alias(name))
            structs.append(finding(path, c, F.col(name)))
    # a column-name classifier reads the schema only: every non-NULL value counts
    structs += [finding(col, c, F.col(nn[col])) for col, c in by_name]
    if not structs:
        return df.sparkSession.createDataFrame([], FINDINGS_SCHEMA)
    one = df.agg(*aggs)
    out = one.select(F.explode(F.array(*structs)).alias("f")).select(F.lit(table_id).alias("table_id"), "f.*")
    share = F.when(F.col("n_nonnull") > 0, F.round(F.col("n_hits") / F.col("n_nonnull"), 6)).otherwise(F.lit(0.0))
    return out.withColumn("share", share)


def classify_schema(tables: Sequence[tuple[str, DataFrame]], classifiers: Sequence[Classifier],
                    words: Sequence[str] = GIVEN_NAMES) -> DataFrame:
    """Classify every table of a schema or catalog; one scan per table."""
    out = None
    for table_id, df in tables:
        f = classify(df, table_id, classifiers, words=words)
        out = f if out is None else out.unionByName(f)
    return out


def dictionary_hits_by_join(df: DataFrame, col: str, dictionary: DataFrame, key: str) -> DataFrame:
    """C3 when the dictionary is too large to travel as a literal: explode tokens and
    semi-join a distributed dictionary (word). Returns the rows with a hit."""
    tok = df.select(key, F.explode(F.split(F.lower(F.col(col)), r"[^\p{L}]+")).alias("word")).where(F.col("word") != "")
    hit = tok.join(dictionary.select(F.lower(F.col("word")).alias("word")).distinct(), "word", "left_semi")
    return hit.select(key).distinct()


def propose_tags(findings: DataFrame, classifiers: Sequence[Classifier], current_tags: DataFrame) -> DataFrame:
    """A finding becomes a proposal when its share reaches the classifier's own
    threshold and the column does not carry that tag already."""
    th = findings.sparkSession.createDataFrame([(c.name, float(c.min_share)) for c in classifiers],
                                               "classifier string, min_share double")
    f = findings.join(F.broadcast(th), "classifier").where((F.col("n_hits") > 0) & (F.col("share") >= F.col("min_share")))
    have = current_tags.select("table_id", "column_name", F.col("key").alias("tag_key"), F.col("value").alias("tag_value"))
    return (f.join(have, ["table_id", "column_name", "tag_key", "tag_value"], "left_anti")
            .select("table_id", "column_name", "tag_key", "tag_value", "classifier", "n_hits", "share"))


def accept(proposals: DataFrame, decisions: DataFrame, seq_base: int = 0, log: DataFrame | None = None,
           vocab: DataFrame | None = None) -> DataFrame:
    """Review. Decisions are keyed by the proposal (table, column, key, proposed
    value): ACCEPT keeps it, ADJUST replaces the value, REJECT drops it; a proposal without
    a decision, or with any other one, stays pending (not applied). With ``log``, the tag log
    that the rows are for, they come after its last row, so an accepted tag takes effect.
    With ``vocab``, a value that a governed key does not allow raises when the rows are read,
    as setting such a tag by hand does; keys outside the vocabulary take any value.
    Returns tag rows to append: (seq, table_id, column_name, key, value)."""
    d = decisions.select("table_id", "column_name", "tag_key", "tag_value", "decision", "adjusted")
    j = (proposals.join(d, ["table_id", "column_name", "tag_key", "tag_value"], "inner")
         .where((F.col("decision") == "ACCEPT") | ((F.col("decision") == "ADJUST") & F.col("adjusted").isNotNull())))
    if log is not None:
        seq_base = (log.agg(F.max("seq")).first()[0] or 0) + 1
    out = j.select(F.lit(seq_base).cast("bigint").alias("seq"), "table_id", "column_name", F.col("tag_key").alias("key"),
                   F.when(F.col("decision") == "ADJUST", F.col("adjusted")).otherwise(F.col("tag_value")).alias("value"))
    if vocab is None:
        return out
    governed = vocab.select("key").distinct().withColumn("governed", F.lit(True))
    allowed = vocab.select("key", F.col("allowed_value").alias("value")).distinct().withColumn("allowed", F.lit(True))
    bad = F.raise_error(F.concat(F.lit("value `"), F.col("value"), F.lit("` not allowed for `"), F.col("key"), F.lit("`"))).cast("string")
    return (out.join(governed, "key", "left").join(allowed, ["key", "value"], "left")
            .select("seq", "table_id", "column_name", "key",
                    F.when(F.col("governed").isNotNull() & F.col("allowed").isNull(), bad).otherwise(F.col("value")).alias("value")))
