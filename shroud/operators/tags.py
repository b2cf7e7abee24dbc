"""Tags (T1-T6): current tags from an append-only tag log, the vocabulary check, and the
has_tag / has_tag_value match of policies against column tags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest(value: str, seq: str = "seq"):
    """The value of the row with the highest seq; equal seqs are broken by the larger
    value, so the result never depends on row order. max over a struct is a partial
    aggregate: a hot key is pre-combined on every map task, never gathered whole."""
    return F.max(F.struct(F.col(seq).alias("s"), F.col(value).alias("v")))["v"]


def current_column_tags(column_tags: DataFrame) -> DataFrame:
    """The last value set per (table, column, key)."""
    return (column_tags.groupBy("table_id", "column_name", "key")
            .agg(latest("value").alias("value")))


def current_table_tags(table_tags: DataFrame) -> DataFrame:
    """The last value per (table, key)."""
    return table_tags.groupBy("table_id", "key").agg(latest("value").alias("value"))


def tag_violations(current_tags: DataFrame, vocab: DataFrame) -> DataFrame:
    """Tags outside the governed vocabulary. Comparison is exact and case-sensitive
    ('pii' and 'PII' are different keys).

    problem = 'ungoverned_key' (the key is not governed: an ordinary tag, unusable in a
    policy) or 'value_not_allowed' (governed key, value outside its list)."""
    keys = vocab.select(F.col("key").alias("vkey")).distinct()
    pairs = vocab.select(F.col("key").alias("vkey"), F.col("allowed_value").alias("vval"))
    flagged = current_tags.join(keys, current_tags.key == keys.vkey, "left")
    bad_value = (flagged.where(F.col("vkey").isNotNull())
                 .join(pairs, (F.col("key") == pairs.vkey) & (F.col("value") == pairs.vval), "left_anti"))
    cols = [c for c in current_tags.columns]
    return (flagged.where(F.col("vkey").isNull()).select(*cols, F.lit("ungoverned_key").alias("problem"))
            .unionByName(bad_value.select(*cols, F.lit("value_not_allowed").alias("problem"))))


def policy_condition_errors(policies: DataFrame, vocab: DataFrame) -> DataFrame:
    """T4: policy conditions that name a key outside the vocabulary (or a value outside a
    governed key's list). Such a policy could not have been created: (scope_kind, scope_name,
    name, clause, key, value, problem)."""
    keys = vocab.select("key").distinct()
    pairs = vocab.select("key", F.col("allowed_value").alias("value"))
    conds = (policies.select("scope_kind", "scope_name", "name", F.lit("match").alias("clause"), F.col("match_key").alias("key"),
                             F.col("match_value").alias("value"))
             .unionByName(policies.where(F.col("when_key").isNotNull())
                          .select("scope_kind", "scope_name", "name", F.lit("when").alias("clause"), F.col("when_key").alias("key"),
                                  F.col("when_value").alias("value"))))
    unknown_key = conds.join(keys, "key", "left_anti").withColumn("problem", F.lit("unknown_key"))
    unknown_val = (conds.join(keys, "key", "left_semi").where(F.col("value").isNotNull())
                   .join(pairs, ["key", "value"], "left_anti").withColumn("problem", F.lit("value_not_allowed")))
    return unknown_key.unionByName(unknown_val)


class PolicyConditionError(ValueError):
    pass


def validate_policies(policies: DataFrame, vocab: DataFrame) -> None:
    """Raise, naming the key, when a policy condition is not governed (T4)."""
    bad = policy_condition_errors(policies, vocab).collect()  # one row per condition of a policy
    if bad:
        names = ", ".join(f"{r['name']}: unknown tag policy key `{r['key']}`" if r["problem"] == "unknown_key"
                          else f"{r['name']}: value `{r['value']}` not allowed for `{r['key']}`" for r in bad)
        raise PolicyConditionError(names)


def match_columns(policies: DataFrame, current_tags: DataFrame) -> DataFrame:
    """Columns whose current tags satisfy a policy's MATCH condition.
    has_tag_value(k, v) when match_value is set; has_tag(k) when it is NULL.

    The join key is the tag key alone, as this report has no scope; the value test is a
    residual condition. Resolution of controls goes by scope first (policy_targets)."""
    pol = policies
    cond = (current_tags.key == pol.match_key) & (pol.match_value.isNull() | (current_tags.value == pol.match_value))
    return current_tags.join(pol, cond).select(
        pol["name"].alias("policy"), current_tags.table_id, current_tags.column_name,
        current_tags.key.alias("tag_key"), current_tags.value.alias("tag_value"))
