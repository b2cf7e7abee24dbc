"""Tag-driven policies (P1-P12): which controls hold where, for whom.

A policy row says: in this scope (schema or catalog), for these principals (TO, minus
EXCEPT), apply this mask to every column whose tags match, or this row filter to every
table with a matching column (optionally only tables whose own tags satisfy WHEN).
Resolution is a chain of joins: table paths (one row per table) x policies, by scope, then
x current column tags (large), by table and tag key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.metadata import EVERYONE, MASK
from . import tags as TG

KEY = ["scope_kind", "scope_name", "name"]  # a policy's identity: a name may recur in another scope


def valid_policies(policies: DataFrame, vocab: DataFrame) -> DataFrame:
    """Policies whose conditions are governed; the others could not have been created."""
    bad = TG.policy_condition_errors(policies, vocab).select(*KEY).distinct()
    return policies.join(bad, KEY, "left_anti")


def _names(column: str) -> Column:
    return F.array_compact(F.coalesce(F.col(column), F.array().cast("array<string>")))


def applies_to(policies: DataFrame, principal: str, groups: Sequence[str]) -> DataFrame:
    """P3/P4 for one principal: TO names the principal or one of its groups (the
    everyone-group holds all), and EXCEPT names neither. EXCEPT wins. A NULL among the names
    names nobody: it neither applies nor drops a policy."""
    ids = F.array(*[F.lit(x) for x in sorted({principal, EVERYONE, *groups})])
    return policies.where(F.arrays_overlap(_names("to_principals"), ids)
                          & ~F.arrays_overlap(_names("except_principals"), ids))


def applicability(policies: DataFrame, identities: DataFrame) -> DataFrame:
    """P3/P4 for every principal: (policy, scope_kind, scope_name, principal); a name may recur in
    another scope, so a policy is told by all three. ``identities`` is (principal, identity) from
    hierarchy.identities. The exploded policy side is small in practice, and Spark broadcasts it by
    its measured bytes; the everyone-group, an identity of every principal, is then one probe per
    principal instead of a hot shuffle key."""
    key = ["policy", "scope_kind", "scope_name"]
    named = policies.withColumnRenamed("name", "policy")
    to, ex = (named.select(*key, F.explode(c).alias("identity")) for c in ("to_principals", "except_principals"))
    granted = identities.join(to, "identity").select(*key, "principal").distinct()
    exempt = identities.join(ex, "identity").select(*key, "principal").distinct()
    return granted.join(exempt, [*key, "principal"], "left_anti")


def policy_targets(policies: DataFrame, current_tags: DataFrame, current_ttags: DataFrame,
                   paths: DataFrame) -> DataFrame:
    """(policy, kind, function, table_id, column_name, columns): a mask for every
    column the policy covers, and one row filter for every table with matching columns, which are its
    arguments in the order of their names (``columns``; ``column_name`` is the first). Each table takes
    the four places it stands in (table, schema, catalog, metastore) and meets the policies of those
    places; WHEN is settled there, by the table's current tag. Tags join last, on table and tag key: a
    tag meets only policies whose scope holds its table, and no task gathers the tags of a whole
    catalog."""
    at = F.explode(F.array(*[F.struct(F.lit(k).alias("scope_kind"), F.col(c).alias("scope_name")) for k, c in (
        ("table", "table_id"), ("schema", "schema_id"), ("catalog", "catalog_id"), ("metastore", "metastore_id"))]))
    places = paths.select("table_id", at.alias("at")).select("table_id", "at.scope_kind", "at.scope_name")
    pol = policies.select(F.col("name").alias("policy"), "scope_kind", "scope_name", "kind", "function",
                          "match_key", "match_value", "when_key", "when_value")
    # WHEN in one pass (no union of two copies of the plan): a table has one current value
    # per key, so the left join never multiplies rows; a policy without WHEN never matches
    # (NULL key) and is kept by the first term
    tt = current_ttags.select("table_id", F.col("key").alias("when_key"), F.col("value").alias("when_value"),
                              F.lit(True).alias("when_ok"))
    held = places.join(pol, ["scope_kind", "scope_name"]).join(tt, ["table_id", "when_key", "when_value"], "left")
    held = held.where(F.col("when_key").isNull() | F.col("when_ok")).drop("when_key", "when_value", "when_ok")
    tags = current_tags.select("table_id", "column_name", F.col("key").alias("match_key"), "value")
    m = tags.join(held, ["table_id", "match_key"]).where(
        F.col("match_value").isNull() | (F.col("value") == F.col("match_value")))
    unit = F.when(F.col("kind") == MASK, F.lower("column_name"))
    m = m.groupBy("policy", "scope_kind", "scope_name", "kind", "function", "table_id", unit.alias("unit")).agg(
        F.array_sort(F.collect_set("column_name")).alias("columns"))
    return m.select("policy", "kind", "function", "table_id", F.element_at("columns", 1).alias("column_name"), "columns")


def effective_controls(manual: DataFrame, targets: DataFrame, arguments: bool = False) -> DataFrame:
    """Manual controls united with the policy targets; origin says where each came from.
    With ``arguments`` every row also carries ``columns``, all argument columns of its
    function (a row filter may take several)."""
    man = manual.select("table_id", F.element_at("columns", 1).alias("column_name"), "kind", "function",
                        F.lit("manual").alias("origin"), "columns")
    pol = targets.select("table_id", "column_name", "kind", "function", F.col("policy").alias("origin"), "columns")
    out = man.unionByName(pol)
    return out if arguments else out.drop("columns")


def detach(controls: DataFrame, removed: DataFrame) -> DataFrame:
    """Controls without the removed ones: a mask is found by table and column (in any
    case), a row filter by table and its first column."""
    unit = F.lower(F.element_at("columns", 1)).alias("unit")
    keys = removed.select("table_id", "kind", unit).distinct()
    return controls.withColumn("unit", unit).join(keys, ["table_id", "kind", "unit"], "left_anti").drop("unit")


def control_conflicts(controls: DataFrame) -> DataFrame:
    """Two masks on one column, or two row filters on one table.
    (table_id, column_name, kind, n, origins); column_name is NULL for filters. ``origins``
    lists the distinct sources (policies, 'manual'), so its size is bounded by the number
    of policies, not by how many rows a source repeats."""
    unit_col = F.when(F.col("kind") == MASK, F.lower("column_name"))
    return (controls.withColumn("unit_col", unit_col)
            .groupBy("table_id", "unit_col", "kind")
            .agg(F.count(F.lit(1)).alias("n"), F.when(F.col("kind") == MASK, F.min("column_name")).alias("column_name"),
                 F.array_join(F.array_sort(F.collect_set("origin")), ",").alias("origins"))
            .where(F.col("n") > 1)
            .select("table_id", "column_name", "kind", "n", "origins"))


def _in_scope(scope_name: str, scope_kind: str | None) -> Column:
    here = F.col("scope_name") == scope_name
    return here if scope_kind is None else here & (F.col("scope_kind") == scope_kind)


def list_policies(policies: DataFrame, scope_name: str, scope_kind: str | None = None) -> DataFrame:
    """P10: SHOW POLICIES on one securable; without a kind, on those of any kind with that name."""
    return (policies.where(_in_scope(scope_name, scope_kind))
            .select("name", "scope_kind", "kind", "function", "match_key", "match_value").orderBy("name", "scope_kind"))


class PolicyNotFound(KeyError):
    pass


class AmbiguousPolicy(ValueError):
    pass


def scope_of(policies: DataFrame, name: str, scope_name: str, scope_kind: str | None = None) -> str:
    """The scope kind of the one policy meant. A missing one is an error; so is a name that stands on
    securables of several kinds if no kind is given, since dropping either would unprotect it."""
    kinds = [r[0] for r in policies.where((F.col("name") == name) & _in_scope(scope_name, scope_kind)).select("scope_kind").distinct().limit(5).collect()]
    if not kinds:
        raise PolicyNotFound(f"policy {name} on {scope_name} does not exist")
    if len(kinds) > 1:
        raise AmbiguousPolicy(f"policy {name} on {scope_name}: say which of {sorted(kinds)}")
    return kinds[0]


def drop_policy(policies: DataFrame, name: str, scope_name: str, scope_kind: str | None = None) -> DataFrame:
    """Remove one policy; a missing one is an error (there is no IF EXISTS)."""
    kind = scope_of(policies, name, scope_name, scope_kind)
    return policies.where(~((F.col("name") == name) & _in_scope(scope_name, kind)))


def coverage_gaps(current_tags: DataFrame, controls: DataFrame, sensitive_keys: Sequence[str]) -> DataFrame:
    """Columns carrying a sensitive tag and no mask at all: a forgotten policy, or a
    tag no policy matches, leaves the column readable. Column names compare in any case."""
    unit = F.lower("column_name")
    masked = controls.where(F.col("kind") == MASK).select("table_id", unit.alias("unit")).distinct()
    sens = current_tags.where(F.col("key").isin(list(sensitive_keys))).withColumn("unit", unit)
    return sens.join(masked, ["table_id", "unit"], "left_anti").drop("unit")
