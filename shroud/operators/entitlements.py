"""Entitlements (E1-E6): who may see raw values, which scopes, which groups.

The per-reader answers are uncorrelated scalar subqueries (``DataFrame.scalar()``): Spark
runs each once per query as a small job before the main stage and embeds the result in the
Filter/Project, so the data itself is never joined or shuffled, and an entitlement appended
after the DataFrame was built is still seen when it runs.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.metadata import EVERYONE
from .tags import latest


def allowed_raw(entitlements: DataFrame, principal: str) -> Column:
    """True iff the reader has some row with can_view_raw true (NULL counts as no)."""
    mine = entitlements.where(F.col("principal") == F.lit(principal))
    return mine.agg(F.coalesce(F.bool_or(F.col("can_view_raw")), F.lit(False))).scalar()


def scopes(entitlements: DataFrame, principal: str) -> Column:
    """The reader's scope set, union over all of their rows (array Column)."""
    mine = entitlements.where(F.col("principal") == F.lit(principal))
    return mine.agg(F.array_sort(F.collect_set(F.col("scope")))).scalar()


SCOPE_BUCKETS = 4096


def scope_buckets(entitlements: DataFrame, principal: str) -> Column:
    """E2 for a set of any size: the reader's scopes dealt by hash over SCOPE_BUCKETS short
    arrays, as one scalar subquery. A lookup reads one bucket, so a filter over it costs the
    same per row for ten scopes and for a million."""
    mine = entitlements.where((F.col("principal") == F.lit(principal)) & F.col("scope").isNotNull())
    held = mine.select("scope", scope_bucket(F.col("scope")).alias("b")).distinct().groupBy("b").agg(
        F.collect_list("scope").alias("s"))
    every = entitlements.sparkSession.range(SCOPE_BUCKETS).select(F.col("id").alias("b"))
    none = F.array().cast("array<string>")
    dense = every.join(held, "b", "left").agg(
        F.sort_array(F.collect_list(F.struct("b", F.coalesce("s", none).alias("s")))).alias("x"))
    return dense.select(F.transform("x", lambda x: x["s"])).scalar()


def scope_bucket(scope: Column) -> Column:
    return F.pmod(F.xxhash64(scope.cast("string")), F.lit(SCOPE_BUCKETS))


def scope_rows(entitlements: DataFrame) -> DataFrame:
    """E2 for every principal, in long form: (principal, scope, can_view_raw) with one row
    per distinct scope and the principal's raw flag. No scope set is gathered: a principal
    with a third of all rows is a distinct plus a join on a key that AQE splits."""
    raw = entitlements.groupBy("principal").agg(
        F.coalesce(F.bool_or("can_view_raw"), F.lit(False)).alias("can_view_raw"))
    return entitlements.select("principal", "scope").distinct().join(raw, "principal")


def grant_entitlement(entitlements: DataFrame, principal: str, scope: str | None,
                      can_view_raw: bool | None) -> DataFrame:
    """Append a row (a second identical row is allowed, as INSERT would)."""
    row = entitlements.sparkSession.createDataFrame([(principal, scope, can_view_raw)], entitlements.schema)
    return entitlements.unionByName(row)


def current_entitlements(log: DataFrame) -> DataFrame:
    """E4 over a change log (seq, op, principal, scope, can_view_raw).

    INSERT adds a row; SET_SCOPE / SET_RAW rewrite *every* row of the principal that
    exists at that time. The state is the inserted rows, each taking the value of the
    latest later SET event. Parquet has no UPDATE, and overwriting files under a live
    plan breaks readers, so changes are appended and folded here.
    """
    ins = log.where(F.col("op") == "INSERT").select(
        "principal", F.col("seq").alias("ins_seq"), "scope", "can_view_raw")

    def last_set(op: str, col: str) -> DataFrame:
        # a partial aggregate: a principal with a third of all events is pre-combined
        # on each map task, not gathered in one
        return (log.where(F.col("op") == op).groupBy("principal")
                .agg(F.max("seq").alias(f"{op}_seq"), latest(col).alias(f"{op}_val")))

    out = (ins.join(last_set("SET_SCOPE", "scope"), "principal", "left")
              .join(last_set("SET_RAW", "can_view_raw"), "principal", "left"))
    return out.select(
        "principal",
        F.when(F.col("SET_SCOPE_seq") > F.col("ins_seq"), F.col("SET_SCOPE_val"))
         .otherwise(F.col("scope")).alias("scope"),
        F.when(F.col("SET_RAW_seq") > F.col("ins_seq"), F.col("SET_RAW_val"))
         .otherwise(F.col("can_view_raw")).alias("can_view_raw"),
    )


FRONTIER = 1000


def principal_groups(memberships: DataFrame, principal: str) -> list[str]:
    """E6 support: every group the principal belongs to, directly or through nested
    groups, plus the everyone-group. Cycle-safe: a group is followed once, and the walk ends
    when a step finds no new group, however long a chain of groups is.

    Memberships are resolved when the protected DataFrame is built (a snapshot), like a
    platform that caches group membership; entitlements stay live subqueries. A step from more
    than FRONTIER groups is a semi join on Spark, not a literal list; what comes to the driver is
    the reader's own set of group names.
    """
    seen: set[str] = set()
    frontier = [principal]
    while frontier:
        if len(frontier) <= FRONTIER:
            held = memberships.where(F.col("member").isin(frontier))
        else:
            names = memberships.sparkSession.createDataFrame([(f,) for f in frontier], "member string")
            held = memberships.join(names, "member", "left_semi")
        step = held.select("group_name").distinct().collect()
        frontier = sorted({r[0] for r in step if r[0] is not None} - seen)
        seen |= set(frontier)
    seen.add(EVERYONE)
    return sorted(seen)


def is_member(groups: Iterable[str], group: str) -> Column:
    """Membership test as a boolean literal; the everyone-group always holds."""
    return F.lit(group == EVERYONE or group in set(groups))
