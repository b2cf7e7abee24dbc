"""Securable hierarchy and group closure, shared by policies (scope) and privileges
(inheritance, group grants).

Both are fixpoints computed as distributed joins. Each round writes a table
into the shared folder, so the lineage stays one round deep and a lost executor
recomputes from the last round, not from the first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.metadata import EVERYONE
from ..sources.written import written


def table_paths(securables: DataFrame) -> DataFrame:
    """One row per table: (table_id, schema_id, catalog_id, metastore_id). The hierarchy
    has fixed depth, so three equi-joins replace a recursive walk; the schema and catalog
    sides are small and AQE broadcasts them from their measured size."""
    t = securables.where(F.col("kind") == "table").select(
        F.col("id").alias("table_id"), F.col("parent_id").alias("schema_id"))
    s = securables.where(F.col("kind") == "schema").select(
        F.col("id").alias("schema_id"), F.col("parent_id").alias("catalog_id"))
    c = securables.where(F.col("kind") == "catalog").select(
        F.col("id").alias("catalog_id"), F.col("parent_id").alias("metastore_id"))
    return t.join(s, "schema_id", "left").join(c, "catalog_id", "left").select(
        "table_id", "schema_id", "catalog_id", "metastore_id")


def table_ancestors(securables: DataFrame) -> DataFrame:
    """(table_id, ancestor_id, ancestor_kind): the table itself and each level above it.
    Fan-out is exactly four rows per table, so it never explodes."""
    p = table_paths(securables)
    levels = [("table_id", "table"), ("schema_id", "schema"), ("catalog_id", "catalog"),
              ("metastore_id", "metastore")]
    return p.select("table_id", F.explode(F.array(*[
        F.struct(F.col(c).alias("ancestor_id"), F.lit(k).alias("ancestor_kind")) for c, k in levels
    ])).alias("a")).select("table_id", "a.ancestor_id", "a.ancestor_kind").where(
        F.col("ancestor_id").isNotNull())


def group_closure(memberships: DataFrame) -> DataFrame:
    """(member, group_name) for direct and nested membership; cycle-safe.

    The group-to-group part is closed first, by joining it with itself until a round adds
    nothing: paths double, so rounds grow with the logarithm of the longest chain, and only
    groups take part. One join then carries every member to all groups above its own. A
    popular group that holds a third of all members is one key on the left that AQE's skew
    handling splits.
    """
    direct = memberships.select("member", "group_name").where(
        F.col("member").isNotNull() & F.col("group_name").isNotNull()).distinct()
    groups = direct.select(F.col("group_name").alias("g")).distinct()
    nested = written(direct.join(groups, direct.member == groups.g, "left_semi")
                           .select(F.col("member").alias("via"), F.col("group_name").alias("up")))
    size = nested.count()
    while size:
        further = nested.select("via", F.col("up").alias("mid")).join(
            nested.select(F.col("via").alias("mid"), "up"), "mid").select("via", "up")
        nested = written(nested.unionByName(further).distinct())
        if (grown := nested.count()) == size:
            break
        size = grown
    above = direct.join(nested, direct.group_name == nested.via).select("member", F.col("up").alias("group_name"))
    return direct.unionByName(above).distinct()


def identities(memberships: DataFrame, principals: DataFrame | None = None) -> DataFrame:
    """(principal, identity): every principal is itself, each of its groups (nested), and
    the everyone-group. ``principals`` defaults to members that are not groups."""
    closure = group_closure(memberships)
    if principals is None:
        groups = memberships.select(F.col("group_name").alias("member")).distinct()
        principals = memberships.select("member").distinct().join(groups, "member", "left_anti")
    principals = principals.select(F.col(principals.columns[0]).alias("principal")).distinct()
    via_groups = closure.join(principals, closure.member == principals.principal, "left_semi").select(
        F.col("member").alias("principal"), F.col("group_name").alias("identity"))
    own = principals.select("principal", F.col("principal").alias("identity"))
    everyone = principals.select("principal", F.lit(EVERYONE).alias("identity"))
    return own.unionByName(via_groups).unionByName(everyone).distinct()
