"""Row-filter predicates (F1-F3). Inputs are Columns that the reader context builds as
uncorrelated scalar subqueries, so the predicate is evaluated inside the same Filter as any
user predicate and ahead of it (see README, "error channel")."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.metadata import ALL_SCOPE


def scope_predicate(value: Column, scopes: Column) -> Column:
    """keep a row iff the reader's scope set holds the row's value, or holds ALL.
    A NULL value is visible only through ALL (NULL OR true). ``scopes`` is referenced
    once, so a subquery behind it runs once."""
    # arrays_overlap is NULL (not true) when the only shared element would be NULL
    return F.arrays_overlap(scopes, F.array(value, F.lit(ALL_SCOPE)))


def scope_bucket_predicate(value: Column, buckets: Column, bucket_of: Callable[[Column], Column]) -> Column:
    """F1 over a bucketed scope set, for any number of scopes. ALL is looked up like any
    scope, inside the plan, so a revoked ALL closes a long-held view again."""
    def held(scope: Column) -> Column:
        return F.coalesce(F.array_contains(F.get(buckets, bucket_of(scope).cast("int")), scope.cast("string")), F.lit(False))
    return F.when(value.isNull(), held(F.lit(ALL_SCOPE))).otherwise(held(value) | held(F.lit(ALL_SCOPE)))


def scope_literal_predicate(value: Column, scopes: list[str]) -> Column | None:
    """F1 with a resolved scope set: None when the set holds ALL (no filter at all),
    else a literal IN list, which the parquet reader can use to skip row groups."""
    if ALL_SCOPE in scopes:
        return None
    if not scopes:
        return F.lit(False)
    return value.isin(*scopes)


def group_predicate(value: Column, groups: Column, prefix: str,
                    admin: Column | None = None) -> Column:
    """member of the group named prefix + lower(value); with ``admin`` (a boolean
    Column: membership in an admin group) every row is visible."""
    own = F.array_contains(groups, F.concat(F.lit(prefix), F.lower(value)))
    return own if admin is None else (admin | own)
