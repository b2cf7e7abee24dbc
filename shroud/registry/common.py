"""Shared inputs of the registered queries.

Every registered query reads the driver tables; the control relations below are the small
hand-written part a data owner would type (who is entitled, which columns are tagged,
which policies exist). Where a relation can grow with the data it is derived from the
driver tables instead (entitlements and memberships of customers, the estate of
supplier tables in ``estate.py``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import metadata as md
from ..sources.tables import literal, read_table


def sql_lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    if isinstance(v, (list, tuple)):
        return "[" + ", ".join(sql_lit(x) for x in v) + "]"
    return "'" + str(v).replace("'", "''") + "'"


def values_sql(rows: Sequence[Sequence], cols: Sequence[str], types: Sequence[str]) -> str:
    """A VALUES relation with explicit casts, so NULL columns keep their type in DuckDB."""
    body = ",\n    ".join(
        "(" + ", ".join(f"CAST({sql_lit(v)} AS {t})" for v, t in zip(r, types)) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES\n    {body}) AS v({', '.join(cols)}))"


# ---- entitlements -------------------------------------------------------------------
# Readers used by the queries:
#   ana  two scopes, raw on one of them (so raw everywhere: mask and filter are independent)
#   bo   ALL, never raw          cy  ALL, raw
#   dee  one scope, flag NULL (= not raw), the row twice
#   zed  no row at all
#   ops  two event types (stream), never raw
ENT_ROWS = [
    ("ana", "BUILDING", True),
    ("ana", "MACHINERY", False),
    ("bo", "ALL", False),
    ("cy", "ALL", True),
    ("dee", "HOUSEHOLD", None),
    ("dee", "HOUSEHOLD", None),
    ("ops", "click", False),
    ("ops", "error", False),
]
ENT_COLS = ("principal", "scope", "can_view_raw")
ENT_TYPES = ("VARCHAR", "VARCHAR", "BOOLEAN")


def entitlements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hand-written rows plus one row per customer (its own segment, raw if the balance
    is positive), so the entitlement relation grows with the data."""
    hand = literal(spark, ENT_ROWS, md.ENTITLEMENTS)
    cust = read_table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("principal"), F.col("c_mktsegment").alias("scope"),
        (F.col("c_acctbal") > 0).alias("can_view_raw"))
    return hand.unionByName(cust)


ENTS_SQL = (values_sql(ENT_ROWS, ENT_COLS, ENT_TYPES)
            + "\n  UNION ALL SELECT c_name, c_mktsegment, c_acctbal > 0 FROM customer")

# ---- memberships --------------------------------------------------------------------
MEMBER_ROWS = [
    ("eve", "region_europe"),
    ("eve", "region_asia"),
    ("eve", "analysts"),
    ("root", "gov_admins"),
    ("seg_building", "analysts"),
    ("analysts", "staff"),
    ("staff", "analysts"),          # a cycle: resolution must stop
    ("Customer#000000007", "gov_admins"),
]
MEMBER_COLS = ("member", "group_name")
MEMBER_TYPES = ("VARCHAR", "VARCHAR")


def memberships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hand-written rows plus customer -> segment group."""
    hand = literal(spark, MEMBER_ROWS, md.MEMBERSHIPS)
    cust = read_table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("member"),
        F.concat(F.lit("seg_"), F.lower("c_mktsegment")).alias("group_name"))
    return hand.unionByName(cust)


MEMBERS_SQL = (values_sql(MEMBER_ROWS, MEMBER_COLS, MEMBER_TYPES)
               + "\n  UNION ALL SELECT c_name, 'seg_' || lower(c_mktsegment) FROM customer")


def with_ctes(ctes: dict[str, str], body: str) -> str:
    parts = ",\n".join(f"{k} AS (\n  {v}\n)" for k, v in ctes.items())
    return f"WITH {parts}\n{body}"
