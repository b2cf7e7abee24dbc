"""A governance estate derived from the driver tables, so that policy resolution, the
privilege audit and tag propagation do work that grows with the data.

    metastore -> catalog per region -> schema per nation -> table per supplier
    column per (supplier, part) pair seen in lineitem

Tag events come from lineitem rows, grant events from orders and lineitem rows, table
tags from supplier balances. The real driver tables live under ``main.tpch`` so that
protect_table() can apply policies to them. Each builder has a DuckDB twin in SQL_CTES.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import metadata as md
from ..sources.tables import literal, read_table
from .common import MEMBERS_SQL, memberships, values_sql

MAIN_TABLES = ("customer", "supplier", "orders", "events", "doc_emails")

VOCAB_ROWS = [
    ("pii", "ssn"), ("pii", "email"),
    ("rls", "region"), ("rls", "segment"),
    ("sensitivity", "high"), ("sensitivity", "low"),
    ("class", "email_address"), ("class", "us_ssn"), ("class", "phone_number"),
    ("class", "credit_card"), ("class", "ip_address"), ("class", "person_name"),
    ("secret", "token"),
]

E = md.EVERYONE
POLICY_ROWS = [
    ("email_partial_europe", "catalog", "europe", md.MASK, "email_partial", [E], [], None, None, "pii", "email"),
    ("ssn_redact_america", "catalog", "america", md.MASK, "redact", [E], ["gov_admins"], None, None, "pii", "ssn"),
    ("region_rows_asia", "catalog", "asia", md.FILTER, "scope_filter", ["analysts"], [],
     "sensitivity", "high", "rls", "region"),
    ("pii_null_europe3", "schema", "europe.nation_3", md.MASK, "null_mask", [E], [], None, None, "pii", None),
    ("bad_key_asia7", "schema", "asia.nation_7", md.MASK, "redact", [E], [], None, None, "PII", "email"),
    ("main_email", "schema", "main.tpch", md.MASK, "email_partial", [E], [], None, None, "pii", "email"),
    ("main_segment_rows", "schema", "main.tpch", md.FILTER, "scope_filter", [E], ["gov_admins"], None, None,
     "rls", "segment"),
    ("main_ssn_redact", "schema", "main.tpch", md.MASK, "redact", [E], ["gov_admins"], None, None, "pii", "ssn"),
    ("class_email_main", "schema", "main.tpch", md.MASK, "email_partial", [E], [], None, None, "class",
     "email_address"),
]
BROKEN_POLICY = "bad_key_asia7"  # its key is not governed: a read through it raises
POLICY_COLS = [f.name for f in md.POLICIES.fields]
POLICY_TYPES = ["VARCHAR"] * 5 + ["VARCHAR[]", "VARCHAR[]"] + ["VARCHAR"] * 4

HAND_COLUMN_TAGS = [
    (1, "main.tpch.doc_emails", "email", "pii", "email"),
    (2, "main.tpch.customer", "c_mktsegment", "rls", "segment"),
    (3, "main.tpch.customer", "c_name", "pii", "ssn"),
]

HAND_GRANTS = [
    (1, "GRANT", "USE CATALOG", "europe", "seg_building"),
    (2, "GRANT", "USE SCHEMA", "europe.nation_3", "seg_building"),
    (3, "GRANT", "SELECT", "europe.nation_3", "analysts"),
    (4, "GRANT", "USE CATALOG", "asia", md.EVERYONE),
    (5, "GRANT", "USE SCHEMA", "asia.nation_2", md.EVERYONE),
    (6, "GRANT", "SELECT", "asia.nation_2", "eve"),
    (7, "REVOKE", "SELECT", "asia.nation_2", "eve"),
    (8, "REVOKE", "USE CATALOG", "africa", "eve"),
    (9, "GRANT", "MANAGE", "america", "steward_nation_1"),
    (10, "GRANT", "SELECT", "main.tpch.customer", "seg_machinery"),
    (11, "GRANT", "USE SCHEMA", "main.tpch", "seg_machinery"),
    (12, "GRANT", "USE CATALOG", "main", md.EVERYONE),
]

GRANT_COLS = ("seq", "action", "privilege", "securable_id", "principal")
GRANT_TYPES = ("BIGINT", "VARCHAR", "VARCHAR", "VARCHAR", "VARCHAR")


def _slug(c):
    return F.regexp_replace(F.lower(c), " ", "_")


def catalogs(spark: SparkSession, sf: str) -> DataFrame:
    r = read_table(spark, sf, "region")
    return r.select("r_regionkey", _slug(F.col("r_name")).alias("catalog_id"))


def schemas(spark: SparkSession, sf: str) -> DataFrame:
    n = read_table(spark, sf, "nation")
    c = catalogs(spark, sf)
    return n.join(c, n.n_regionkey == c.r_regionkey).select(
        "n_nationkey", F.concat_ws(".", "catalog_id", _slug(F.col("n_name"))).alias("schema_id"),
        _slug(F.col("n_name")).alias("schema_name"), "catalog_id")


def supplier_tables(spark: SparkSession, sf: str) -> DataFrame:
    s = read_table(spark, sf, "supplier")
    sc = schemas(spark, sf)
    return s.join(sc, s.s_nationkey == sc.n_nationkey).select(
        "s_suppkey", "s_name", "s_acctbal", "schema_id",
        F.concat(F.col("schema_id"), F.lit(".supp_"), F.col("s_suppkey").cast("string")).alias("table_id"))


def securables(spark: SparkSession, sf: str) -> DataFrame:
    top = literal(spark, [(md.METASTORE, None, "metastore", md.METASTORE, "admin"),
                          ("main", md.METASTORE, "catalog", "main", "admin"),
                          ("main.tpch", "main", "schema", "tpch", "owner_tpch")]
                  + [(f"main.tpch.{t}", "main.tpch", "table", t, "owner_tpch") for t in MAIN_TABLES],
                  md.SECURABLES)
    cat = catalogs(spark, sf).select(F.col("catalog_id").alias("id"), F.lit(md.METASTORE).alias("parent_id"),
                                     F.lit("catalog").alias("kind"), F.col("catalog_id").alias("name"),
                                     F.lit("admin").alias("owner"))
    sch = schemas(spark, sf).select(F.col("schema_id").alias("id"), F.col("catalog_id").alias("parent_id"),
                                    F.lit("schema").alias("kind"), F.col("schema_name").alias("name"),
                                    F.concat(F.lit("steward_"), F.col("schema_name")).alias("owner"))
    tab = supplier_tables(spark, sf).select(
        F.col("table_id").alias("id"), F.col("schema_id").alias("parent_id"), F.lit("table").alias("kind"),
        F.concat(F.lit("supp_"), F.col("s_suppkey").cast("string")).alias("name"), F.col("s_name").alias("owner"))
    return top.unionByName(cat).unionByName(sch).unionByName(tab)


def _lineitem_tables(spark, sf):
    li = read_table(spark, sf, "lineitem")
    st = supplier_tables(spark, sf).select("s_suppkey", "table_id")
    return li.join(st, li.l_suppkey == st.s_suppkey)


def column_tags(spark: SparkSession, sf: str) -> DataFrame:
    """One tag event per lineitem row on column p<partkey> of its supplier's table."""
    x = _lineitem_tables(spark, sf)
    n_flag = F.col("l_returnflag") == "N"
    key = (F.when(n_flag & (F.col("l_linestatus") == "F"), "PII").when(n_flag, "rls").otherwise("pii"))
    value = (F.when(n_flag & (F.col("l_linestatus") == "O"), "region")
             .when(F.col("l_quantity") >= 48, "phone")
             .when(F.col("l_returnflag") == "R", "ssn").otherwise("email"))
    derived = x.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"), "table_id",
                       F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("column_name"),
                       key.alias("key"), value.alias("value"))
    return literal(spark, HAND_COLUMN_TAGS, md.COLUMN_TAGS).unionByName(derived)


def table_tags(spark: SparkSession, sf: str) -> DataFrame:
    st = supplier_tables(spark, sf)
    return st.select(F.col("s_suppkey").alias("seq"), "table_id", F.lit("sensitivity").alias("key"),
                     F.when(F.col("s_acctbal") > 5000, "high").otherwise("low").alias("value"))


def manual_controls(spark: SparkSession, sf: str) -> DataFrame:
    """Hand-attached masks: first lines of returned items mask their column."""
    x = _lineitem_tables(spark, sf).where((F.col("l_linenumber") == 1) & (F.col("l_returnflag") == "R"))
    return x.select("table_id", F.lit(md.MASK).alias("kind"), F.lit("id_mask").alias("function"),
                    F.array(F.concat(F.lit("p"), F.col("l_partkey").cast("string"))).alias("columns")).distinct()


def vocab(spark: SparkSession) -> DataFrame:
    return literal(spark, VOCAB_ROWS, md.TAG_VOCAB)


def policies(spark: SparkSession) -> DataFrame:
    return literal(spark, POLICY_ROWS, md.POLICIES)


def _cust_name(col):
    return F.concat(F.lit("Customer#"), F.lpad(col.cast("string"), 9, "0"))


def grants_log(spark: SparkSession, sf: str) -> DataFrame:
    """Grant history: hand rows to groups, plus per order USE CATALOG / USE SCHEMA on the
    customer's region and nation, MANAGE for urgent finished orders, and per lineitem
    SELECT on the supplier's table (revoked for returned items)."""
    o = read_table(spark, sf, "orders")
    c = read_table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    sc = schemas(spark, sf)
    oc = o.join(c, o.o_custkey == c.c_custkey).join(sc, F.col("c_nationkey") == sc.n_nationkey)
    # one pass over orders: up to three grant events per order, exploded
    prio = F.col("o_orderpriority")

    def ev(off, action, privilege, securable):
        return F.struct((F.col("o_orderkey") * 10 + off).alias("seq"), action.alias("action"),
                        F.lit(privilege).alias("privilege"), F.col(securable).alias("securable_id"))
    events = F.array(
        ev(0, F.when(prio == "5-LOW", "REVOKE").otherwise("GRANT"), "USE CATALOG", "catalog_id"),
        ev(1, F.when(prio == "4-NOT SPECIFIED", "REVOKE").otherwise("GRANT"), "USE SCHEMA", "schema_id"),
        F.when((prio == "1-URGENT") & (F.col("o_orderstatus") == "F"),
               ev(2, F.lit("GRANT"), "MANAGE", "schema_id")))
    per_order = (oc.select(_cust_name(F.col("o_custkey")).alias("principal"), F.explode(events).alias("e"))
                 .where(F.col("e").isNotNull())
                 .select("e.seq", "e.action", "e.privilege", "e.securable_id", "principal"))
    li = _lineitem_tables(spark, sf)
    lo = li.join(o.select("o_orderkey", "o_custkey"), li.l_orderkey == o.o_orderkey)
    sel = lo.select((F.col("l_orderkey") * 10 + 2 + F.col("l_linenumber")).alias("seq"),
                    F.when(F.col("l_returnflag") == "R", "REVOKE").otherwise("GRANT").alias("action"),
                    F.lit("SELECT").alias("privilege"), F.col("table_id").alias("securable_id"),
                    _cust_name(F.col("o_custkey")).alias("principal"))
    hand = literal(spark, HAND_GRANTS, md.GRANTS_LOG)
    return hand.unionByName(per_order).unionByName(sel)


def principals(spark: SparkSession, sf: str) -> DataFrame:
    """Every user: customers plus the hand-named readers."""
    hand = literal(spark, [("eve",), ("root",), ("ana",)], "principal string")
    cust = read_table(spark, sf, "customer").select(F.col("c_name").alias("principal"))
    return hand.unionByName(cust)


# ---- DuckDB twins -----------------------------------------------------------------------
_SLUG = "replace(lower({}), ' ', '_')"

SQL_CTES: dict[str, str] = {}
SQL_CTES["cats"] = f"SELECT r_regionkey, {_SLUG.format('r_name')} AS catalog_id FROM region"
SQL_CTES["schs"] = (f"SELECT n_nationkey, catalog_id || '.' || {_SLUG.format('n_name')} AS schema_id, "
                    f"{_SLUG.format('n_name')} AS schema_name, catalog_id FROM nation JOIN cats ON n_regionkey = r_regionkey")
SQL_CTES["stabs"] = ("SELECT s_suppkey, s_name, s_acctbal, schema_id, schema_id || '.supp_' || CAST(s_suppkey AS VARCHAR) "
                     "AS table_id FROM supplier JOIN schs ON s_nationkey = n_nationkey")
_top = ([("metastore", None, "metastore", "metastore", "admin"), ("main", "metastore", "catalog", "main", "admin"),
         ("main.tpch", "main", "schema", "tpch", "owner_tpch")]
        + [(f"main.tpch.{t}", "main.tpch", "table", t, "owner_tpch") for t in MAIN_TABLES])
SQL_CTES["securables"] = (
    values_sql(_top, ("id", "parent_id", "kind", "name", "owner"), ["VARCHAR"] * 5)
    + "\n  UNION ALL SELECT catalog_id, 'metastore', 'catalog', catalog_id, 'admin' FROM cats"
    + "\n  UNION ALL SELECT schema_id, catalog_id, 'schema', schema_name, 'steward_' || schema_name FROM schs"
    + "\n  UNION ALL SELECT table_id, schema_id, 'table', 'supp_' || CAST(s_suppkey AS VARCHAR), s_name FROM stabs")
SQL_CTES["litabs"] = "SELECT * FROM lineitem JOIN stabs ON l_suppkey = s_suppkey"
SQL_CTES["column_tags"] = (
    values_sql(HAND_COLUMN_TAGS, ("seq", "table_id", "column_name", "key", "value"),
               ("BIGINT", "VARCHAR", "VARCHAR", "VARCHAR", "VARCHAR"))
    + """
  UNION ALL SELECT l_orderkey * 8 + l_linenumber, table_id, 'p' || CAST(l_partkey AS VARCHAR),
    CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'PII' WHEN l_returnflag = 'N' THEN 'rls' ELSE 'pii' END,
    CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'region' WHEN l_quantity >= 48 THEN 'phone'
         WHEN l_returnflag = 'R' THEN 'ssn' ELSE 'email' END
  FROM litabs""")
SQL_CTES["table_tags"] = ("SELECT s_suppkey AS seq, table_id, 'sensitivity' AS key, "
                          "CASE WHEN s_acctbal > 5000 THEN 'high' ELSE 'low' END AS value FROM stabs")
SQL_CTES["manual"] = ("SELECT DISTINCT table_id, 'MASK' AS kind, 'id_mask' AS function, 'p' || CAST(l_partkey AS VARCHAR) "
                      "AS column_name FROM litabs WHERE l_linenumber = 1 AND l_returnflag = 'R'")
SQL_CTES["vocab"] = values_sql(VOCAB_ROWS, ("key", "allowed_value"), ("VARCHAR", "VARCHAR"))
SQL_CTES["policies"] = values_sql(POLICY_ROWS, POLICY_COLS, POLICY_TYPES)
_cn = "'Customer#' || lpad(CAST({} AS VARCHAR), 9, '0')"
SQL_CTES["grants"] = (
    values_sql(HAND_GRANTS, GRANT_COLS, GRANT_TYPES)
    + f"""
  UNION ALL SELECT o_orderkey * 10, CASE WHEN o_orderpriority = '5-LOW' THEN 'REVOKE' ELSE 'GRANT' END, 'USE CATALOG',
    catalog_id, {_cn.format('o_custkey')} FROM orders JOIN customer ON o_custkey = c_custkey JOIN schs ON c_nationkey = n_nationkey
  UNION ALL SELECT o_orderkey * 10 + 1, CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'REVOKE' ELSE 'GRANT' END,
    'USE SCHEMA', schema_id, {_cn.format('o_custkey')} FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN schs ON c_nationkey = n_nationkey
  UNION ALL SELECT o_orderkey * 10 + 2, 'GRANT', 'MANAGE', schema_id, {_cn.format('o_custkey')} FROM orders
    JOIN customer ON o_custkey = c_custkey JOIN schs ON c_nationkey = n_nationkey
    WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'
  UNION ALL SELECT l_orderkey * 10 + 2 + l_linenumber, CASE WHEN l_returnflag = 'R' THEN 'REVOKE' ELSE 'GRANT' END,
    'SELECT', table_id, {_cn.format('o_custkey')} FROM litabs JOIN orders ON l_orderkey = o_orderkey""")
SQL_CTES["members"] = MEMBERS_SQL
SQL_CTES["principals"] = "SELECT * FROM (VALUES ('eve'), ('root'), ('ana')) AS v(principal) UNION ALL SELECT c_name FROM customer"
# tables with their path
SQL_CTES["paths"] = """SELECT t.id AS table_id, s.id AS schema_id, c.id AS catalog_id, c.parent_id AS metastore_id
  FROM securables t LEFT JOIN securables s ON t.parent_id = s.id AND s.kind = 'schema'
  LEFT JOIN securables c ON s.parent_id = c.id AND c.kind = 'catalog' WHERE t.kind = 'table'"""
SQL_CTES["cur_tags"] = ("SELECT table_id, column_name, key, max({'s': seq, 'v': value}).v AS value FROM column_tags "
                        "GROUP BY table_id, column_name, key")
SQL_CTES["cur_ttags"] = ("SELECT table_id, key, max({'s': seq, 'v': value}).v AS value FROM table_tags "
                         "GROUP BY table_id, key")

_ORDER = ["cats", "schs", "stabs", "securables", "litabs", "column_tags", "table_tags", "manual", "vocab",
          "policies", "grants", "members", "principals", "paths", "cur_tags", "cur_ttags"]


def sql_with(extra: dict[str, str] | None = None, body: str = "", recursive: bool = False) -> str:
    """WITH <estate CTEs> <extra CTEs> <body>."""
    parts = [f"{k} AS (\n  {SQL_CTES[k]}\n)" for k in _ORDER]
    parts += [f"{k} AS (\n  {v}\n)" for k, v in (extra or {}).items()]
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n" + body


__all__ = ["memberships", "securables", "column_tags", "table_tags", "manual_controls", "vocab", "policies",
           "grants_log", "principals", "supplier_tables", "sql_with", "MEMBERS_SQL"]
