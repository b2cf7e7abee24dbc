"""Registered queries for masks, row filters, entitlements and materialised forms
(SURVEY 2.1-2.3, 2.7). Spark side and DuckDB oracle side are written independently:
the oracle uses EXISTS / IN where the library uses scope arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.masks import EMAIL_HIDDEN_TEXT, ID_MASK_TEXT
from ..operators.classify import extract_all
from ..operators import entitlements as E
from ..operators import policies as P
from ..plans.protect import (Control, Reader, default_functions, export_protected, group_constant_mask,
                             group_filter, protect, protected_view)
from ..session import shared_dir
from ..sources import metadata as md
from ..sources.tables import literal, read_table
from .common import ENTS_SQL, MEMBERS_SQL, entitlements, memberships, with_ctes

EMAIL_RE = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"

CUSTOMER_CONTROLS = [
    Control(md.FILTER, "scope_filter", ("c_mktsegment",)),
    Control(md.MASK, "id_mask", ("c_name",)),
    Control(md.MASK, "null_mask", ("c_acctbal",)),
]


def _cust(spark, sf):
    return read_table(spark, sf, "customer")


def _reader(spark, sf, who):
    return Reader(who, entitlements(spark, sf), memberships(spark, sf))


def _sql_raw(who: str) -> str:
    return (f"(SELECT coalesce(bool_or(can_view_raw), false) FROM ents WHERE principal = '{who}')")


def _sql_visible(who: str, col: str) -> str:
    return (f"EXISTS (SELECT 1 FROM ents e WHERE e.principal = '{who}' "
            f"AND (e.scope = {col} OR e.scope = 'ALL'))")


# ---- flagship: filter and two masks on customer (F6, M1, M2, F1, E1, E2) --------------
def q_protect_filter_and_mask(spark: SparkSession, sf: str) -> DataFrame:
    return protect(_cust(spark, sf), CUSTOMER_CONTROLS, _reader(spark, sf, "ana"))


SQL_PROTECT_FILTER_AND_MASK = with_ctes({"ents": ENTS_SQL}, f"""
SELECT c_custkey,
       CASE WHEN {_sql_raw('ana')} THEN c_name ELSE '{ID_MASK_TEXT}' END AS c_name,
       c_nationkey,
       CASE WHEN {_sql_raw('ana')} THEN c_acctbal ELSE NULL END AS c_acctbal,
       c_mktsegment
FROM customer WHERE {_sql_visible('ana', 'customer.c_mktsegment')}""")


def q_mask_constant(spark, sf):
    df = protect(_cust(spark, sf), [Control(md.MASK, "id_mask", ("c_name",))], _reader(spark, sf, "bo"))
    return df.select("c_custkey", "c_name")


SQL_MASK_CONSTANT = with_ctes({"ents": ENTS_SQL}, f"""
SELECT c_custkey, CASE WHEN {_sql_raw('bo')} THEN c_name ELSE '{ID_MASK_TEXT}' END AS c_name
FROM customer""")


def q_mask_null_numeric(spark, sf):
    df = protect(_cust(spark, sf), [Control(md.MASK, "null_mask", ("c_acctbal",))], _reader(spark, sf, "dee"))
    return df.select("c_custkey", "c_acctbal")


SQL_MASK_NULL_NUMERIC = with_ctes({"ents": ENTS_SQL}, f"""
SELECT c_custkey, CASE WHEN {_sql_raw('dee')} THEN c_acctbal END AS c_acctbal FROM customer""")


def email_addresses(spark, sf) -> DataFrame:
    """Addresses pulled out of whole document texts: (doc_id, pos, email)."""
    docs = read_table(spark, sf, "documents")
    return docs.select("doc_id", F.posexplode(extract_all(F.col("text"), EMAIL_RE, "@"))
                       .alias("pos", "email")).select("doc_id", (F.col("pos") + 1).cast("bigint").alias("pos"), "email")


EMAILS_SQL = f"""SELECT doc_id, unnest(generate_series(1, len(m))) AS pos, unnest(m) AS email
  FROM (SELECT doc_id, regexp_extract_all(text, '{EMAIL_RE}') AS m FROM documents)"""


def _sql_email_mask(c: str) -> str:
    return (f"CASE WHEN {c} IS NULL THEN NULL WHEN instr({c}, '@') = 0 THEN '{EMAIL_HIDDEN_TEXT}' "
            f"ELSE substring({c}, 1, 1) || '{EMAIL_HIDDEN_TEXT}@' || substring({c}, instr({c}, '@') + 1) END")


def q_mask_email_partial(spark, sf):
    # policy-free use of M3: the mask is not gated, every reader sees the same result
    return protect(email_addresses(spark, sf), [Control(md.MASK, "email_partial", ("email",))],
                   Reader("anyone"))


SQL_MASK_EMAIL_PARTIAL = with_ctes({"emails": EMAILS_SQL},
                                   f"SELECT doc_id, pos, {_sql_email_mask('email')} AS email FROM emails")


def _gated_functions():
    fx = default_functions()
    fx.mask("name_unless_machinery", group_constant_mask("seg_machinery", ID_MASK_TEXT))
    fx.filter("region_groups_admin", group_filter("region_", admin_group="gov_admins"))
    fx.filter("region_groups", group_filter("region_"))
    return fx


def q_mask_group_gated(spark, sf):
    """Raw for members of a group. Customer#000000001 is in seg_machinery,
    Customer#000000002 is not."""
    fx = _gated_functions()
    parts = []
    for who in ("Customer#000000001", "Customer#000000002"):
        df = protect(_cust(spark, sf), [Control(md.MASK, "name_unless_machinery", ("c_name",))],
                     _reader(spark, sf, who), fx)
        parts.append(df.select(F.lit(who).alias("reader"), "c_custkey", "c_name"))
    return parts[0].unionByName(parts[1])


SQL_MASK_GROUP_GATED = with_ctes({"members": MEMBERS_SQL}, f"""
SELECT r.reader, c.c_custkey,
       CASE WHEN EXISTS (SELECT 1 FROM members m WHERE m.member = r.reader AND m.group_name = 'seg_machinery')
            THEN c.c_name ELSE '{ID_MASK_TEXT}' END AS c_name
FROM customer c, (VALUES ('Customer#000000001'), ('Customer#000000002')) AS r(reader)""")


def _cust_region(spark, sf):
    c = _cust(spark, sf)
    n = read_table(spark, sf, "nation")
    r = read_table(spark, sf, "region")
    return (c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
            .select("c_custkey", "c_name", "r_name"))


def _group_rows(spark, sf, fn, readers):
    fx = _gated_functions()
    parts = [protect(_cust_region(spark, sf), [Control(md.FILTER, fn, ("r_name",))], _reader(spark, sf, w), fx)
             .select(F.lit(w).alias("reader"), "c_custkey", "r_name") for w in readers]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_row_filter_group_admin(spark, sf):
    """eve sees Europe and Asia through region groups; root sees all as an admin;
    Customer#000000007 is an admin too; Customer#000000008 sees nothing."""
    return _group_rows(spark, sf, "region_groups_admin",
                       ["eve", "root", "Customer#000000007", "Customer#000000008"])


def q_row_filter_group(spark, sf):
    """no admin bypass, so root sees nothing."""
    return _group_rows(spark, sf, "region_groups", ["eve", "root"])


_CR_SQL = """SELECT c_custkey, c_name, r_name FROM customer
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

# groups of a reader: direct rows followed to a fixpoint (nested groups, cycle-safe UNION)
_GROUPS_SQL = """SELECT member AS reader, group_name FROM members
  UNION SELECT g.reader, m.group_name FROM grp g JOIN members m ON m.member = g.group_name"""


def _sql_group_rows(readers, admin: bool) -> str:
    rs = ", ".join(f"('{r}')" for r in readers)
    admin_term = ("EXISTS (SELECT 1 FROM grp g WHERE g.reader = r.reader AND g.group_name = 'gov_admins') OR "
                  if admin else "")
    return ("WITH RECURSIVE members AS (" + MEMBERS_SQL + "), grp(reader, group_name) AS (" + _GROUPS_SQL
            + "), cr AS (" + _CR_SQL + ")\n"
            f"SELECT r.reader, cr.c_custkey, cr.r_name FROM cr, (VALUES {rs}) AS r(reader)\n"
            f"WHERE {admin_term}EXISTS (SELECT 1 FROM grp g WHERE g.reader = r.reader "
            f"AND g.group_name = 'region_' || lower(cr.r_name))")


SQL_ROW_FILTER_GROUP_ADMIN = _sql_group_rows(["eve", "root", "Customer#000000007", "Customer#000000008"], True)
SQL_ROW_FILTER_GROUP = _sql_group_rows(["eve", "root"], False)


def _scope_rows(spark, sf, who):
    return protect(_cust(spark, sf), [Control(md.FILTER, "scope_filter", ("c_mktsegment",))],
                   _reader(spark, sf, who)).select("c_custkey", "c_mktsegment")


def q_row_filter_scope(spark, sf):
    return _scope_rows(spark, sf, "dee")


def q_row_filter_all(spark, sf):
    return _scope_rows(spark, sf, "bo")


def q_row_filter_none(spark, sf):
    return _scope_rows(spark, sf, "zed").agg(F.count(F.lit(1)).alias("n"))


def _sql_scope_rows(who):
    return with_ctes({"ents": ENTS_SQL}, f"""
SELECT c_custkey, c_mktsegment FROM customer c
WHERE c_mktsegment IN (SELECT scope FROM ents WHERE principal = '{who}')
   OR EXISTS (SELECT 1 FROM ents WHERE principal = '{who}' AND scope = 'ALL')""")


SQL_ROW_FILTER_SCOPE = _sql_scope_rows("dee")
SQL_ROW_FILTER_ALL = _sql_scope_rows("bo")
SQL_ROW_FILTER_NONE = f"SELECT count(*) AS n FROM ({_sql_scope_rows('zed')}) AS t"


def q_protect_multi_column_mask(spark, sf):
    """M6: one mask function on two columns of lineitem, for a reader without raw rights."""
    li = read_table(spark, sf, "lineitem")
    ctl = [Control(md.MASK, "null_mask", ("l_extendedprice",)), Control(md.MASK, "null_mask", ("l_discount",))]
    return protect(li, ctl, _reader(spark, sf, "bo")).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount")


SQL_PROTECT_MULTI_COLUMN_MASK = with_ctes({"ents": ENTS_SQL}, f"""
SELECT l_orderkey, l_linenumber, l_quantity,
       CASE WHEN {_sql_raw('bo')} THEN l_extendedprice END AS l_extendedprice,
       CASE WHEN {_sql_raw('bo')} THEN l_discount END AS l_discount
FROM lineitem""")


def manual_controls(spark) -> DataFrame:
    rows = [(t, c.kind, c.function, list(c.columns)) for t in ("main.tpch.customer",) for c in CUSTOMER_CONTROLS]
    return literal(spark, rows, md.MANUAL_CONTROLS)


def q_control_detach(spark, sf):
    ctl = manual_controls(spark)
    removed = literal(spark, [("main.tpch.customer", md.MASK, "null_mask", ["c_acctbal"]),
                              ("main.tpch.customer", md.FILTER, "scope_filter", ["c_mktsegment"])],
                      md.MANUAL_CONTROLS)
    left = P.detach(ctl, removed).where(F.col("table_id") == "main.tpch.customer").collect()
    return protect(_cust(spark, sf), left, _reader(spark, sf, "dee"))


SQL_CONTROL_DETACH = with_ctes({"ents": ENTS_SQL}, f"""
SELECT c_custkey, CASE WHEN {_sql_raw('dee')} THEN c_name ELSE '{ID_MASK_TEXT}' END AS c_name,
       c_nationkey, c_acctbal, c_mktsegment FROM customer""")


def q_protected_group_count(spark, sf):
    """counts see only the visible rows; sums see masked values."""
    df = protect(_cust(spark, sf), CUSTOMER_CONTROLS, _reader(spark, sf, "ana"))
    return df.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"),
                                          F.round(F.sum("c_acctbal"), 2).alias("sum_acctbal"))


SQL_PROTECTED_GROUP_COUNT = (f"SELECT c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS sum_acctbal "
                             f"FROM ({SQL_PROTECT_FILTER_AND_MASK}) AS p GROUP BY c_mktsegment")


def q_protected_view(spark, sf):
    protected_view("customer_for_dee", _cust(spark, sf), CUSTOMER_CONTROLS, _reader(spark, sf, "dee"))
    return spark.sql("SELECT c_mktsegment, count(*) AS n, count(c_acctbal) AS n_balance, "
                     "count_if(c_name = 'XXX-XX-XXXX') AS n_masked FROM customer_for_dee GROUP BY c_mktsegment")


SQL_PROTECTED_VIEW = with_ctes({"ents": ENTS_SQL}, f"""
SELECT c_mktsegment, count(*) AS n, CAST(0 AS BIGINT) AS n_balance, count(*) AS n_masked
FROM customer WHERE {_sql_visible('dee', 'customer.c_mktsegment')} GROUP BY c_mktsegment""")


def q_export_protected(spark, sf):
    df = protect(_cust(spark, sf), CUSTOMER_CONTROLS, _reader(spark, sf, "ana"))
    import uuid
    return export_protected(df, shared_dir(spark, f"exports/customer_ana_{uuid.uuid4().hex}"))


SQL_EXPORT_PROTECTED = SQL_PROTECT_FILTER_AND_MASK


def q_entitlement_scopes(spark, sf):
    return E.scope_rows(entitlements(spark, sf))


SQL_ENTITLEMENT_SCOPES = with_ctes({"ents": ENTS_SQL}, """
SELECT s.principal, s.scope, r.can_view_raw
FROM (SELECT DISTINCT principal, scope FROM ents) AS s
JOIN (SELECT principal, coalesce(bool_or(can_view_raw), false) AS can_view_raw FROM ents GROUP BY principal) AS r
  ON r.principal = s.principal""")


def q_entitlement_toggle(spark, sf):
    """The same protected read before and after one appended entitlement row."""
    ent = entitlements(spark, sf)
    ctl = [Control(md.MASK, "id_mask", ("c_name",))]
    out = []
    for phase, rel in (("before", ent), ("after", E.grant_entitlement(ent, "gil", "FURNITURE", True))):
        df = protect(_cust(spark, sf), ctl, Reader("gil", rel))
        out.append(df.agg(F.count(F.lit(1)).alias("n"),
                          F.count_if(F.col("c_name") == ID_MASK_TEXT).alias("n_masked"))
                   .select(F.lit(phase).alias("phase"), "n", "n_masked"))
    return out[0].unionByName(out[1])


SQL_ENTITLEMENT_TOGGLE = f"""
SELECT 'before' AS phase, count(*) AS n, count(*) AS n_masked FROM customer
UNION ALL SELECT 'after', count(*), CAST(0 AS BIGINT) FROM customer"""


def entitlement_log(spark, sf) -> DataFrame:
    """A change log that grows with the data: every customer is inserted with its segment;
    every pending order moves its customer to the order's priority; every order of the
    lowest priority switches raw values off."""
    cust = _cust(spark, sf).select(
        F.col("c_custkey").alias("seq"), F.lit("INSERT").alias("op"), F.col("c_name").alias("principal"),
        F.col("c_mktsegment").alias("scope"), (F.col("c_acctbal") > 0).alias("can_view_raw"))
    o = read_table(spark, sf, "orders")
    name = F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    moves = o.where(F.col("o_orderstatus") == "P").select(
        (F.col("o_orderkey") * 4 + 1).alias("seq"), F.lit("SET_SCOPE").alias("op"), name.alias("principal"),
        F.col("o_orderpriority").alias("scope"), F.lit(None).cast("boolean").alias("can_view_raw"))
    offs = o.where(F.col("o_orderpriority") == "5-LOW").select(
        (F.col("o_orderkey") * 4 + 2).alias("seq"), F.lit("SET_RAW").alias("op"), name.alias("principal"),
        F.lit(None).cast("string").alias("scope"), F.lit(False).alias("can_view_raw"))
    return cust.unionByName(moves).unionByName(offs)


def q_entitlement_latest(spark, sf):
    return E.current_entitlements(entitlement_log(spark, sf))


SQL_ENTITLEMENT_LATEST = """
WITH log AS (
  SELECT c_custkey AS seq, 'INSERT' AS op, c_name AS principal, c_mktsegment AS scope, c_acctbal > 0 AS raw FROM customer
  UNION ALL SELECT o_orderkey * 4 + 1, 'SET_SCOPE', 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0'),
         o_orderpriority, NULL FROM orders WHERE o_orderstatus = 'P'
  UNION ALL SELECT o_orderkey * 4 + 2, 'SET_RAW', 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0'),
         NULL, false FROM orders WHERE o_orderpriority = '5-LOW'
)
SELECT i.principal,
  coalesce((SELECT s.scope FROM log s WHERE s.op = 'SET_SCOPE' AND s.principal = i.principal AND s.seq > i.seq
            ORDER BY s.seq DESC LIMIT 1), i.scope) AS scope,
  CASE WHEN EXISTS (SELECT 1 FROM log s WHERE s.op = 'SET_RAW' AND s.principal = i.principal AND s.seq > i.seq)
       THEN (SELECT s.raw FROM log s WHERE s.op = 'SET_RAW' AND s.principal = i.principal ORDER BY s.seq DESC LIMIT 1)
       ELSE i.raw END AS can_view_raw
FROM log i WHERE i.op = 'INSERT'"""


def q_table_row_counts(spark, sf):
    """Labelled counts, UNION ALL, ORDER BY."""
    parts = [read_table(spark, sf, t).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(t).alias("table_name"), "row_count")
             for t in ("customer", "orders", "lineitem", "supplier")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("table_name")


SQL_TABLE_ROW_COUNTS = """
SELECT 'customer' AS table_name, count(*) AS row_count FROM customer
UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'lineitem', count(*) FROM lineitem
UNION ALL SELECT 'supplier', count(*) FROM supplier ORDER BY table_name"""


def q_protected_topk(spark, sf):
    """Top-k over a protected table (the limit is the feature)."""
    df = protect(_cust(spark, sf), CUSTOMER_CONTROLS, _reader(spark, sf, "dee"))
    return df.orderBy(F.col("c_acctbal").desc_nulls_last(), F.col("c_custkey")).limit(10)


SQL_PROTECTED_TOPK = with_ctes({"ents": ENTS_SQL}, f"""
SELECT * FROM (
  SELECT c_custkey, CASE WHEN {_sql_raw('dee')} THEN c_name ELSE '{ID_MASK_TEXT}' END AS c_name, c_nationkey,
         CASE WHEN {_sql_raw('dee')} THEN c_acctbal END AS c_acctbal, c_mktsegment
  FROM customer WHERE {_sql_visible('dee', 'customer.c_mktsegment')}) AS p
ORDER BY p.c_acctbal DESC NULLS LAST, p.c_custkey LIMIT 10""")


QUERIES = {
    "protect_filter_and_mask": q_protect_filter_and_mask,
    "mask_constant": q_mask_constant,
    "mask_null_numeric": q_mask_null_numeric,
    "mask_email_partial": q_mask_email_partial,
    "mask_group_gated": q_mask_group_gated,
    "row_filter_scope": q_row_filter_scope,
    "row_filter_all": q_row_filter_all,
    "row_filter_none": q_row_filter_none,
    "row_filter_group_admin": q_row_filter_group_admin,
    "row_filter_group": q_row_filter_group,
    "protect_multi_column_mask": q_protect_multi_column_mask,
    "control_detach": q_control_detach,
    "protected_group_count": q_protected_group_count,
    "protected_view": q_protected_view,
    "export_protected": q_export_protected,
    "entitlement_scopes": q_entitlement_scopes,
    "entitlement_toggle": q_entitlement_toggle,
    "entitlement_latest": q_entitlement_latest,
    "table_row_counts": q_table_row_counts,
    "protected_topk": q_protected_topk,
}

ORACLES = {
    "protect_filter_and_mask": SQL_PROTECT_FILTER_AND_MASK,
    "mask_constant": SQL_MASK_CONSTANT,
    "mask_null_numeric": SQL_MASK_NULL_NUMERIC,
    "mask_email_partial": SQL_MASK_EMAIL_PARTIAL,
    "mask_group_gated": SQL_MASK_GROUP_GATED,
    "row_filter_scope": SQL_ROW_FILTER_SCOPE,
    "row_filter_all": SQL_ROW_FILTER_ALL,
    "row_filter_none": SQL_ROW_FILTER_NONE,
    "row_filter_group_admin": SQL_ROW_FILTER_GROUP_ADMIN,
    "row_filter_group": SQL_ROW_FILTER_GROUP,
    "protect_multi_column_mask": SQL_PROTECT_MULTI_COLUMN_MASK,
    "control_detach": SQL_CONTROL_DETACH,
    "protected_group_count": SQL_PROTECTED_GROUP_COUNT,
    "protected_view": SQL_PROTECTED_VIEW,
    "export_protected": SQL_EXPORT_PROTECTED,
    "entitlement_scopes": SQL_ENTITLEMENT_SCOPES,
    "entitlement_toggle": SQL_ENTITLEMENT_TOGGLE,
    "entitlement_latest": SQL_ENTITLEMENT_LATEST,
    "table_row_counts": SQL_TABLE_ROW_COUNTS,
    "protected_topk": SQL_PROTECTED_TOPK,
}
