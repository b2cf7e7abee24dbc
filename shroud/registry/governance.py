"""Registered queries for tags and policies over the derived estate."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import hierarchy as H
from ..operators import policies as P
from ..operators import tags as TG
from ..plans.governance import Governance
from ..plans.protect import Reader
from ..sources import metadata as md
from ..sources.tables import literal, read_table
from . import estate as es
from .common import ENTS_SQL, entitlements, memberships, values_sql
from ..operators.classify import extract_all
from .protection import EMAIL_RE, email_addresses

GRP_SQL = """SELECT member AS reader, group_name FROM members
  UNION SELECT g.reader, m.group_name FROM grp g JOIN members m ON m.member = g.group_name"""

VALID_SQL = """SELECT * FROM policies p
  WHERE p.match_key IN (SELECT key FROM vocab)
    AND (p.match_value IS NULL OR EXISTS (SELECT 1 FROM vocab v WHERE v.key = p.match_key AND v.allowed_value = p.match_value))
    AND (p.when_key IS NULL OR (p.when_key IN (SELECT key FROM vocab)
         AND (p.when_value IS NULL OR EXISTS (SELECT 1 FROM vocab v WHERE v.key = p.when_key AND v.allowed_value = p.when_value))))"""

TARGETS_SQL = """SELECT policy, kind, function, table_id, min(column_name) AS column_name, list_sort(list(DISTINCT column_name)) AS columns FROM (
  SELECT p.name AS policy, p.scope_kind, p.scope_name, p.kind, p.function, t.table_id, t.column_name
  FROM valid p JOIN cur_tags t ON t.key = p.match_key AND (p.match_value IS NULL OR t.value = p.match_value)
  JOIN paths pa ON pa.table_id = t.table_id
  WHERE ((p.scope_kind = 'table' AND pa.table_id = p.scope_name) OR (p.scope_kind = 'schema' AND pa.schema_id = p.scope_name)
      OR (p.scope_kind = 'catalog' AND pa.catalog_id = p.scope_name) OR (p.scope_kind = 'metastore' AND pa.metastore_id = p.scope_name))
    AND (p.when_key IS NULL OR EXISTS (SELECT 1 FROM cur_ttags tt WHERE tt.table_id = t.table_id
         AND tt.key = p.when_key AND tt.value = p.when_value))) AS m
  GROUP BY policy, scope_kind, scope_name, kind, function, table_id, CASE WHEN kind = 'MASK' THEN lower(column_name) END"""

CTL_SQL = """SELECT table_id, column_name, kind, function, 'manual' AS origin FROM manual
  UNION ALL SELECT table_id, column_name, kind, function, policy AS origin FROM targets"""


def gov(spark, sf) -> Governance:
    return Governance(es.securables(spark, sf), es.column_tags(spark, sf), es.table_tags(spark, sf),
                      es.vocab(spark), es.policies(spark).where(F.col("name") != es.BROKEN_POLICY), es.manual_controls(spark, sf))


def _reader(spark, sf, who):
    return Reader(who, entitlements(spark, sf), memberships(spark, sf))


def q_tags_current(spark, sf):
    return TG.current_column_tags(es.column_tags(spark, sf))


SQL_TAGS_CURRENT = es.sql_with(body="SELECT * FROM cur_tags")


def q_tag_violations(spark, sf):
    return TG.tag_violations(TG.current_column_tags(es.column_tags(spark, sf)), es.vocab(spark))


SQL_TAG_VIOLATIONS = es.sql_with(body="""
SELECT table_id, column_name, key, value, 'ungoverned_key' AS problem FROM cur_tags WHERE key NOT IN (SELECT key FROM vocab)
UNION ALL
SELECT table_id, column_name, key, value, 'value_not_allowed' FROM cur_tags c
WHERE key IN (SELECT key FROM vocab) AND NOT EXISTS (SELECT 1 FROM vocab v WHERE v.key = c.key AND v.allowed_value = c.value)""")


def q_policy_unknown_key(spark, sf):
    """T4: conditions a policy may not use, with how many columns carry that key (what the
    broken policy was meant to cover)."""
    errs = TG.policy_condition_errors(es.policies(spark), es.vocab(spark))
    per_key = (TG.current_column_tags(es.column_tags(spark, sf)).groupBy("key")
               .agg(F.count(F.lit(1)).alias("n_columns")))
    return (errs.join(per_key, "key", "left")
            .select("name", "clause", "key", "value", "problem",
                    F.coalesce("n_columns", F.lit(0)).alias("n_columns")))


SQL_POLICY_UNKNOWN_KEY = es.sql_with({"conds": """
  SELECT name, 'match' AS clause, match_key AS key, match_value AS value FROM policies
  UNION ALL SELECT name, 'when', when_key, when_value FROM policies WHERE when_key IS NOT NULL""",
                                      "errs": """
  SELECT *, 'unknown_key' AS problem FROM conds WHERE key NOT IN (SELECT key FROM vocab)
  UNION ALL SELECT *, 'value_not_allowed' FROM conds c WHERE key IN (SELECT key FROM vocab) AND value IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM vocab v WHERE v.key = c.key AND v.allowed_value = c.value)"""}, """
SELECT e.name, e.clause, e.key, e.value, e.problem,
       (SELECT count(*) FROM cur_tags t WHERE t.key = e.key) AS n_columns FROM errs e""")


def _valid(spark):
    return P.valid_policies(es.policies(spark), es.vocab(spark))


def q_policy_match(spark, sf):
    pol = _valid(spark).where(F.col("match_value").isNotNull())
    return TG.match_columns(pol, TG.current_column_tags(es.column_tags(spark, sf)))


def q_policy_match_any_value(spark, sf):
    pol = _valid(spark).where(F.col("match_value").isNull())
    return TG.match_columns(pol, TG.current_column_tags(es.column_tags(spark, sf)))


def _sql_match(cond: str) -> str:
    return es.sql_with({"valid": VALID_SQL}, f"""
SELECT p.name AS policy, t.table_id, t.column_name, t.key AS tag_key, t.value AS tag_value
FROM valid p JOIN cur_tags t ON t.key = p.match_key AND (p.match_value IS NULL OR t.value = p.match_value)
WHERE {cond}""")


SQL_POLICY_MATCH = _sql_match("p.match_value IS NOT NULL")
SQL_POLICY_MATCH_ANY_VALUE = _sql_match("p.match_value IS NULL")


def _targets_where(spark, sf, cond):
    g = gov(spark, sf)
    return g.targets(g.valid_policies().where(cond)).withColumn("columns", F.array_join("columns", ","))


def q_policy_when_table_tag(spark, sf):
    return _targets_where(spark, sf, F.col("when_key").isNotNull())


def q_policy_catalog_scope(spark, sf):
    return _targets_where(spark, sf, F.col("scope_kind") == "catalog")


def _sql_targets(cond):
    return es.sql_with({"valid": f"SELECT * FROM ({VALID_SQL}) AS v0 WHERE {cond}", "targets": TARGETS_SQL},
                       "SELECT * REPLACE (array_to_string(columns, ',') AS columns) FROM targets")


SQL_POLICY_WHEN_TABLE_TAG = _sql_targets("when_key IS NOT NULL")
SQL_POLICY_CATALOG_SCOPE = _sql_targets("scope_kind = 'catalog'")


def q_effective_controls(spark, sf):
    return gov(spark, sf).controls(_reader(spark, sf, "eve"))


def _sql_applies(who: str) -> str:
    return f"""SELECT * FROM ({VALID_SQL}) AS v0 WHERE
    list_has_any(to_principals, (SELECT list(i) FROM (SELECT '{who}' AS i UNION SELECT '{md.EVERYONE}'
        UNION SELECT group_name FROM grp WHERE reader = '{who}')))
    AND NOT list_has_any(coalesce(except_principals, []), (SELECT list(i) FROM (SELECT '{who}' AS i
        UNION SELECT '{md.EVERYONE}' UNION SELECT group_name FROM grp WHERE reader = '{who}')))"""


SQL_EFFECTIVE_CONTROLS = es.sql_with({"grp(reader, group_name)": GRP_SQL, "valid": _sql_applies("eve"),
                                      "targets": TARGETS_SQL}, CTL_SQL, recursive=True)


def q_control_conflicts(spark, sf):
    return P.control_conflicts(gov(spark, sf).controls())


_CONFLICTS_BODY = """
SELECT table_id, CASE WHEN kind = 'MASK' THEN column_name END AS column_name, kind, count(*) AS n,
       array_to_string(list_sort(list(DISTINCT origin)), ',') AS origins
FROM ctl GROUP BY table_id, CASE WHEN kind = 'MASK' THEN column_name END, kind HAVING count(*) > 1"""

SQL_CONTROL_CONFLICTS = es.sql_with({"valid": VALID_SQL, "targets": TARGETS_SQL, "ctl": CTL_SQL}, _CONFLICTS_BODY)


def q_policy_drop(spark, sf):
    g = gov(spark, sf)
    g.policies = P.drop_policy(g.policies, "pii_null_europe3", "europe.nation_3")
    return P.control_conflicts(g.controls())


SQL_POLICY_DROP = es.sql_with({"valid": f"SELECT * FROM ({VALID_SQL}) AS v0 WHERE name <> 'pii_null_europe3'",
                               "targets": TARGETS_SQL, "ctl": CTL_SQL}, _CONFLICTS_BODY)


def q_coverage_gaps(spark, sf):
    g = gov(spark, sf)
    return P.coverage_gaps(TG.current_column_tags(g.column_tags), g.controls(), ["pii"])


SQL_COVERAGE_GAPS = es.sql_with({"valid": VALID_SQL, "targets": TARGETS_SQL, "ctl": CTL_SQL}, """
SELECT * FROM cur_tags c WHERE c.key = 'pii'
  AND NOT EXISTS (SELECT 1 FROM ctl WHERE ctl.kind = 'MASK' AND ctl.table_id = c.table_id AND lower(ctl.column_name) = lower(c.column_name))""")


def q_policy_list(spark, sf):
    """P10 on every scope that has a policy, with what each policy covers."""
    g = gov(spark, sf)
    covered = g.targets().groupBy(F.col("policy").alias("name")).agg(
        F.sum(F.size("columns")).alias("n_columns"), F.count_distinct("table_id").alias("n_tables"))
    scopes = sorted({(r.scope_name, r.scope_kind) for r in g.policies.select("scope_name", "scope_kind").collect()})
    listed = [P.list_policies(g.policies, n, k).withColumn("scope_name", F.lit(n)) for n, k in scopes]
    out = reduce(DataFrame.unionByName, listed).join(covered, "name", "left")
    return out.select("name", "scope_kind", "scope_name", "kind", "function", "match_key", "match_value",
                      F.coalesce("n_tables", F.lit(0)).alias("n_tables"), F.coalesce("n_columns", F.lit(0)).alias("n_columns"))


SQL_POLICY_LIST = es.sql_with({"valid": VALID_SQL, "targets": TARGETS_SQL}, """
SELECT v.name, v.scope_kind, v.scope_name, v.kind, v.function, v.match_key, v.match_value,
       (SELECT count(DISTINCT table_id) FROM targets t WHERE t.policy = v.name) AS n_tables,
       (SELECT coalesce(CAST(sum(len(columns)) AS BIGINT), 0) FROM targets t WHERE t.policy = v.name) AS n_columns
FROM valid v""")


SAME_NAME = [("twice", "schema", "main.tpch", md.MASK, "redact", ["analysts", "Customer#000000008"], ["Customer#000000007"], None, None, "pii", None),
             ("twice", "catalog", "europe", md.MASK, "redact", ["Customer#000000007", md.EVERYONE], ["Customer#000000008"], None, None, "pii", None)]


def q_policy_same_name(spark, sf):
    """One name in two scopes; who is exempt in one is covered in the other."""
    ids = H.identities(memberships(spark, sf), es.principals(spark, sf))
    return P.applicability(literal(spark, SAME_NAME, md.POLICIES), ids)


def q_policy_filter_two_columns(spark, sf):
    """P2 + F4: a row-filter policy whose tag stands on two columns gets both as arguments."""
    g = gov(spark, sf)
    rows = [("by_segment_or_name", "schema", "main.tpch", md.FILTER, "any_scope_filter", [md.EVERYONE], [], None, None, "rls", "segment")]
    g.policies = literal(spark, rows, md.POLICIES)
    g = g.with_tags(literal(spark, [(20, "main.tpch.customer", "c_name", "rls", "segment")], md.COLUMN_TAGS))
    customer = read_table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return g.protect_table("main.tpch.customer", customer, _reader(spark, sf, "ana"))


def q_policy_applies_to(spark, sf):
    ids = H.identities(memberships(spark, sf), es.principals(spark, sf))
    return P.applicability(_valid(spark), ids)


SQL_POLICY_APPLIES_TO = es.sql_with({"grp(reader, group_name)": GRP_SQL, "valid": VALID_SQL, "ids": """
  SELECT principal, principal AS identity FROM principals
  UNION SELECT p.principal, g.group_name FROM principals p JOIN grp g ON g.reader = p.principal
  UNION SELECT principal, 'all_users' FROM principals"""}, """
SELECT DISTINCT v.name AS policy, v.scope_kind, v.scope_name, i.principal FROM valid v JOIN ids i ON list_contains(v.to_principals, i.identity)
WHERE NOT EXISTS (SELECT 1 FROM ids j WHERE j.principal = i.principal AND list_contains(v.except_principals, j.identity))""",
                                    recursive=True)


SQL_POLICY_SAME_NAME = es.sql_with({"grp(reader, group_name)": GRP_SQL, "valid": values_sql(SAME_NAME, es.POLICY_COLS, es.POLICY_TYPES), "ids": """
  SELECT principal, principal AS identity FROM principals
  UNION SELECT p.principal, g.group_name FROM principals p JOIN grp g ON g.reader = p.principal
  UNION SELECT principal, 'all_users' FROM principals"""}, """
SELECT DISTINCT v.name AS policy, v.scope_kind, v.scope_name, i.principal FROM valid v JOIN ids i ON list_contains(v.to_principals, i.identity)
WHERE NOT EXISTS (SELECT 1 FROM ids j WHERE j.principal = i.principal AND list_contains(v.except_principals, j.identity))""",
                                    recursive=True)


def q_policy_mask_apply(spark, sf):
    """The e-mail column of a table is masked because it is tagged, by a policy."""
    return gov(spark, sf).protect_table("main.tpch.doc_emails", email_addresses(spark, sf), _reader(spark, sf, "eve"))


_EMAIL_MASK = ("CASE WHEN email IS NULL THEN NULL WHEN instr(email, '@') = 0 THEN '****' "
               "ELSE substring(email, 1, 1) || '****@' || substring(email, instr(email, '@') + 1) END")

SQL_POLICY_MASK_APPLY = f"""
SELECT doc_id, pos, {_EMAIL_MASK} AS email FROM (
  SELECT doc_id, unnest(generate_series(1, len(m))) AS pos, unnest(m) AS email
  FROM (SELECT doc_id, regexp_extract_all(text, '{EMAIL_RE}') AS m FROM documents))"""


def _policy_customer(spark, sf, who):
    return gov(spark, sf).protect_table("main.tpch.customer", read_table(spark, sf, "customer"), _reader(spark, sf, who))


def q_policy_filter_apply(spark, sf):
    """The segment column is tagged rls=segment; the policy filters by the reader's
    scopes (USING COLUMNS = the matched column). c_name is tagged pii=ssn and redacted."""
    return _policy_customer(spark, sf, "ana")


_ENTS = f"({ENTS_SQL})"

SQL_POLICY_FILTER_APPLY = f"""
WITH ents AS {_ENTS}
SELECT c_custkey, '[REDACTED]' AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer c
WHERE EXISTS (SELECT 1 FROM ents e WHERE e.principal = 'ana' AND (e.scope = c.c_mktsegment OR e.scope = 'ALL'))"""


SQL_POLICY_FILTER_TWO_COLUMNS = f"""
WITH ents AS {_ENTS}
SELECT c_custkey, c_name, c_mktsegment FROM customer c
WHERE EXISTS (SELECT 1 FROM ents e WHERE e.principal = 'ana' AND e.scope IN (c.c_mktsegment, c.c_name, 'ALL'))"""


def q_policy_except_principal(spark, sf):
    """P4 + M5: an admin (EXCEPT gov_admins) sees raw names and every row; another
    customer sees redacted names and only its own segment."""
    parts = [_policy_customer(spark, sf, w).select(F.lit(w).alias("reader"), "c_custkey", "c_name", "c_mktsegment")
             for w in ("Customer#000000007", "Customer#000000008")]
    return parts[0].unionByName(parts[1])


SQL_POLICY_EXCEPT_PRINCIPAL = f"""
WITH ents AS {_ENTS}
SELECT 'Customer#000000007' AS reader, c_custkey, c_name, c_mktsegment FROM customer
UNION ALL
SELECT 'Customer#000000008', c_custkey, '[REDACTED]', c_mktsegment FROM customer c
WHERE EXISTS (SELECT 1 FROM ents e WHERE e.principal = 'Customer#000000008' AND (e.scope = c.c_mktsegment OR e.scope = 'ALL'))"""


def q_policy_read_materialized(spark, sf):
    """P2 through governance relations written once sorted by table id (pruned lookups)."""
    import uuid

    from ..session import shared_dir
    m = gov(spark, sf).materialize(shared_dir(spark, f"governance_{uuid.uuid4().hex}"))
    return m.protect_table("main.tpch.customer", read_table(spark, sf, "customer"), _reader(spark, sf, "ana"))


def q_catalog_statements_read(spark, sf):
    """The statement facade on a driver table: two masks and a row filter set, a third
    mask set and dropped again, then one reader's read."""
    from ..plans.catalog import ProtectionCatalog
    cat = ProtectionCatalog(spark)
    t = "main.tpch.customer"
    cat.create_table(t, read_table(spark, sf, "customer"), owner="owner_tpch")
    cat.set_mask(t, "c_name", "id_mask")
    cat.set_mask(t, "c_acctbal", "null_mask")
    cat.set_mask(t, "c_nationkey", "null_mask")
    cat.set_row_filter(t, "scope_filter", ["c_mktsegment"])
    cat.drop_mask(t, "c_nationkey")
    return cat.read(t, _reader(spark, sf, "dee"))


SQL_POLICY_READ_MATERIALIZED = SQL_POLICY_FILTER_APPLY

SQL_CATALOG_STATEMENTS_READ = f"""
WITH ents AS {_ENTS}
SELECT c_custkey,
       CASE WHEN (SELECT coalesce(bool_or(can_view_raw), false) FROM ents WHERE principal = 'dee') THEN c_name
            ELSE 'XXX-XX-XXXX' END AS c_name,
       c_nationkey,
       CASE WHEN (SELECT coalesce(bool_or(can_view_raw), false) FROM ents WHERE principal = 'dee') THEN c_acctbal END
         AS c_acctbal,
       c_mktsegment
FROM customer c
WHERE EXISTS (SELECT 1 FROM ents e WHERE e.principal = 'dee' AND (e.scope = c.c_mktsegment OR e.scope = 'ALL'))"""


def page_contacts(spark, sf) -> DataFrame:
    pages = read_table(spark, sf, "pages")
    return pages.select("page_id", F.posexplode(extract_all(F.col("html"), EMAIL_RE, "@"))
                        .alias("pos", "email")).select("page_id", (F.col("pos") + 1).cast("bigint").alias("pos"), "email")


def q_policy_new_table(spark, sf):
    """A table made after the policy, then tagged: covered with no policy change."""
    g = gov(spark, sf)
    new_id = "main.tpch.page_contacts"
    g.securables = g.securables.unionByName(literal(spark, [(new_id, "main.tpch", "table", "page_contacts", "owner_tpch")],
                                                    md.SECURABLES))
    reader = _reader(spark, sf, "eve")
    before = g.protect_table(new_id, page_contacts(spark, sf), reader)
    tagged = g.with_tags(literal(spark, [(10, new_id, "email", "pii", "email")], md.COLUMN_TAGS))
    after = tagged.protect_table(new_id, page_contacts(spark, sf), reader)
    return (before.select(F.lit("before").alias("phase"), "*")
            .unionByName(after.select(F.lit("after").alias("phase"), "*")))


SQL_POLICY_NEW_TABLE = f"""
WITH pc AS (SELECT page_id, unnest(generate_series(1, len(m))) AS pos, unnest(m) AS email
            FROM (SELECT page_id, regexp_extract_all(html, '{EMAIL_RE}') AS m FROM pages))
SELECT 'before' AS phase, page_id, pos, email FROM pc
UNION ALL SELECT 'after', page_id, pos, {_EMAIL_MASK} FROM pc"""


QUERIES = {
    "tags_current": q_tags_current,
    "tag_violations": q_tag_violations,
    "policy_unknown_key": q_policy_unknown_key,
    "policy_match": q_policy_match,
    "policy_match_any_value": q_policy_match_any_value,
    "policy_when_table_tag": q_policy_when_table_tag,
    "policy_catalog_scope": q_policy_catalog_scope,
    "effective_controls": q_effective_controls,
    "control_conflicts": q_control_conflicts,
    "policy_drop": q_policy_drop,
    "coverage_gaps": q_coverage_gaps,
    "policy_list": q_policy_list,
    "policy_applies_to": q_policy_applies_to,
    "policy_same_name": q_policy_same_name,
    "policy_filter_two_columns": q_policy_filter_two_columns,
    "policy_mask_apply": q_policy_mask_apply,
    "policy_filter_apply": q_policy_filter_apply,
    "policy_except_principal": q_policy_except_principal,
    "policy_new_table": q_policy_new_table,
    "policy_read_materialized": q_policy_read_materialized,
    "catalog_statements_read": q_catalog_statements_read,
}

ORACLES = {
    "tags_current": SQL_TAGS_CURRENT,
    "tag_violations": SQL_TAG_VIOLATIONS,
    "policy_unknown_key": SQL_POLICY_UNKNOWN_KEY,
    "policy_match": SQL_POLICY_MATCH,
    "policy_match_any_value": SQL_POLICY_MATCH_ANY_VALUE,
    "policy_when_table_tag": SQL_POLICY_WHEN_TABLE_TAG,
    "policy_catalog_scope": SQL_POLICY_CATALOG_SCOPE,
    "effective_controls": SQL_EFFECTIVE_CONTROLS,
    "control_conflicts": SQL_CONTROL_CONFLICTS,
    "policy_drop": SQL_POLICY_DROP,
    "coverage_gaps": SQL_COVERAGE_GAPS,
    "policy_list": SQL_POLICY_LIST,
    "policy_applies_to": SQL_POLICY_APPLIES_TO,
    "policy_same_name": SQL_POLICY_SAME_NAME,
    "policy_filter_two_columns": SQL_POLICY_FILTER_TWO_COLUMNS,
    "policy_mask_apply": SQL_POLICY_MASK_APPLY,
    "policy_filter_apply": SQL_POLICY_FILTER_APPLY,
    "policy_except_principal": SQL_POLICY_EXCEPT_PRINCIPAL,
    "policy_new_table": SQL_POLICY_NEW_TABLE,
    "policy_read_materialized": SQL_POLICY_READ_MATERIALIZED,
    "catalog_statements_read": SQL_CATALOG_STATEMENTS_READ,
}
