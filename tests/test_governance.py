"""Tags and policies on the metadata fixtures (FIXTURES.md section 3)."""

import pytest

from shroud.functions.masks import REDACTED_TEXT
from shroud.operators import policies as P
from shroud.operators import tags as TG
from shroud.plans.governance import Governance
from shroud.plans.protect import ControlConflict, Reader
from shroud.sources import metadata as md

E = md.EVERYONE
SECURABLES = [
    ("metastore", None, "metastore", "metastore", "admin"),
    ("hr", "metastore", "catalog", "hr", "admin"),
    ("ops", "metastore", "catalog", "ops", "admin"),
    ("hr.core", "hr", "schema", "core", "o_core"),
    ("hr.pay", "hr", "schema", "pay", "o_pay"),
    ("ops.main", "ops", "schema", "main", "o_ops"),
    ("hr.core.people", "hr.core", "table", "people", "o_core"),
    ("hr.core.depts", "hr.core", "table", "depts", "o_core"),
    ("hr.pay.comp", "hr.pay", "table", "comp", "o_pay"),
    ("ops.main.logs", "ops.main", "table", "logs", "o_logs"),
]
VOCAB = [("pii", "ssn"), ("pii", "email"), ("rls", "region"), ("sensitivity", "high")]
COLUMN_TAGS = [
    (1, "hr.core.people", "taxno", "pii", "ssn"),
    (2, "hr.core.people", "mail", "pii", "ssn"),
    (3, "hr.core.people", "mail", "pii", "email"),      # same key set twice: the later wins
    (4, "hr.core.people", "pay", "PII", "ssn"),         # key in other case: ungoverned
    (5, "hr.core.people", "born", "pii", "phone"),      # value not allowed
    (6, "hr.core.depts", "area", "rls", "region"),
    (7, "hr.pay.comp", "pay", "pii", "ssn"),
    (8, "ops.main.logs", "area", "rls", "region"),
]
TABLE_TAGS = [(1, "hr.core.depts", "sensitivity", "high")]
POLICIES = [
    ("email_hr", "catalog", "hr", md.MASK, "email_partial", [E], [], None, None, "pii", "email"),
    ("ssn_core", "schema", "hr.core", md.MASK, "redact", [E], ["pay_admins"], None, None, "pii", "ssn"),
    ("any_pii_pay", "schema", "hr.pay", md.MASK, "null_mask", [E], [], None, None, "pii", None),
    ("rows_by_region", "metastore", "metastore", md.FILTER, "scope_filter", ["analysts"], [],
     "sensitivity", "high", "rls", "region"),
    ("broken", "schema", "hr.core", md.MASK, "redact", [E], [], None, None, "PII", "ssn"),
]
MEMBERS = [("ann", "analysts"), ("hal", "pay_admins"), ("hal", "analysts")]
ENTS = [("ann", "NORTH", False), ("hal", "ALL", True)]


@pytest.fixture()
def gov(spark):
    return Governance(
        spark.createDataFrame(SECURABLES, md.SECURABLES),
        spark.createDataFrame(COLUMN_TAGS, md.COLUMN_TAGS),
        spark.createDataFrame(TABLE_TAGS, md.TABLE_TAGS),
        spark.createDataFrame(VOCAB, md.TAG_VOCAB),
        spark.createDataFrame([p for p in POLICIES if p[0] != "broken"], md.POLICIES),
        spark.createDataFrame([], md.MANUAL_CONTROLS),
    )


def reader(spark, who):
    return Reader(who, spark.createDataFrame(ENTS, md.ENTITLEMENTS), spark.createDataFrame(MEMBERS, md.MEMBERSHIPS))


def test_current_tags_last_wins(gov):
    cur = {(r.table_id, r.column_name, r.key): r.value for r in TG.current_column_tags(gov.column_tags).collect()}
    assert cur[("hr.core.people", "mail", "pii")] == "email"


def test_violations(gov):
    v = {(r.column_name, r.problem) for r in TG.tag_violations(TG.current_column_tags(gov.column_tags), gov.vocab).collect()}
    assert v == {("pay", "ungoverned_key"), ("born", "value_not_allowed")}


def test_unknown_key_raises(spark, gov, people):
    every = spark.createDataFrame(POLICIES, md.POLICIES)
    with pytest.raises(TG.PolicyConditionError, match="PII"):
        TG.validate_policies(every, gov.vocab)
    assert {r.name for r in P.valid_policies(every, gov.vocab).collect()} == {p[0] for p in POLICIES} - {"broken"}
    gov.policies = every   # a read under an ungoverned policy fails instead of showing the column
    with pytest.raises(TG.PolicyConditionError, match="PII"):
        gov.protect_table("hr.core.people", people, reader(spark, "ann"))


def test_one_name_in_two_scopes(spark, gov, people):
    twice = [("same", "schema", "hr.core", md.MASK, "email_partial", [E], [], None, None, "pii", "email"),
             ("same", "schema", "hr.pay", md.MASK, "redact", [E], [], None, None, "pii", "email")]
    gov.policies = spark.createDataFrame(twice, md.POLICIES)
    got = gov.protect_table("hr.core.people", people, reader(spark, "ann")).orderBy("id").first()
    assert got.mail == "k****@corp.test"
    # a bad namesake in another scope takes nothing away
    bad = spark.createDataFrame([("same", "schema", "ops.main", md.MASK, "redact", [E], [], None, None, "PII", "x")], md.POLICIES)
    assert P.valid_policies(gov.policies.unionByName(bad), gov.vocab).count() == 2


def test_null_among_the_names_keeps_the_policy(spark, gov):
    rows = [("a", "schema", "hr.core", md.MASK, "redact", [E, None], [None, "x"], None, None, "pii", "ssn")]
    pol = spark.createDataFrame(rows, md.POLICIES)
    assert P.applies_to(pol, "ann", []).count() == 1 and P.applies_to(pol, "x", []).count() == 0


def test_filter_keeps_all_its_arguments(spark, gov, people):
    def both(r, df, cols):
        return df.filter((df[cols[0]] == "SOUTH") & (df[cols[1]] > 100))
    gov.functions.filter("two_columns", both)
    gov.manual = spark.createDataFrame([("ops.main.logs", md.FILTER, "two_columns", ["area", "pay"])], md.MANUAL_CONTROLS)
    got = gov.protect_table("ops.main.logs", people, reader(spark, "zoe"))
    assert [r.id for r in got.collect()] == [3]


def test_except_beats_to(spark, gov, people):
    ann = gov.protect_table("hr.core.people", people, reader(spark, "ann")).orderBy("id").collect()
    hal = gov.protect_table("hr.core.people", people, reader(spark, "hal")).orderBy("id").collect()
    assert {r.taxno for r in ann} == {REDACTED_TEXT}
    assert ann[0].mail == "k****@corp.test"
    assert hal[0].taxno == "101-11-1001" and hal[0].mail == "k****@corp.test"


def test_any_value_match(spark, gov, people):
    # has_tag('pii') matches pay; null_mask is gated by the raw entitlement
    ann = gov.protect_table("hr.pay.comp", people, reader(spark, "ann")).collect()
    assert {r.pay for r in ann} == {None}
    hal = gov.protect_table("hr.pay.comp", people, reader(spark, "hal")).collect()
    assert {r.pay for r in hal} == {r.pay for r in people.collect()}


def test_when_clause_and_to(spark, gov, people):
    # depts carries sensitivity=high: ann (analyst, scope NORTH) sees NORTH rows only
    depts = people.select("id", "area")
    ann = gov.protect_table("hr.core.depts", depts, reader(spark, "ann"))
    assert sorted(r.id for r in ann.collect()) == [1, 2]
    # logs is not tagged high: the same policy does not apply
    logs = gov.protect_table("ops.main.logs", depts, reader(spark, "ann"))
    assert logs.count() == 6
    # a principal outside TO is not filtered
    nobody = gov.protect_table("hr.core.depts", depts, Reader("zoe", spark.createDataFrame([], md.ENTITLEMENTS)))
    assert nobody.count() == 6


def test_late_table_covered(spark, gov):
    visits = spark.createDataFrame([("v-7", "é@x.test", 3), ("v-8", None, 5), ("v-9", "none", 1)], "visit string, reply_to string, n int")
    node = spark.createDataFrame([("hr.pay.visits", "hr.pay", "table", "visits", "o_pay")], md.SECURABLES)
    g = Governance(gov.securables.unionByName(node), gov.column_tags, gov.table_tags, gov.vocab, gov.policies, gov.manual)

    def shown(governance):
        return {r.visit: r.reply_to for r in governance.protect_table("hr.pay.visits", visits, reader(spark, "ann")).collect()}
    assert shown(g) == {"v-7": "é@x.test", "v-8": None, "v-9": "none"}
    g.policies = g.policies.where("name <> 'any_pii_pay'")
    tag = spark.createDataFrame([(20, "hr.pay.visits", "reply_to", "pii", "email")], md.COLUMN_TAGS)
    assert shown(g.with_tags(tag)) == {"v-7": "é****@x.test", "v-8": None, "v-9": "****"}


def test_conflicts_reported_and_raised(spark, gov, people):
    manual = spark.createDataFrame([("hr.core.people", md.MASK, "id_mask", ["mail"])], md.MANUAL_CONTROLS)
    g = Governance(gov.securables, gov.column_tags, gov.table_tags, gov.vocab, gov.policies, manual)
    conf = P.control_conflicts(g.controls()).collect()
    assert [(r.table_id, r.column_name, r.origins) for r in conf] == [("hr.core.people", "mail", "email_hr,manual")]
    with pytest.raises(ControlConflict):
        g.protect_table("hr.core.people", people, reader(spark, "ann"))


def test_drop_and_list(gov):
    assert [r.name for r in P.list_policies(gov.policies, "hr.core").collect()] == ["ssn_core"]
    left = P.drop_policy(gov.policies, "ssn_core", "hr.core")
    assert left.count() == len(POLICIES) - 2
    with pytest.raises(P.PolicyNotFound):
        P.drop_policy(left, "ssn_core", "hr.core")


def test_coverage_gaps(spark, gov):
    gaps = P.coverage_gaps(TG.current_column_tags(gov.column_tags), gov.controls(), ["pii"]).collect()
    # born carries pii=phone: no policy matches that value outside hr.pay
    assert {(r.table_id, r.column_name) for r in gaps} == {("hr.core.people", "born")}


def test_applicability_nested_and_except(spark, gov):
    from shroud.operators import hierarchy as H
    members = spark.createDataFrame(MEMBERS + [("analysts", "staff"), ("staff", "analysts")], md.MEMBERSHIPS)
    ids = H.identities(members, spark.createDataFrame([("ann",), ("hal",), ("zoe",)], "p string"))
    got = {(r.policy, r.principal) for r in P.applicability(gov.valid_policies(), ids).collect()}
    assert ("ssn_core", "hal") not in got and ("ssn_core", "ann") in got and ("ssn_core", "zoe") in got
    assert ("rows_by_region", "ann") in got and ("rows_by_region", "zoe") not in got


def test_materialized_lookup_prunes(spark, gov, people, scratch):
    m = gov.materialize(f"{scratch}/gov", partitions=3)
    a = gov.protect_table("hr.core.people", people, reader(spark, "ann")).orderBy("id").collect()
    b = m.protect_table("hr.core.people", people, reader(spark, "ann")).orderBy("id").collect()
    assert a == b
    plan = m.controls(reader(spark, "ann"), "hr.core.people")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(table_id,hr.core.people)" in plan
    # a later tag event still counts after materializing (latest seq wins)
    later = m.with_tags(spark.createDataFrame([(99, "hr.core.people", "mail", "pii", "ssn")], md.COLUMN_TAGS))
    got = later.protect_table("hr.core.people", people, reader(spark, "ann")).orderBy("id").first()
    assert got.mail == REDACTED_TEXT


def test_applicability_keeps_policies_of_one_name_apart(spark):
    rows = [("p", "schema", "a.x", "MASK", "redact", ["u1"], ["u2"], None, None, "k", None),
            ("p", "schema", "a.y", "MASK", "redact", ["u2"], ["u1"], None, None, "k", None)]
    ids = spark.createDataFrame([("u1", "u1"), ("u2", "u2")], "principal string, identity string")
    got = {(r.scope_name, r.principal) for r in P.applicability(spark.createDataFrame(rows, md.POLICIES), ids).collect()}
    assert got == {("a.x", "u1"), ("a.y", "u2")}


def test_drop_needs_the_kind_where_a_name_is_ambiguous(spark):
    rows = [("p", "schema", "shop", "MASK", "redact", ["u1"], [], None, None, "k", None),
            ("p", "catalog", "shop", "MASK", "redact", ["u1"], [], None, None, "k", None)]
    both = spark.createDataFrame(rows, md.POLICIES)
    with pytest.raises(P.AmbiguousPolicy):
        P.drop_policy(both, "p", "shop")
    assert [r.scope_kind for r in P.drop_policy(both, "p", "shop", "schema").collect()] == ["catalog"]
    assert P.list_policies(both, "shop").count() == 2 and P.list_policies(both, "shop", "catalog").count() == 1


def test_filter_policy_takes_all_matched_columns(spark):
    tags = spark.createDataFrame([("c.s.t", "b", "rls", "x"), ("c.s.t", "A", "rls", "x"), ("c.s.u", "z", "rls", "x")],
                                 "table_id string, column_name string, key string, value string")
    paths = spark.createDataFrame([(f"c.s.{t}", "c.s", "c", "m") for t in "tu"], "table_id string, schema_id string, catalog_id string, metastore_id string")
    none = spark.createDataFrame([], "table_id string, key string, value string")
    pol = spark.createDataFrame([("f", "schema", "c.s", "FILTER", "any_scope_filter", ["all_users"], [], None, None, "rls", "x")], md.POLICIES)
    got = {(r.table_id, r.column_name, tuple(r.columns)) for r in P.policy_targets(pol, tags, none, paths).collect()}
    assert got == {("c.s.t", "A", ("A", "b")), ("c.s.u", "z", ("z",))}


def test_tags_of_one_catalog_are_dealt_by_table(spark):
    """A catalog-wide policy: no join may gather all tags of a catalog and key under one join key."""
    tags = spark.createDataFrame([(f"c.s.t{i}", f"p{j}", "pii", "x") for i in range(6) for j in range(3)] + [("c.s.t0", "p0", None, "x"), (None, "p1", "pii", "x")],
                                 "table_id string, column_name string, key string, value string")
    paths = spark.createDataFrame([(f"c.s.t{i}", "c.s", "c", "m") for i in range(6)] + [("c.s.t0", "c.s", "c", "m"), ("d.t", None, None, None)],
                                  "table_id string, schema_id string, catalog_id string, metastore_id string")
    ttags = spark.createDataFrame([("c.s.t1", "level", "high"), ("c.s.t2", "level", "low"), ("c.s.t3", "level", None)], "table_id string, key string, value string")
    pol = spark.createDataFrame([("all", "catalog", "c", "MASK", "redact", [E], [], None, None, "pii", None),
                                 ("high", "catalog", "c", "FILTER", "scope_filter", [E], [], "level", "high", "pii", "x"),
                                 ("unset", "catalog", "c", "FILTER", "scope_filter", [E], [], "level", None, "pii", "x")], md.POLICIES)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = P.policy_targets(pol, tags, ttags, paths)
        plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
        joins = [line for line in plan.splitlines() if "Join [" in line and "match_key" in line]
        assert joins and all("table_id" in line for line in joins), joins
        rows = sorted((r.policy, r.table_id, tuple(r.columns)) for r in got.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows == [("all", f"c.s.t{i}", (f"p{j}",)) for i in range(6) for j in range(3)] + [("high", "c.s.t1", ("p0", "p1", "p2"))]


def test_coverage_gap_compares_names_in_any_case(spark):
    tags = spark.createDataFrame([("t", "mail", "pii", "email"), ("t", "other", "pii", "email")], "table_id string, column_name string, key string, value string")
    controls = spark.createDataFrame([("t", "MAIL", "MASK")], "table_id string, column_name string, kind string")
    assert [r.column_name for r in P.coverage_gaps(tags, controls, ["pii"]).collect()] == ["other"]
