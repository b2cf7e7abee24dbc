"""The paths taken beyond a size bound give the same answers as the bounded paths."""

import pytest
from pyspark.sql import functions as F

from shroud.operators.joins import localize
from shroud.plans.protect import Control, Reader, UnknownControl, protect, protected_view
from shroud.sources import metadata as md

FILTER = [Control(md.FILTER, "scope_filter", ("area",))]


@pytest.mark.parametrize("snapshot", [True, False])
@pytest.mark.parametrize("who,ids", [("p_two", [1, 2, 3, 4]), ("p_all", [1, 2, 3, 4, 5, 6]), ("p_none", [])])
def test_scope_filter_beyond_literal_bound(people, ents, who, ids, snapshot):
    """max_scope_literal=0 forces the bucketed form."""
    small = protect(people, FILTER, Reader(who, ents, snapshot=snapshot, max_scope_literal=0))
    assert sorted(r.id for r in small.collect()) == ids
    assert "Join" not in small._jdf.queryExecution().optimizedPlan().toString().split("Subquery")[0].split("scalar-subquery")[0]


@pytest.mark.parametrize("snapshot", [True, False])
def test_hidden_rows_reach_no_user_code_with_30k_scopes(spark, snapshot):
    from pyspark.sql import types as T
    many = spark.range(30_000).select(F.lit("big").alias("principal"), F.concat(F.lit("s"), F.col("id")).alias("scope"),
                                      F.when(F.col("id") % 3 == 0, True).when(F.col("id") % 3 == 1, False).alias("can_view_raw"))
    many = spark.createDataFrame(many.collect(), T.StructType(md.ENTITLEMENTS.fields))
    rows = spark.createDataFrame([("s29999", 1), ("hidden", 0), (None, 0)], "area string, d int")
    seen = protect(rows, FILTER, Reader("big", many, snapshot=snapshot)).filter(F.lit(10) / F.col("d") > 1)
    assert [r.area for r in seen.collect()] == ["s29999"]


def test_revoked_all_closes_a_held_view(spark, people, scratch):
    path = f"{scratch}/ents"
    spark.createDataFrame([("w", "ALL", False)], md.ENTITLEMENTS).write.parquet(path)
    reader = Reader("w", spark.read.schema(md.ENTITLEMENTS).parquet(path), snapshot=False, max_scope_literal=0)
    protected_view("held", people, FILTER, reader)
    assert spark.table("held").count() == 6
    spark.createDataFrame([("w", "NORTH", False)], md.ENTITLEMENTS).write.mode("overwrite").parquet(path)
    protected_view("held", people, FILTER, Reader("w", spark.read.schema(md.ENTITLEMENTS).parquet(path), snapshot=False))
    assert sorted(r.id for r in spark.table("held").collect()) == [1, 2]


def test_reader_sees_changes_from_the_next_read_on(spark, people, ents):
    reader = Reader("late", ents)
    assert protect(people, FILTER, reader).count() == 0
    reader.entitlements = ents.unionByName(spark.createDataFrame([("late", "SOUTH", False)], md.ENTITLEMENTS))
    assert protect(people, FILTER, reader).count() == 2


def test_unknown_control_kind_raises(people, ents):
    with pytest.raises(UnknownControl):
        protect(people, [Control("mask", "id_mask", ("taxno",))], Reader("p_two", ents))


def test_raw_flag_beyond_bound(people, ents):
    ctl = [Control(md.MASK, "id_mask", ("taxno",))]
    a = protect(people, ctl, Reader("p_two", ents, max_scope_literal=0)).orderBy("id").collect()
    b = protect(people, ctl, Reader("p_two", ents)).orderBy("id").collect()
    assert a == b and a[0].taxno == "101-11-1001"


def test_localize_bound(spark):
    df = spark.range(50).withColumn("x", F.col("id") * 2)
    assert localize(df, max_rows=10) is df
    local = localize(df, max_rows=100)
    assert local is not df and sorted(r.id for r in local.collect()) == list(range(50))


def test_localized_relation_has_a_known_size(spark):
    """A relation of unknown size counts as too large to broadcast."""
    rows = [("a", "schema", "s", md.MASK, "redact", ["x", None], None, None, None, "pii", None)]
    df = spark.createDataFrame(rows, md.POLICIES)
    local = localize(df)
    assert local.schema == df.schema and local.collect() == df.collect()
    assert local._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 10_000
    assert localize(df.where("name = 'b'")).count() == 0


def test_long_chains_are_followed_to_the_end(spark):
    from shroud.operators.audit import propagate_tags
    from shroud.operators.entitlements import principal_groups
    from shroud.operators.hierarchy import group_closure
    n = 130
    chain = [("u", "g0")] + [(f"g{i}", f"g{i + 1}") for i in range(n)] + [(f"g{n}", "g0")]   # and a cycle
    members = spark.createDataFrame(chain, md.MEMBERSHIPS)
    assert len(principal_groups(members, "u")) == n + 2
    assert group_closure(members).where("member = 'u'").count() == n + 1
    hops = spark.createDataFrame([(f"t{i}", "c", f"t{i + 1}", "c") for i in range(12)], "src_table string, src_column string, dst_table string, dst_column string")
    assert propagate_tags(hops, spark.createDataFrame([("t0", "c", "k", "v")], "table_id string, column_name string, key string, value string")).count() == 13


def test_grant_log_with_an_unknown_action_raises(spark):
    from shroud.operators.privileges import current_grants
    for action in ("revoke", None):
        log = spark.createDataFrame([(1, "GRANT", "SELECT", "t", "p"), (2, action, "SELECT", "t", "p")], md.GRANTS_LOG)
        with pytest.raises(Exception, match="unknown action"):
            current_grants(log).collect()


def test_members_of_an_owning_group_read(spark):
    from shroud.operators import hierarchy as H
    from shroud.operators import privileges as PR
    sec = spark.createDataFrame([("metastore", None, "metastore", "metastore", "admin"), ("c", "metastore", "catalog", "c", "admin"),
                                 ("c.s", "c", "schema", "s", "admin"), ("c.s.t", "c.s", "table", "t", "team")], md.SECURABLES)
    grants = PR.current_grants(spark.createDataFrame([], md.GRANTS_LOG))
    ids = H.identities(spark.createDataFrame([("joe", "team")], md.MEMBERSHIPS))
    assert {r.principal for r in PR.effective_read(grants, sec, ids).collect()} == {"admin", "team", "joe"}


def test_cluster_conf_sizes():
    from shroud.session import cluster_conf
    c = cluster_conf(100 * (1 << 40), 8000)           # 100 TB on 8000 cores
    assert int(c["spark.sql.shuffle.partitions"]) == 100 * (1 << 40) // (256 << 20)
    assert cluster_conf(1 << 30, 64)["spark.sql.shuffle.partitions"] == "128"


def test_apply_cluster_conf_keeps_submitted(spark):
    from shroud.session import apply_cluster_conf
    before = spark.conf.get("spark.sql.shuffle.partitions")
    apply_cluster_conf(spark, 1 << 30, 4)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before   # set when the session was built
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == str(256 << 20)
