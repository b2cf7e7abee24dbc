"""Masks, row filters and protect() on the literal fixtures (FIXTURES.md section 2)."""

import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shroud.functions.masks import ID_MASK_TEXT, mask_const, mask_email
from shroud.plans.protect import Control, ControlConflict, Reader, protect
from shroud.sources import metadata as md

CONTROLS = [
    Control(md.FILTER, "scope_filter", ("area",)),
    Control(md.MASK, "id_mask", ("taxno",)),
    Control(md.MASK, "null_mask", ("pay",)),
]


def run(people, ents, who, controls=CONTROLS, snapshot=True):
    rows = protect(people, controls, Reader(who, ents, snapshot=snapshot)).orderBy("id").collect()
    return rows


# reader -> visible ids, raw?
EXPECTED = {
    "p_north": ([1, 2], True),
    "p_null": ([1, 2], False),
    "p_two": ([1, 2, 3, 4], True),
    "p_all": ([1, 2, 3, 4, 5, 6], False),
    "p_all_raw": ([1, 2, 3, 4, 5, 6], True),
    "p_dup": ([3, 4], True),
    "p_none": ([], None),
}


@pytest.mark.parametrize("snapshot", [True, False])
@pytest.mark.parametrize("who", sorted(EXPECTED))
def test_reader_table(people, ents, who, snapshot):
    ids, raw = EXPECTED[who]
    rows = run(people, ents, who, snapshot=snapshot)
    assert [r.id for r in rows] == ids
    raw_rows = {r.id: r for r in people.collect()}
    for r in rows:
        if raw:
            assert r.taxno == raw_rows[r.id].taxno and r.pay == raw_rows[r.id].pay
        else:
            # NULL is hidden too: the constant replaces it
            assert r.taxno == ID_MASK_TEXT and r.pay is None
        assert r.perk == raw_rows[r.id].perk  # never masked


def test_schema_kept(people, ents):
    out = protect(people, CONTROLS, Reader("p_all", ents))
    assert [f.name for f in out.schema] == people.columns
    assert [f.dataType for f in out.schema] == [f.dataType for f in people.schema]


@pytest.mark.parametrize("value,expected", [
    (None, None), ("", "****"), ("x", "****"), ("@x", "@****@x"), ("a@", "a****@"),
    ("a@b@c", "a****@b@c"), ("é@x", "é****@x"), ("kim.oak@corp.test", "k****@corp.test"), ("nomail", "****"),
])
def test_email_mask_edges(spark, value, expected):
    df = spark.createDataFrame([(value,)], "m string")
    assert df.select(mask_email(F.col("m")).alias("m")).first().m == expected


@pytest.mark.parametrize("snapshot", [True, False])
def test_truth_table_appendix(spark, snapshot):
    """M1, M2 and F1 for one reader, row by row (SURVEY Appendix A)."""
    data = spark.createDataFrame([(1, "A", "s", 7), (2, None, "s", 7)], "id int, v string, t string, n int")
    cases = [
        ([], "const", None, [], "none"),
        ([("r", "A", False)], "const", None, [1], "A false"),
        ([("r", "A", None)], "const", None, [1], "A null"),
        ([("r", "B", True)], "raw", 7, [], "B true"),
        ([("r", "ALL", False)], "const", None, [1, 2], "ALL"),
        ([("r", "A", False), ("r", "B", True)], "raw", 7, [1], "raw on A rows too"),
    ]
    for rows, m1, m2, visible, label in cases:
        ents = spark.createDataFrame(rows, md.ENTITLEMENTS)
        ctl = [Control(md.MASK, "id_mask", ("t",)), Control(md.MASK, "null_mask", ("n",))]
        masked = protect(data, ctl, Reader("r", ents, snapshot=snapshot)).orderBy("id").collect()
        assert all((x.t == "s") == (m1 == "raw") for x in masked), label
        assert all(x.n == m2 for x in masked), label
        filt = protect(data, [Control(md.FILTER, "scope_filter", ("v",))], Reader("r", ents, snapshot=snapshot))
        assert sorted(x.id for x in filt.collect()) == visible, label


@pytest.mark.parametrize("snapshot", [True, False])
def test_error_channel(people, ents, snapshot):
    """A hidden row must not raise: p_north cannot see id 4 (pay = 20)."""
    out = protect(people, [Control(md.FILTER, "scope_filter", ("area",))], Reader("p_north", ents, snapshot=snapshot))
    got = out.where(F.lit(100) / (F.col("pay") - 20) > -999).select("id").collect()
    assert [r.id for r in got] == [1]


@pytest.mark.parametrize("snapshot", [True, False])
def test_error_channel_udf(people, ents, snapshot):
    """A user Python UDF that fails on a hidden value stays silent."""
    from pyspark.sql.functions import udf

    @udf("boolean")
    def picky(x):
        if x == 20:
            raise ValueError("saw a hidden row")
        return True

    out = protect(people, [Control(md.FILTER, "scope_filter", ("area",))], Reader("p_north", ents, snapshot=snapshot))
    # id 2 (NULL pay) is visible and passes; id 4 (pay = 20) is hidden and never reaches the UDF
    assert sorted(r.id for r in out.where(picky(F.col("pay"))).select("id").collect()) == [1, 2]


def test_predicate_on_masked_column(people, ents):
    """Everything above the mask sees the masked value."""
    out = protect(people, CONTROLS, Reader("p_all", ents))
    assert out.where(F.col("taxno") == "101-11-1001").count() == 0
    assert out.where(F.col("taxno") == ID_MASK_TEXT).count() == 6
    assert out.agg(F.sum("pay")).first()[0] is None


def test_live_reader_sees_appended_rows(spark, people, scratch):
    """A live reader's DataFrame, built once, sees an entitlement appended afterwards."""
    name = f"ents_{uuid.uuid4().hex[:8]}"
    spark.createDataFrame([("late", "NORTH", False)], md.ENTITLEMENTS).write.option(
        "path", f"{scratch}/{name}").saveAsTable(name)
    out = protect(people, CONTROLS, Reader("late", spark.table(name), snapshot=False))
    assert out.count() == 2
    spark.sql(f"INSERT INTO {name} VALUES ('late', 'SOUTH', true)")
    rows = out.orderBy("id").collect()
    assert [r.id for r in rows] == [1, 2, 3, 4] and rows[0].taxno == "101-11-1001"


def test_snapshot_filter_pushed_down(spark, people, ents, scratch):
    path = f"{scratch}/people"
    people.write.parquet(path)
    out = protect(spark.read.parquet(path), CONTROLS, Reader("p_north", ents))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(area, [NORTH])" in plan or "EqualTo(area,NORTH)" in plan
    assert "Subquery" not in plan


def test_live_entitlement(spark, people):
    ents_path = spark.createDataFrame([("late", "NORTH", False)], md.ENTITLEMENTS)
    base = spark.createDataFrame([("late", "NORTH", False)], md.ENTITLEMENTS)
    grown = base.unionByName(spark.createDataFrame([("late", "SOUTH", True)], md.ENTITLEMENTS))
    assert protect(people, CONTROLS, Reader("late", ents_path)).count() == 2
    rows = protect(people, CONTROLS, Reader("late", grown)).orderBy("id").collect()
    assert [r.id for r in rows] == [1, 2, 3, 4] and rows[0].taxno == "101-11-1001"


def test_idempotent_and_subset(people, ents):
    once = protect(people, CONTROLS, Reader("p_two", ents))
    twice = protect(once, CONTROLS, Reader("p_two", ents))
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert once.count() <= people.count()


def test_two_masks_conflict(people, ents):
    with pytest.raises(ControlConflict):
        protect(people, [Control(md.MASK, "id_mask", ("taxno",)), Control(md.MASK, "redact", ("taxno",))],
                Reader("p_all", ents))


def test_constant_cast_fails_under_ansi(spark, people, ents):
    with pytest.raises((PySparkException, Exception)):
        people.select(mask_const(F.col("pay"), F.lit(False), "XXX", people.schema["pay"].dataType)).collect()


def test_plan_is_narrow_and_pruned(spark, people, ents, scratch):
    """No Python in the plan, no exchange outside the entitlement subqueries, and a
    projection of one column reads only it and the filter column."""
    path = f"{scratch}/people"
    people.write.parquet(path)
    df = spark.read.parquet(path)
    out = protect(df, CONTROLS, Reader("p_two", ents)).select("id")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    scan = [line for line in plan.splitlines() if "ReadSchema" in line and "id:int" in line]
    assert scan and "taxno" not in scan[0] and "pay" not in scan[0] and "area" in scan[0]


def test_entitlement_change_log(spark):
    """SET events rewrite every row of the principal that exists at that time."""
    from shroud.operators.entitlements import current_entitlements
    log = spark.createDataFrame([
        (1, "INSERT", "a", "NORTH", True),
        (2, "SET_SCOPE", "a", "ALL", None),      # after the first insert: applies to it
        (3, "INSERT", "a", "SOUTH", True),       # after the update: keeps SOUTH
        (4, "SET_RAW", "a", None, False),        # switches raw off on both rows
        (5, "INSERT", "b", "EAST", None),
        (0, "SET_SCOPE", "b", "WEST", None),     # before b's insert: no effect
        (6, "INSERT", "b", "EAST", None),        # a second identical row stays a second row
    ], md.ENTITLEMENT_LOG)
    got = sorted(tuple(r) for r in current_entitlements(log).collect())
    assert got == [("a", "ALL", False), ("a", "SOUTH", False), ("b", "EAST", None), ("b", "EAST", None)]


def test_export_roundtrip(spark, people, ents, scratch):
    from shroud.plans.protect import export_protected
    out = protect(people, CONTROLS, Reader("p_two", ents))
    back = export_protected(out, f"{scratch}/export")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, out.collect()))


def test_reader_defaults_to_current_user(spark, people):
    who = spark.range(1).select(F.current_user()).first()[0]
    ents = spark.createDataFrame([(who, "SOUTH", True)], md.ENTITLEMENTS)
    r = Reader.current(spark, ents)
    assert r.principal == who
    assert sorted(x.id for x in protect(people, CONTROLS, r).collect()) == [3, 4]
