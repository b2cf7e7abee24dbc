"""Properties of protect() over random entitlements."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shroud.functions.masks import ID_MASK_TEXT
from shroud.plans.protect import Control, Reader, protect
from shroud.sources import metadata as md

from .conftest import PEOPLE

CONTROLS = [Control(md.FILTER, "scope_filter", ("area",)), Control(md.MASK, "id_mask", ("taxno",)),
            Control(md.MASK, "null_mask", ("pay",))]
SCOPES = st.sampled_from(["NORTH", "SOUTH", "north", "ALL", "EAST", None])
ROWS = st.lists(st.tuples(st.sampled_from(["r", "other"]), SCOPES, st.sampled_from([True, False, None])),
                max_size=5)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=ROWS, extra=st.tuples(st.just("r"), SCOPES, st.sampled_from([True, False, None])))
def test_protect_properties(spark, people, rows, extra):
    ents = spark.createDataFrame(rows, md.ENTITLEMENTS)
    out = protect(people, CONTROLS, Reader("r", ents)).collect()
    ids = {r.id for r in out}
    raw = {r[0]: r for r in PEOPLE}
    # rows of the result are rows of the input, none doubled, schema kept
    assert ids <= set(raw) and len(ids) == len(out)
    # no raw value of a masked column leaks to a reader without raw rights
    entitled = any(p == "r" and f for p, _, f in rows)
    if not entitled:
        assert all(r.taxno == ID_MASK_TEXT and r.pay is None for r in out)
    # adding an entitlement never removes a row
    more = protect(people, CONTROLS, Reader("r", spark.createDataFrame(rows + [extra], md.ENTITLEMENTS))).collect()
    assert ids <= {r.id for r in more}
    # protect is idempotent
    again = protect(protect(people, CONTROLS, Reader("r", ents)), CONTROLS, Reader("r", ents)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, out))


def test_no_exchange_outside_subqueries(spark, people, ents, scratch):
    """The protected scan adds no shuffle and no join: those are only inside the entitlement
    subqueries (live reader), which run once and before it."""
    path = f"{scratch}/p"
    people.write.parquet(path)
    df = spark.read.parquet(path)
    for snapshot in (True, False):
        out = protect(df, CONTROLS, Reader("p_two", ents, snapshot=snapshot))
        plan = out._jdf.queryExecution().executedPlan()
        assert ("Subquery" in plan.toString()) == (not snapshot)
        todo, names = [plan.initialPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan], []
        while todo:
            node = todo.pop()
            names.append(node.nodeName())
            todo += [node.children().apply(i) for i in range(node.children().size())]   # subqueries are no children
        assert not [n for n in names if "Exchange" in n or "Join" in n], names
