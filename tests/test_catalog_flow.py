"""The statement facade: what each statement changes, on a catalog of stock and shop tables."""

import pytest

from shroud.operators.policies import PolicyNotFound
from shroud.operators.tags import PolicyConditionError
from shroud.plans.catalog import ProtectionCatalog
from shroud.plans.protect import Reader
from shroud.sources import metadata as md

STOCK = [(11, "A-1", 4.5, "depot1"), (12, "B-2", None, "depot2"), (13, "C-3", 9.0, None)]


@pytest.fixture(params=["session", "files"])
def cat(request, spark, scratch):
    c = ProtectionCatalog(spark, folder=f"{scratch}/log" if request.param == "files" else None)
    c.create_table("shop.stock.items", spark.createDataFrame(STOCK, "sku int, code string, cost double, depot string"), owner="keeper")
    return c


def who(spark, *rows):
    return Reader("buyer", spark.createDataFrame([("buyer", *r) for r in rows], md.ENTITLEMENTS))


def test_ungoverned_policy_is_refused_before_anything_is_written(cat):
    with pytest.raises(PolicyConditionError):
        cat.create_policy("hide", "catalog", "shop", md.MASK, "redact", ["buyer"], "secrecy", "trade")
    assert cat.policies().count() == 0
    with pytest.raises(PolicyNotFound):
        cat.drop_policy("hide", "shop")


def test_policy_covers_a_table_tagged_after_it(spark, cat):
    cat.create_governed_tag("secrecy", ["trade", "none"])
    cat.create_policy("hide", "catalog", "shop", md.MASK, "null_mask", ["buyer"], "secrecy", "trade", except_=["boss"])
    offers = spark.createDataFrame([("o1", 70.0), ("o2", 80.0)], "offer string, price double")
    cat.create_table("shop.sales.offers", offers, owner="seller")
    assert {r.price for r in cat.read("shop.sales.offers", who(spark)).collect()} == {70.0, 80.0}
    cat.set_tag("shop.sales.offers", "price", "secrecy", "trade")
    assert {r.price for r in cat.read("shop.sales.offers", who(spark)).collect()} == {None}
    cat.set_tag("shop.sales.offers", "price", "secrecy", "none")
    assert {r.price for r in cat.read("shop.sales.offers", who(spark)).collect()} == {70.0, 80.0}
    assert [r.name for r in cat.show_policies("shop").collect()] == ["hide"]


def test_filter_before_mask_and_both_come_off(spark, cat):
    cat.set_row_filter("shop.stock.items", "scope_filter", ["depot"])
    cat.set_mask("shop.stock.items", "Code", "id_mask")
    seen = cat.read("shop.stock.items", who(spark, ("depot2", False))).collect()
    assert [(r.sku, r.code == "B-2") for r in seen] == [(12, False)]
    cat.drop_mask("shop.stock.items", "CODE")       # column names compare in any case
    cat.drop_row_filter("shop.stock.items")
    assert [tuple(r) for r in cat.read("shop.stock.items", who(spark)).orderBy("sku").collect()] == STOCK


def test_last_statement_on_a_grant_wins(cat):
    for step in (cat.grant, cat.revoke, cat.grant, cat.revoke):
        step("SELECT", "shop.stock.items", "buyer")
    cat.grant("MANAGE", "shop.stock", "keeper")
    assert [(r.principal, r.privilege) for r in cat.current_grants().select("principal", "privilege").collect()] == [("keeper", "MANAGE")]
    assert cat.table_privileges().count() == 0 and cat.owner_of("shop.stock") == "keeper"


def test_making_a_table_again_keeps_its_controls(spark, cat):
    cat.create_governed_tag("secrecy", ["trade"])
    cat.set_tag("shop.stock.items", "code", "secrecy", "trade")
    cat.create_policy("hide", "schema", "shop.stock", md.MASK, "redact", ["buyer"], "secrecy")
    cat.create_table("shop.stock.items", spark.createDataFrame([(99, "Z-9", 1.0, "depot1")], "sku int, code string, cost double, depot string"), owner="keeper")
    row = cat.read("shop.stock.items", who(spark)).first()
    assert row.sku == 99 and row.code != "Z-9"


def test_reopened_catalog_goes_on_counting(spark, scratch):
    first = ProtectionCatalog(spark, folder=f"{scratch}/kept")
    for name in ("a", "b", "c"):
        first.grant("SELECT", "shop.stock.items", name)
    again = ProtectionCatalog(spark, folder=f"{scratch}/kept")
    again.revoke("SELECT", "shop.stock.items", "c")
    assert sorted(r.principal for r in again.current_grants().collect()) == ["a", "b"]


def test_unreadable_log_raises(spark, scratch):
    import pathlib
    log = pathlib.Path(scratch) / "broken" / "control_log"
    log.mkdir(parents=True)
    (log / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        ProtectionCatalog(spark, folder=f"{scratch}/broken").manual_controls().collect()
