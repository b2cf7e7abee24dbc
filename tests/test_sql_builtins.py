"""Built-in SQL the reference uses directly (R4, R5, R18, A10): comments, drop cascade, and
a SQL function with a query in its body equal to our Column masks and filters."""

import uuid


from shroud.functions.masks import ID_MASK_TEXT
from shroud.plans.protect import Control, Reader, protect
from shroud.sources import metadata as md
from shroud.sources.tables import save_as_table


def test_comments_and_drop_cascade(spark, people):
    db = f"lab_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE SCHEMA {db}")
    save_as_table(people, f"{db}.people", comment="people with identifiers",
                  column_comments={"taxno": "tax number, masked"})
    desc = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {db}.people").collect()}
    assert desc.get("Comment") == "people with identifiers"
    cols = {r.col_name: r.comment for r in spark.sql(f"DESCRIBE TABLE {db}.people").collect()}
    assert cols["taxno"] == "tax number, masked"
    owner = {r[0]: r[1] for r in spark.sql(f"DESCRIBE SCHEMA EXTENDED {db}").collect()}
    assert "Owner" in owner or "Namespace Name" in owner
    spark.sql(f"DROP SCHEMA {db} CASCADE")
    assert db not in [r[0] for r in spark.sql("SHOW SCHEMAS").collect()]


def test_sql_function_with_query_equals_column_mask(spark, people, ents):
    ents.createOrReplaceTempView("ents_v")
    people.createOrReplaceTempView("people_v")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION tax_mask_for_null(v STRING) RETURNS STRING RETURN
        CASE WHEN EXISTS (SELECT 1 FROM ents_v e WHERE e.principal = 'p_null' AND e.can_view_raw) THEN v
        ELSE '{ID_MASK_TEXT}' END""")
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION area_scope_two(r STRING) RETURNS BOOLEAN RETURN
        EXISTS (SELECT 1 FROM ents_v e WHERE e.principal = 'p_two' AND (e.scope = r OR e.scope = 'ALL'))""")
    via_sql = spark.sql("SELECT id, tax_mask_for_null(taxno) AS taxno FROM people_v").collect()
    ours = protect(people, [Control(md.MASK, "id_mask", ("taxno",))], Reader("p_null", ents)).select("id", "taxno")
    assert sorted(map(tuple, via_sql)) == sorted(map(tuple, ours.collect()))
    rows_sql = {r.id for r in spark.sql("SELECT id FROM people_v WHERE area_scope_two(area)").collect()}
    rows_ours = {r.id for r in protect(people, [Control(md.FILTER, "scope_filter", ("area",))],
                                       Reader("p_two", ents)).collect()}
    assert rows_sql == rows_ours == {1, 2, 3, 4}
