"""Classifiers, the check digit, the dictionary and the review flow."""

from pyspark.sql import functions as F

from shroud.operators import classify as C
from shroud.sources import metadata as md

TEXTS = [
    (1, "write to kim.oak@corp.test or call +1 (555) 123-4567"),
    (2, "ssn 123-45-6789 and card 4111111111111111"),
    (3, "card 4111111111111112 is wrong; host 10.0.0.12 up"),
    (4, "Anna met John"),
    (5, None),
    (6, "nothing here 1234-56-789"),
]


def test_luhn(spark):
    df = spark.createDataFrame([("4111111111111111",), ("4111111111111112",), ("79927398713",), ("0",)], "r string")
    got = [r.ok for r in df.select(C.luhn_ok(F.col("r")).alias("ok")).collect()]
    assert got == [True, False, True, True]


def test_builtin_findings(spark):
    df = spark.createDataFrame(TEXTS, "id int, t string")
    f = {r.classifier: (r.n_nonnull, r.n_hits) for r in
         C.classify(df, "x", list(C.BUILTIN) + [C.NAME_DICTIONARY], ["t"]).collect()}
    assert f == {"email": (5, 1), "us_ssn": (5, 1), "phone": (5, 1), "credit_card": (5, 1), "ipv4": (5, 1),
                 "person_name": (5, 1)}


def test_column_name_classifier_reads_schema_only(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", "x")], "id int, full_name string, e_mail string")
    c = [C.Classifier("by_name", C.COLUMN_NAME, r"(?i)(name|mail)", "class", "person_name", 0.5)]
    f = {r.column_name: (r.n_nonnull, r.n_hits, r.share) for r in C.classify(df, "x", c).collect()}
    assert f == {"full_name": (2, 2, 1.0), "e_mail": (1, 1, 1.0)}


def test_dictionary_by_join_equals_literal(spark):
    df = spark.createDataFrame(TEXTS, "id int, t string")
    words = spark.createDataFrame([(w,) for w in C.GIVEN_NAMES], "word string")
    by_join = {r.id for r in C.dictionary_hits_by_join(df, "t", words, "id").collect()}
    by_lit = {r.id for r in df.where(C.dictionary_hit(F.col("t"), C.GIVEN_NAMES)).collect()}
    assert by_join == by_lit == {4}


def test_propose_and_accept(spark):
    df = spark.createDataFrame(TEXTS, "id int, t string")
    findings = C.classify(df, "s.t", C.BUILTIN, ["t"])
    have = spark.createDataFrame([("s.t", "t", "class", "us_ssn")], "table_id string, column_name string, key string, value string")
    props = C.propose_tags(findings, C.BUILTIN, have)
    assert {r.tag_value for r in props.collect()} == {"email_address", "phone_number", "credit_card", "ip_address"}
    dec = spark.createDataFrame([("s.t", "t", "class", "email_address", "ACCEPT", None),
                                 ("s.t", "t", "class", "ip_address", "REJECT", None),
                                 ("s.t", "t", "class", "phone_number", "ADJUST", "person_name")], md.DECISIONS)
    tags = {(r.key, r.value) for r in C.accept(props, dec).collect()}
    assert tags == {("class", "email_address"), ("class", "person_name")}   # credit_card is pending


def test_strings_inside_structs_arrays_and_maps_are_found(spark):
    rows = [(1, (["none", "a@b.com"], [{"k@k.de": "x"}]), None), (2, ([None], []), {"n": ("+1 (017) 555-7713",)}), (3, None, {"n": None})]
    df = spark.createDataFrame(rows, "id int, body struct<lines: array<string>, maps: array<map<string, string>>>, m map<string, struct<p: string>>")
    got = {(r.column_name, r.classifier): (r.n_nonnull, r.n_hits) for r in C.classify(df, "t", C.BUILTIN).collect()}
    assert got[("body.lines[]", "email")] == (1, 1) and got[("body.maps[]{key}", "email")] == (1, 1)
    assert got[("body.maps[]{value}", "email")] == (1, 0) and got[("m{value}.p", "phone")] == (1, 1)
    assert got[("m{key}", "email")] == (2, 0) and len(got) == 5 * len(C.BUILTIN)
    only = C.classify(df, "t", C.BUILTIN, ["m"])
    assert {r.column_name for r in only.collect()} == {"m{key}", "m{value}.p"}


def test_review_follows_the_log_and_the_vocabulary(spark):
    import pytest
    props = spark.createDataFrame([("t", "a", "class", "email_address", "email", 3, 0.5), ("t", "b", "class", "us_ssn", "us_ssn", 3, 0.5)],
                                  "table_id string, column_name string, tag_key string, tag_value string, classifier string, n_hits long, share double")
    log = spark.createDataFrame([(41, "t", "a", "class", "phone_number")], "seq long, table_id string, column_name string, key string, value string")
    vocab = spark.createDataFrame([("class", "email_address"), ("class", "us_ssn"), ("class", "phone_number")], "key string, allowed_value string")
    decide = lambda v: spark.createDataFrame([("t", "a", "class", "email_address", "ACCEPT", None), ("t", "b", "class", "us_ssn", "ADJUST", v)], md.DECISIONS)
    rows = C.accept(props, decide("phone_number"), log=log, vocab=vocab).collect()
    assert {(r.seq, r.column_name, r.value) for r in rows} == {(42, "a", "email_address"), (42, "b", "phone_number")}
    with pytest.raises(Exception, match="not allowed for `class`"):
        C.accept(props, decide("invented"), log=log, vocab=vocab).collect()
