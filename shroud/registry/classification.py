"""Registered queries for classification and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import classify as C
from ..operators import tags as TG
from ..plans.protect import Control, Reader, protect
from ..session import shared_dir
from ..sources import metadata as md
from ..sources.tables import literal, read_table
from ..streaming.protect_stream import run_aggregate, run_per_batch, table_stream
from . import estate as es
from .common import ENTS_SQL, entitlements, memberships, values_sql, with_ctes
from .governance import _EMAIL_MASK, gov, page_contacts

# every driver table, with its string columns, classified as one schema
SCHEMA_TABLES = {
    "region": ("r_name",),
    "nation": ("n_name",),
    "customer": ("c_name", "c_mktsegment"),
    "supplier": ("s_name",),
    "part": ("p_name", "p_brand", "p_type"),
    "orders": ("o_orderstatus", "o_orderpriority"),
    "lineitem": ("l_returnflag", "l_linestatus"),
    "events": ("event_type", "props"),
    "documents": ("text", "lang", "source"),
    "embeddings": (),
    "pages": ("url", "html"),
    "benchmark": ("text",),
    "labels": (),
    "conversations": ("role", "text"),
}

CUSTOM = (
    C.Classifier("api_token", C.REGEX, r'token = "[0-9a-f]{16,}', "secret", "token", 0.005, guard='token = "'),
    C.Classifier("name_column", C.COLUMN_NAME, r"(?i)(name|mail)", "class", "person_name", 0.5),
)

DECISION_ROWS = [
    ("main.tpch.documents", "text", "class", "email_address", "ACCEPT", None),
    ("main.tpch.documents", "text", "class", "credit_card", "ACCEPT", None),
    ("main.tpch.documents", "text", "class", "ip_address", "REJECT", None),
    ("main.tpch.pages", "html", "class", "phone_number", "ADJUST", "ip_address"),
]
DECISION_COLS = ("table_id", "column_name", "tag_key", "tag_value", "decision", "adjusted")


def q_classify_documents(spark, sf):
    return C.classify(read_table(spark, sf, "documents"), "main.tpch.documents", C.BUILTIN, ["text"])


def q_classify_pages(spark, sf):
    return C.classify(read_table(spark, sf, "pages"), "main.tpch.pages", C.BUILTIN, ["url", "html"])


def q_classify_cards(spark, sf):
    """Per document with a 16-digit run: how many runs, how many pass the check digit."""
    d = read_table(spark, sf, "documents").select("doc_id", C.card_runs(F.col("text")).alias("runs"))
    return d.where(F.size("runs") > 0).select("doc_id", F.size("runs").cast("bigint").alias("n_runs"),
                                              F.size(F.filter("runs", C.luhn_ok)).cast("bigint").alias("n_valid"))


def q_classify_dictionary(spark, sf):
    parts = [C.classify(read_table(spark, sf, t), f"main.tpch.{t}", [C.NAME_DICTIONARY], [c])
             for t, c in (("documents", "text"), ("conversations", "text"), ("customer", "c_name"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def nested_documents(spark, sf):
    """Documents as a table with nested columns: lines and source in a struct, the text by language."""
    d = read_table(spark, sf, "documents")
    return d.select("doc_id", F.struct("source", F.split("text", "\n").alias("lines")).alias("body"),
                    F.create_map(F.coalesce("lang", F.lit("und")), "text").alias("by_lang"))


def q_classify_nested(spark, sf):
    """C1 on strings inside structs, arrays and maps."""
    return C.classify(nested_documents(spark, sf), "main.tpch.nested_documents", C.BUILTIN)


def q_classify_custom(spark, sf):
    d = C.classify(read_table(spark, sf, "documents"), "main.tpch.documents", CUSTOM, ["text"])
    c = C.classify(read_table(spark, sf, "customer"), "main.tpch.customer", CUSTOM)
    return d.unionByName(c)


def _schema_findings(spark, sf):
    return C.classify_schema([(f"main.tpch.{t}", read_table(spark, sf, t)) for t in SCHEMA_TABLES], C.BUILTIN)


def q_classify_schema(spark, sf):
    return _schema_findings(spark, sf)


def q_tag_proposals(spark, sf):
    return C.propose_tags(_schema_findings(spark, sf), C.BUILTIN, TG.current_column_tags(es.column_tags(spark, sf)))


def q_tag_accept(spark, sf):
    props = q_tag_proposals(spark, sf)
    return C.accept(props, literal(spark, DECISION_ROWS, md.DECISIONS), log=es.column_tags(spark, sf), vocab=es.vocab(spark))


def q_stream_classify(spark, sf):
    """Classification as a streaming aggregate over the document files; its final
    state equals the batch answer."""
    schema = read_table(spark, sf, "documents").schema
    stream = table_stream(spark, sf, "documents", schema)
    run = uuid.uuid4().hex
    agg = C.classify(stream, "main.tpch.documents", C.BUILTIN, ["text"])
    return run_aggregate(agg, shared_dir(spark, f"streams/classify_{run}/out"),
                         shared_dir(spark, f"streams/classify_{run}/ckpt"))


def q_stream_protect(spark, sf):
    """The events stream, filtered to the reader's event types and with value masked,
    protect resolved per micro-batch."""
    schema = read_table(spark, sf, "events").schema
    stream = table_stream(spark, sf, "events", schema)
    ents = entitlements(spark, sf)
    ctl = [Control(md.FILTER, "scope_filter", ("event_type",)), Control(md.MASK, "null_mask", ("value",))]
    run = uuid.uuid4().hex
    return run_per_batch(stream, lambda b: protect(b, ctl, Reader("ops", ents)),
                         shared_dir(spark, f"streams/protect_{run}/out"),
                         shared_dir(spark, f"streams/protect_{run}/ckpt"))


def q_classify_then_protect(spark, sf):
    """A new, untagged table is classified, the proposal accepted, the tag appended;
    the policy on that tag then masks the column. No policy or control was written."""
    g = gov(spark, sf)
    new_id = "main.tpch.page_contacts"
    g.securables = g.securables.unionByName(
        literal(spark, [(new_id, "main.tpch", "table", "page_contacts", "owner_tpch")], md.SECURABLES))
    contacts = page_contacts(spark, sf)
    findings = C.classify(contacts, new_id, C.BUILTIN, ["email"])
    props = C.propose_tags(findings, C.BUILTIN, TG.current_column_tags(g.column_tags))
    decisions = props.select("table_id", "column_name", "tag_key", "tag_value", F.lit("ACCEPT").alias("decision"),
                             F.lit(None).cast("string").alias("adjusted"))
    tagged = g.with_tags(C.accept(props, decisions, log=g.column_tags, vocab=g.vocab))
    return tagged.protect_table(new_id, contacts, Reader("eve", entitlements(spark, sf), memberships(spark, sf)))


# ---- DuckDB twins ---------------------------------------------------------------------------
def _luhn_sql(r: str) -> str:
    d = f"CAST(substr(reverse({r}), i + 1, 1) AS INTEGER)"
    return (f"list_sum(list_transform(range(length({r})), lambda i: CASE WHEN i % 2 = 0 THEN {d} "
            f"WHEN 2 * {d} > 9 THEN 2 * {d} - 9 ELSE 2 * {d} END)) % 10 = 0")


def _hit_sql(c: C.Classifier, col: str) -> str:
    if c.kind == C.REGEX:
        return "regexp_matches(" + col + ", '" + c.pattern.replace("'", "''") + "')"
    if c.kind == C.CARD:
        return f"len(list_filter(regexp_extract_all({col}, '[0-9]{{16}}'), lambda r: {_luhn_sql('r')})) > 0"
    if c.kind == C.DICTIONARY:
        words = ", ".join(f"'{w}'" for w in sorted(set(C.GIVEN_NAMES)))
        return f"list_has_any(regexp_split_to_array(lower({col}), '[^\\p{{L}}]+'), [{words}])"
    raise ValueError(c.kind)


def _finding_sql(table: str, table_id: str, col: str, c: C.Classifier) -> str:
    hits = f"count({col})" if c.kind == C.COLUMN_NAME else f"CAST(count_if(coalesce({_hit_sql(c, col)}, false)) AS BIGINT)"
    return (f"SELECT '{table_id}' AS table_id, '{col}' AS column_name, '{c.name}' AS classifier, "
            f"'{c.tag_key}' AS tag_key, '{c.tag_value}' AS tag_value, count({col}) AS n_nonnull, {hits} AS n_hits "
            f"FROM {table}")


def _findings_sql(pairs) -> str:
    body = "\n  UNION ALL ".join(_finding_sql(*p) for p in pairs)
    return (f"SELECT *, CASE WHEN n_nonnull > 0 THEN round(n_hits / n_nonnull, 6) ELSE 0.0 END AS share "
            f"FROM (\n  {body}) AS f")


SQL_CLASSIFY_DOCUMENTS = _findings_sql([("documents", "main.tpch.documents", "text", c) for c in C.BUILTIN])
def _nested_sql(path: str, values: str, c: C.Classifier) -> str:
    """One finding of a path; ``values`` is the list of a row's values at it."""
    held = f"len(list_filter({values}, lambda v: v IS NOT NULL)) > 0"
    hit = f"len(list_filter({values}, lambda v: coalesce({_hit_sql(c, 'v')}, false))) > 0"
    return (f"SELECT 'main.tpch.nested_documents' AS table_id, '{path}' AS column_name, '{c.name}' AS classifier, "
            f"'{c.tag_key}' AS tag_key, '{c.tag_value}' AS tag_value, CAST(count_if(coalesce({held}, false)) AS BIGINT) AS n_nonnull, "
            f"CAST(count_if(coalesce({hit}, false)) AS BIGINT) AS n_hits FROM documents")


SQL_CLASSIFY_NESTED = (
    "SELECT *, CASE WHEN n_nonnull > 0 THEN round(n_hits / n_nonnull, 6) ELSE 0.0 END AS share FROM (\n  "
    + "\n  UNION ALL ".join(_nested_sql(path, values, c) for path, values in (
        ("body.source", "[source]"), ("body.lines[]", "string_split(text, chr(10))"),
        ("by_lang{key}", "[coalesce(lang, 'und')]"), ("by_lang{value}", "[text]")) for c in C.BUILTIN) + ") AS f")
SQL_CLASSIFY_PAGES = _findings_sql([("pages", "main.tpch.pages", col, c) for col in ("url", "html") for c in C.BUILTIN])
SQL_CLASSIFY_CARDS = """
SELECT doc_id, len(runs) AS n_runs, len(list_filter(runs, lambda r: """ + _luhn_sql("r") + """)) AS n_valid
FROM (SELECT doc_id, regexp_extract_all(text, '[0-9]{16}') AS runs FROM documents) AS d WHERE len(runs) > 0"""
SQL_CLASSIFY_DICTIONARY = _findings_sql([(t, f"main.tpch.{t}", col, C.NAME_DICTIONARY)
                                         for t, col in (("documents", "text"), ("conversations", "text"),
                                                        ("customer", "c_name"))])
SQL_CLASSIFY_CUSTOM = _findings_sql([("documents", "main.tpch.documents", "text", CUSTOM[0]),
                                     ("customer", "main.tpch.customer", "c_name", CUSTOM[0]),
                                     ("customer", "main.tpch.customer", "c_mktsegment", CUSTOM[0]),
                                     ("customer", "main.tpch.customer", "c_name", CUSTOM[1])])
SQL_CLASSIFY_SCHEMA = _findings_sql([(t, f"main.tpch.{t}", col, c) for t, cols in SCHEMA_TABLES.items()
                                     for col in cols for c in C.BUILTIN])
_TH = values_sql([(c.name, float(c.min_share)) for c in C.BUILTIN], ("classifier", "min_share"), ("VARCHAR", "DOUBLE"))
_PROPOSALS = f"""SELECT f.table_id, f.column_name, f.tag_key, f.tag_value, f.classifier, f.n_hits, f.share
  FROM ({SQL_CLASSIFY_SCHEMA}) AS f JOIN {_TH} AS th ON th.classifier = f.classifier
  WHERE f.n_hits > 0 AND f.share >= th.min_share
    AND NOT EXISTS (SELECT 1 FROM cur_tags t WHERE t.table_id = f.table_id AND t.column_name = f.column_name
                    AND t.key = f.tag_key AND t.value = f.tag_value)"""
SQL_TAG_PROPOSALS = es.sql_with({"proposals": _PROPOSALS}, "SELECT * FROM proposals")
SQL_TAG_ACCEPT = es.sql_with({"proposals": _PROPOSALS,
                              "decisions": values_sql(DECISION_ROWS, DECISION_COLS, ["VARCHAR"] * 6)}, """
SELECT (SELECT CAST(max(seq) + 1 AS BIGINT) FROM column_tags) AS seq, p.table_id, p.column_name, p.tag_key AS key,
       CASE WHEN d.decision = 'ADJUST' THEN d.adjusted ELSE p.tag_value END AS value
FROM proposals p JOIN decisions d ON d.table_id = p.table_id AND d.column_name = p.column_name
  AND d.tag_key = p.tag_key AND d.tag_value = p.tag_value
WHERE d.decision <> 'REJECT'""")
SQL_STREAM_CLASSIFY = SQL_CLASSIFY_DOCUMENTS
SQL_STREAM_PROTECT = with_ctes({"ents": ENTS_SQL}, """
SELECT event_id, ts, user_id, event_type,
       CASE WHEN (SELECT coalesce(bool_or(can_view_raw), false) FROM ents WHERE principal = 'ops') THEN value END AS value,
       props
FROM events e WHERE EXISTS (SELECT 1 FROM ents x WHERE x.principal = 'ops' AND (x.scope = e.event_type OR x.scope = 'ALL'))""")
SQL_CLASSIFY_THEN_PROTECT = f"""
WITH pc AS (SELECT page_id, unnest(generate_series(1, len(m))) AS pos, unnest(m) AS email
            FROM (SELECT page_id, regexp_extract_all(html, '{C.EMAIL_PATTERN}') AS m FROM pages))
SELECT page_id, pos, {_EMAIL_MASK} AS email FROM pc"""


QUERIES = {
    "classify_documents": q_classify_documents,
    "classify_pages": q_classify_pages,
    "classify_cards": q_classify_cards,
    "classify_dictionary": q_classify_dictionary,
    "classify_nested": q_classify_nested,
    "classify_custom": q_classify_custom,
    "classify_schema": q_classify_schema,
    "tag_proposals": q_tag_proposals,
    "tag_accept": q_tag_accept,
    "stream_classify": q_stream_classify,
    "stream_protect": q_stream_protect,
    "classify_then_protect": q_classify_then_protect,
}

ORACLES = {
    "classify_documents": SQL_CLASSIFY_DOCUMENTS,
    "classify_pages": SQL_CLASSIFY_PAGES,
    "classify_cards": SQL_CLASSIFY_CARDS,
    "classify_dictionary": SQL_CLASSIFY_DICTIONARY,
    "classify_nested": SQL_CLASSIFY_NESTED,
    "classify_custom": SQL_CLASSIFY_CUSTOM,
    "classify_schema": SQL_CLASSIFY_SCHEMA,
    "tag_proposals": SQL_TAG_PROPOSALS,
    "tag_accept": SQL_TAG_ACCEPT,
    "stream_classify": SQL_STREAM_CLASSIFY,
    "stream_protect": SQL_STREAM_PROTECT,
    "classify_then_protect": SQL_CLASSIFY_THEN_PROTECT,
}
