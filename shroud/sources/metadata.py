"""Schemas of the governance relations.

Everything a governance platform keeps inside its catalog is an ordinary DataFrame here.
Securables are addressed by a dotted id: ``catalog``, ``catalog.schema``,
``catalog.schema.table``; the metastore is the id ``metastore``.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
B = T.BooleanType()
L = T.LongType()


def _f(name, dtype):
    return T.StructField(name, dtype, True)


ENTITLEMENTS = T.StructType([_f("principal", S), _f("scope", S), _f("can_view_raw", B)])
# change log form of entitlements (E4): the latest row per principal wins
# op: INSERT adds a row; SET_SCOPE / SET_RAW change every current row of the principal
ENTITLEMENT_LOG = T.StructType([_f("seq", L), _f("op", S), _f("principal", S), _f("scope", S),
                                _f("can_view_raw", B)])
MEMBERSHIPS = T.StructType([_f("member", S), _f("group_name", S)])
SECURABLES = T.StructType([_f("id", S), _f("parent_id", S), _f("kind", S), _f("name", S), _f("owner", S)])
GRANTS_LOG = T.StructType([_f("seq", L), _f("action", S), _f("privilege", S), _f("securable_id", S),
                           _f("principal", S)])
TAG_VOCAB = T.StructType([_f("key", S), _f("allowed_value", S)])
COLUMN_TAGS = T.StructType([_f("seq", L), _f("table_id", S), _f("column_name", S), _f("key", S),
                            _f("value", S)])
TABLE_TAGS = T.StructType([_f("seq", L), _f("table_id", S), _f("key", S), _f("value", S)])
MANUAL_CONTROLS = T.StructType([_f("table_id", S), _f("kind", S), _f("function", S),
                                _f("columns", T.ArrayType(S))])
POLICIES = T.StructType([
    _f("name", S), _f("scope_kind", S), _f("scope_name", S), _f("kind", S), _f("function", S),
    _f("to_principals", T.ArrayType(S)), _f("except_principals", T.ArrayType(S)),
    _f("when_key", S), _f("when_value", S), _f("match_key", S), _f("match_value", S),
])
CLASSIFIERS = T.StructType([_f("name", S), _f("kind", S), _f("pattern", S), _f("tag_key", S),
                            _f("tag_value", S), _f("min_share", T.DoubleType())])
LINEAGE_EDGES = T.StructType([_f("src_table", S), _f("src_column", S), _f("dst_table", S),
                              _f("dst_column", S)])
DECISIONS = T.StructType([_f("table_id", S), _f("column_name", S), _f("tag_key", S), _f("tag_value", S),
                          _f("decision", S), _f("adjusted", S)])

# Fixed names with a meaning of their own.
EVERYONE = "all_users"          # the built-in group that holds every principal
METASTORE = "metastore"         # id of the root securable
ALL_SCOPE = "ALL"               # entitlement scope that covers every row
MASK = "MASK"
FILTER = "FILTER"
