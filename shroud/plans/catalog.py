"""A statement-level facade over the governance relations.

Each method is one statement of the kind a data owner issues (set a mask, set a row filter,
grant, revoke, tag a column, create or drop a policy, read a table). Every statement
appends one row to an append-only relation, and reads fold those logs, so nothing is
overwritten under a running plan. With ``folder`` the logs are parquet files in a shared
location (a sub-folder of spark.checkpoint.dir on a cluster); without it they are kept as
DataFrames in the session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import policies as P
from ..operators import privileges as PR
from ..operators import tags as TG
from ..sources import metadata as md
from .governance import Governance
from .protect import Functions, Reader, default_functions

CONTROL_LOG = T.StructType([T.StructField("seq", T.LongType()), T.StructField("op", T.StringType()),
                            T.StructField("table_id", T.StringType()), T.StructField("kind", T.StringType()),
                            T.StructField("function", T.StringType()),
                            T.StructField("columns", T.ArrayType(T.StringType()))])
POLICY_LOG = T.StructType([T.StructField("seq", T.LongType()), T.StructField("op", T.StringType())]
                          + md.POLICIES.fields)

_SCHEMAS = {
    "securables": md.SECURABLES, "grants_log": md.GRANTS_LOG, "control_log": CONTROL_LOG,
    "column_tags": md.COLUMN_TAGS, "table_tags": md.TABLE_TAGS, "tag_vocab": md.TAG_VOCAB,
    "policy_log": POLICY_LOG,
}


class ProtectionCatalog:
    def __init__(self, spark: SparkSession, folder: str | None = None, functions: Functions | None = None):
        self.spark = spark
        self.folder = folder.rstrip("/") if folder else None
        self.functions = functions or default_functions()
        self._mem = {k: spark.createDataFrame([], s) for k, s in _SCHEMAS.items()}
        self._tables: dict[str, DataFrame] = {}

    # ---- storage ------------------------------------------------------------------------
    def _append(self, name: str, rows: list[tuple]) -> None:
        df = self.spark.createDataFrame(rows, _SCHEMAS[name])
        if self.folder:
            df.write.mode("append").parquet(f"{self.folder}/{name}")
        else:
            self._mem[name] = self._mem[name].unionByName(df)

    def relation(self, name: str) -> DataFrame:
        if self.folder:
            path = f"{self.folder}/{name}"
            at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            if not at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
                return self.spark.createDataFrame([], _SCHEMAS[name])  # nothing written yet
            return self.spark.read.schema(_SCHEMAS[name]).parquet(path)  # any failure to read raises
        return self._mem[name]

    def _next_seq(self) -> int:
        """One past the highest number in any log, so statements of a reopened catalog come
        after those of the one before. One writer at a time is assumed."""
        logs = [n for n, s in _SCHEMAS.items() if "seq" in s.fieldNames()]
        return 1 + max(self.relation(n).agg(F.max("seq")).first()[0] or 0 for n in logs)

    # ---- objects ------------------------------------------------------------------------
    def create_table(self, table_id: str, df: DataFrame, owner: str) -> None:
        """Register a table (and its catalog and schema when new) with an owner."""
        catalog, schema, _ = table_id.split(".")
        ids = [md.METASTORE, catalog, f"{catalog}.{schema}", table_id]
        known = {r[0] for r in self.relation("securables").where(F.col("id").isin(ids)).select("id").distinct().collect()}
        rows = []
        if md.METASTORE not in known:
            rows.append((md.METASTORE, None, "metastore", md.METASTORE, owner))
        if catalog not in known:
            rows.append((catalog, md.METASTORE, "catalog", catalog, owner))
        if f"{catalog}.{schema}" not in known:
            rows.append((f"{catalog}.{schema}", catalog, "schema", schema, owner))
        if table_id not in known:  # a table made again keeps its row, its controls and its tags
            rows.append((table_id, f"{catalog}.{schema}", "table", table_id.split(".")[-1], owner))
        if rows:
            self._append("securables", rows)
        self._tables[table_id] = df

    def owner_of(self, securable_id: str) -> str | None:
        row = self.relation("securables").where(F.col("id") == securable_id).select("owner").first()
        return row[0] if row else None

    # ---- privileges -----------------------------------------------------------------------
    def grant(self, privilege: str, securable_id: str, principal: str) -> None:
        self._append("grants_log", [(self._next_seq(), "GRANT", privilege, securable_id, principal)])

    def revoke(self, privilege: str, securable_id: str, principal: str) -> None:
        self._append("grants_log", [(self._next_seq(), "REVOKE", privilege, securable_id, principal)])

    def current_grants(self) -> DataFrame:
        return PR.current_grants(self.relation("grants_log"))

    def show_grants(self, securable_id: str) -> DataFrame:
        return PR.show_grants(self.current_grants(), securable_id)

    def table_privileges(self) -> DataFrame:
        return PR.table_privileges(self.current_grants(), self.relation("securables"))

    # ---- manual controls ------------------------------------------------------------------
    def set_mask(self, table_id: str, column: str, function: str) -> None:
        self._append("control_log", [(self._next_seq(), "SET", table_id, md.MASK, function, [column])])

    def drop_mask(self, table_id: str, column: str) -> None:
        self._append("control_log", [(self._next_seq(), "DROP", table_id, md.MASK, None, [column])])

    def set_row_filter(self, table_id: str, function: str, columns: list[str]) -> None:
        self._append("control_log", [(self._next_seq(), "SET", table_id, md.FILTER, function, list(columns))])

    def drop_row_filter(self, table_id: str) -> None:
        self._append("control_log", [(self._next_seq(), "DROP", table_id, md.FILTER, None, [])])

    def manual_controls(self) -> DataFrame:
        """Current controls: the latest statement per (table, mask column) and per table
        for the row filter; a DROP removes."""
        log = self.relation("control_log").withColumn(
            "unit", F.when(F.col("kind") == md.MASK, F.lower(F.element_at("columns", 1))).otherwise(F.lit("")))
        last = (log.groupBy("table_id", "kind", "unit")
                .agg(F.max(F.struct("seq", "op", "function", "columns")).alias("l")))
        return last.where(F.col("l.op") == "SET").select(
            "table_id", "kind", F.col("l.function").alias("function"), F.col("l.columns").alias("columns"))

    # ---- tags and policies ----------------------------------------------------------------
    def create_governed_tag(self, key: str, allowed_values: list[str]) -> None:
        self._append("tag_vocab", [(key, v) for v in allowed_values])

    def set_tag(self, table_id: str, column: str, key: str, value: str) -> None:
        self._append("column_tags", [(self._next_seq(), table_id, column, key, value)])

    def set_table_tag(self, table_id: str, key: str, value: str) -> None:
        self._append("table_tags", [(self._next_seq(), table_id, key, value)])

    def policies(self) -> DataFrame:
        cols, key = [f.name for f in md.POLICIES.fields], ("name", "scope_kind", "scope_name")
        last = (self.relation("policy_log").groupBy(*key)
                .agg(F.max(F.struct("seq", "op", *[c for c in cols if c not in key])).alias("l")))
        return last.where(F.col("l.op") == "CREATE").select(*[F.col(c) if c in key else F.col(f"l.{c}").alias(c) for c in cols])

    def create_policy(self, name: str, scope_kind: str, scope_name: str, kind: str, function: str,
                      to: list[str], match_key: str, match_value: str | None = None,
                      except_: list[str] | None = None, when_key: str | None = None,
                      when_value: str | None = None) -> None:
        """Create a policy; a condition on a key outside the governed vocabulary fails."""
        row = (name, scope_kind, scope_name, kind, function, list(to), list(except_ or []), when_key, when_value,
               match_key, match_value)
        TG.validate_policies(self.spark.createDataFrame([row], md.POLICIES), self.relation("tag_vocab"))
        self._append("policy_log", [(self._next_seq(), "CREATE") + row])

    def drop_policy(self, name: str, scope_name: str, scope_kind: str | None = None) -> None:
        """Drop a policy; a missing one is an error (no IF EXISTS), and so is a name that stands on
        securables of several kinds while no kind is given."""
        kind = P.scope_of(self.policies(), name, scope_name, scope_kind)
        self._append("policy_log", [(self._next_seq(), "DROP", name, kind, scope_name, None, None, None, None,
                                     None, None, None, None)])

    def show_policies(self, scope_name: str, scope_kind: str | None = None) -> DataFrame:
        return P.list_policies(self.policies(), scope_name, scope_kind)

    # ---- reads ----------------------------------------------------------------------------
    def governance(self) -> Governance:
        return Governance(self.relation("securables"), self.relation("column_tags"), self.relation("table_tags"),
                          self.relation("tag_vocab"), self.policies(), self.manual_controls(), self.functions)

    def read(self, table_id: str, reader: Reader) -> DataFrame:
        """The table as this reader sees it: manual controls and policies resolved now."""
        return self.governance().protect_table(table_id, self._tables[table_id], reader)
