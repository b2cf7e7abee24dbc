"""Governance bundle: the relations that decide what a reader sees, and protect_table(),
the read path of a policy-protected table (tag -> policy -> function, at query time)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import hierarchy as H
from ..operators import policies as P
from ..operators import tags as TG
from ..operators.joins import localize
from ..sources.metadata import EVERYONE, FILTER
from .protect import Control, Functions, Reader, default_functions, protect


@dataclass
class Governance:
    securables: DataFrame
    column_tags: DataFrame
    table_tags: DataFrame
    vocab: DataFrame
    policies: DataFrame
    manual: DataFrame
    functions: Functions = field(default_factory=default_functions)

    def __post_init__(self):
        self._checked: DataFrame | None = None
        self._checked_vocab: DataFrame | None = None
        self._valid: DataFrame | None = None
        self._valid_src: DataFrame | None = None

    def valid_policies(self) -> DataFrame:
        """Policies whose conditions are governed, resolved once per policy relation and
        kept local when small (they are control rows, bounded by a count)."""
        if self._valid is None or self._valid_src is not self.policies:
            self._valid = localize(P.valid_policies(localize(self.policies), localize(self.vocab)))
            self._valid_src = self.policies
        return self._valid

    def targets(self, policies: DataFrame | None = None, table_id: str | None = None) -> DataFrame:
        """Policy targets over the estate, or for one table (the table filter sits on the
        grouping key of the tag aggregate, so it is pushed to the tag scan)."""
        ct, tt, paths = self.column_tags, self.table_tags, H.table_paths(self.securables)
        if table_id is not None:
            ct = ct.where(F.col("table_id") == table_id)
            tt = tt.where(F.col("table_id") == table_id)
            paths = paths.where(F.col("table_id") == table_id)
        pol = self.valid_policies() if policies is None else policies
        return P.policy_targets(pol, TG.current_column_tags(ct), TG.current_table_tags(tt), paths)

    def _named_identities(self) -> set[str]:
        """Principals and groups that valid policies name in TO / EXCEPT, besides the
        everyone-group (the valid policies are a local, bounded relation)."""
        rows = self.valid_policies().select("to_principals", "except_principals").collect()
        return {x for r in rows for arr in r for x in (arr or [])} - {EVERYONE}

    def controls(self, reader: Reader | None = None, table_id: str | None = None, arguments: bool = False) -> DataFrame:
        """Effective controls; for one reader when given (TO / EXCEPT applied). The
        reader's groups are resolved only when some policy names a principal or group
        other than the everyone-group."""
        pol = self.valid_policies()
        if reader is not None:
            groups = reader.groups() if self._named_identities() else []
            pol = P.applies_to(pol, reader.principal, groups)
        man = self.manual if table_id is None else self.manual.where(F.col("table_id") == table_id)
        return P.effective_controls(man, self.targets(pol, table_id), arguments)

    def controls_for(self, table_id: str, reader: Reader) -> list[Control]:
        """One table's controls, with all argument columns. They come to the driver to build
        Column expressions; without conflicts there are at most as many as columns."""
        self.check_policies()
        rows = self.controls(reader, table_id, arguments=True).collect()
        return [Control(r["kind"], r["function"], tuple(r["columns"]), r["origin"]) for r in rows]

    def check_policies(self) -> None:
        """Raise if a policy's condition is not governed (T4): leaving the policy out would
        show what it hides. Tested once per policy and vocabulary relation."""
        if self._checked is not (seen := self.policies) or self._checked_vocab is not self.vocab:
            TG.validate_policies(self.policies, self.vocab)
            self._checked, self._checked_vocab = seen, self.vocab

    def protect_table(self, table_id: str, df: DataFrame, reader: Reader) -> DataFrame:
        """Resolve the controls of this table for this reader, then protect. Call per read:
        the control set is fixed when the DataFrame is built, entitlements are not."""
        reader = reader.fresh()
        return protect(df, self.controls_for(table_id, reader), reader, self.functions)

    def materialize(self, folder: str, partitions: int | None = None) -> "Governance":
        """Write the relations a per-read lookup filters by table id (current column and
        table tags, manual controls, table paths) into ``folder`` (a shared location such as
        a sub-folder of spark.checkpoint.dir), range-partitioned and sorted by table_id.
        protect_table() then reads a few row groups per table (parquet min/max statistics
        on table_id) instead of scanning every tag. Returns a Governance over those files;
        later tag events can still be appended with with_tags()."""
        spark = self.column_tags.sparkSession
        n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

        def write(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
            path = f"{folder.rstrip('/')}/{name}"
            df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)
            return spark.read.parquet(path)

        ct = (self.column_tags.groupBy("table_id", "column_name", "key")
              .agg(F.max("seq").alias("seq"), TG.latest("value").alias("value"))
              .select("seq", "table_id", "column_name", "key", "value"))
        tt = (self.table_tags.groupBy("table_id", "key")
              .agg(F.max("seq").alias("seq"), TG.latest("value").alias("value"))
              .select("seq", "table_id", "key", "value"))
        g = Governance(write(self.securables, "securables", ["id"]),
                       write(ct, "column_tags", ["table_id", "column_name"]),
                       write(tt, "table_tags", ["table_id"]), self.vocab, self.policies,
                       write(self.manual, "manual_controls", ["table_id"]), self.functions)
        g._valid, g._valid_src, g._checked, g._checked_vocab = self._valid, self._valid_src, self._checked, self._checked_vocab
        return g

    def with_tags(self, rows: DataFrame) -> "Governance":
        """A new table or column tagged later (P9): same policies, more tag rows."""
        g = Governance(self.securables, self.column_tags.unionByName(rows), self.table_tags, self.vocab,
                       self.policies, self.manual, self.functions)
        g._valid, g._valid_src, g._checked, g._checked_vocab = self._valid, self._valid_src, self._checked, self._checked_vocab
        return g


__all__ = ["Governance", "FILTER"]
