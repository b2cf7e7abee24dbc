"""protect(): apply the row filters and column masks that hold for one reader (M6, F4, F6),
plus the two materialised forms, a protected view (V1) and a protected export (V2).

Plan shape: one Filter, then one Project, both narrow: the protected scan adds no
exchange, keeps parquet column pruning (a column that is not selected is not read, masked
or not) and stays in whole-stage codegen. With a snapshot reader the filter is a literal
IN list (pushed to the parquet reader) and an entitled reader's masks fold away; with a
live reader both hold one uncorrelated scalar subquery each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import masks as M
from ..functions.predicates import group_predicate, scope_bucket_predicate, scope_literal_predicate
from ..operators import entitlements as E
from ..sources.metadata import FILTER, MASK


class Reader:
    """Who reads. Every operator takes an explicit principal.

    snapshot=True (default): the reader's entitlements are resolved when the protected
    DataFrame is built, by one small job whose size is checked first. Masks of an entitled
    reader then fold away, and the scope filter is a literal IN list that reaches the
    parquet reader. Build a protected DataFrame per read (as protect_table does).

    snapshot=False: entitlements stay uncorrelated scalar subqueries inside the plan, run
    when the DataFrame runs; a long-held DataFrame or a view sees appended entitlement
    rows. Group membership is always resolved at build time (a snapshot, as a platform
    caching memberships would).
    """

    def __init__(self, principal: str, entitlements: DataFrame | None = None,
                 memberships: DataFrame | None = None, max_scope_literal: int = 10_000,
                 snapshot: bool = True):
        self.principal = principal
        self.entitlements = entitlements
        self.memberships = memberships
        self.max_scope_literal = max_scope_literal
        self.snapshot = snapshot
        self._groups: list[str] | None = None
        self._raw_col: Column | None = None
        self._scopes_col: Column | None = None
        self._raw: bool | None = None
        self._scope_list: list[str] | None = None

    @classmethod
    def current(cls, spark, entitlements: DataFrame | None = None, memberships: DataFrame | None = None,
                **kw) -> "Reader":
        """The session's own user (``current_user()``), for callers that do not name a
        principal. Local mode reports the operating-system user."""
        who = spark.range(1).select(F.current_user()).first()[0]
        return cls(who, entitlements, memberships, **kw)

    def live(self) -> "Reader":
        return Reader(self.principal, self.entitlements, self.memberships, self.max_scope_literal, snapshot=False)

    def fresh(self) -> "Reader":
        """The same reader with nothing resolved yet: rights are looked up anew for every
        protected DataFrame, so a grant or a revocation counts from the next read on."""
        return Reader(self.principal, self.entitlements, self.memberships, self.max_scope_literal, self.snapshot)

    def _need_ent(self) -> DataFrame:
        if self.entitlements is None:
            raise ValueError("this control needs an entitlements relation")
        return self.entitlements

    def _resolve(self) -> None:
        """One job: the reader's distinct (scope, raw) pairs. A literal list is made of them up
        to max_scope_literal scopes; beyond it the scopes stay in a scalar subquery and the raw
        flag comes from an aggregate. A scope has three flags at most (true, false, NULL)."""
        mine = self._need_ent().where(F.col("principal") == F.lit(self.principal))
        cap = 3 * self.max_scope_literal + 3
        pairs = mine.select("scope", "can_view_raw").distinct().limit(cap + 1).collect()
        scopes = sorted({r[0] for r in pairs if r[0] is not None})
        if len(pairs) <= cap and len(scopes) <= self.max_scope_literal:
            self._raw, self._scope_list = any(bool(r[1]) for r in pairs), scopes
        else:
            self._raw = bool(mine.agg(F.coalesce(F.bool_or("can_view_raw"), F.lit(False))).first()[0])
            self._scope_list = None

    def scope_list(self) -> list[str] | None:
        """The resolved scope set, or None when it is larger than max_scope_literal."""
        if self._raw is None:
            self._resolve()
        return self._scope_list

    def allowed_raw(self) -> Column:
        if self.snapshot:
            self.scope_list()
            return F.lit(self._raw)
        if self._raw_col is None:
            self._raw_col = E.allowed_raw(self._need_ent(), self.principal)
        return self._raw_col

    def scopes(self) -> Column:
        if self._scopes_col is None:
            self._scopes_col = E.scope_buckets(self._need_ent(), self.principal)
        return self._scopes_col

    def groups(self) -> list[str]:
        if self._groups is None:
            if self.memberships is None:
                self._groups = sorted({E.EVERYONE})
            else:
                self._groups = E.principal_groups(self.memberships, self.principal)
        return self._groups

    def groups_col(self) -> Column:
        return F.array(*[F.lit(g) for g in self.groups()]).cast("array<string>")

    def in_group(self, group: str) -> Column:
        return E.is_member(self.groups(), group)


MaskFn = Callable[[Reader, Column, T.DataType], Column]
FilterFn = Callable[[Reader, DataFrame, list[str]], DataFrame]


def predicate_filter(pred: Callable[[Reader, list[Column]], Column]) -> FilterFn:
    def run(reader: Reader, df: DataFrame, cols: list[str]) -> DataFrame:
        return df.filter(pred(reader, [df[c] for c in cols]))
    return run


def scope_filter(reader: Reader, df: DataFrame, cols: list[str]) -> DataFrame:
    """F1 on the first argument column.

    Snapshot reader: ``col IN (<scopes>)`` (no filter when the set holds ALL) up to
    ``max_scope_literal`` scopes. Live reader, and a snapshot reader with more: one lookup in
    the bucketed scope set of a scalar subquery. Every form is a single Filter that Spark
    keeps ahead of a user's predicate, so a hidden row never reaches user code; none is a
    join, below which a user predicate could be pushed.
    """
    value = df[cols[0]]
    if reader.snapshot and (scopes := reader.scope_list()) is not None:
        pred = scope_literal_predicate(value, scopes)
        return df if pred is None else df.filter(pred)
    return df.filter(scope_bucket_predicate(value, reader.scopes(), E.scope_bucket))


def any_scope_filter(reader: Reader, df: DataFrame, cols: list[str]) -> DataFrame:
    """F1 over several argument columns: a row is seen if the value of any of them is in scope."""
    values = [df[c] for c in cols]
    if reader.snapshot and (scopes := reader.scope_list()) is not None:
        preds = [scope_literal_predicate(v, scopes) for v in values]
        return df if any(p is None for p in preds) else df.filter(reduce(or_, preds))
    return df.filter(reduce(or_, [scope_bucket_predicate(v, reader.scopes(), E.scope_bucket) for v in values]))


def group_filter(prefix: str, admin_group: str | None = None) -> FilterFn:
    """F2 (with admin bypass) / F3 (without)."""
    def pred(reader: Reader, cols: list[Column]) -> Column:
        admin = reader.in_group(admin_group) if admin_group else None
        return group_predicate(cols[0], reader.groups_col(), prefix, admin)
    return predicate_filter(pred)


def constant_mask(text: str) -> MaskFn:
    return lambda r, c, t: M.mask_const(c, r.allowed_raw(), text, t)


def group_constant_mask(group: str, text: str) -> MaskFn:
    """M4: raw for members of ``group``, else the constant."""
    return lambda r, c, t: M.mask_const(c, r.in_group(group), text, t)


def group_null_mask(group: str) -> MaskFn:
    return lambda r, c, t: M.mask_null(c, r.in_group(group))


@dataclass
class Functions:
    """Named mask and filter functions, what a control or a policy refers to by name."""
    masks: dict[str, MaskFn] = field(default_factory=dict)
    filters: dict[str, FilterFn] = field(default_factory=dict)

    def mask(self, name: str, fn: MaskFn) -> "Functions":
        self.masks[name] = fn
        return self

    def filter(self, name: str, fn: FilterFn) -> "Functions":
        self.filters[name] = fn
        return self


def default_functions() -> Functions:
    fx = Functions()
    fx.mask("id_mask", constant_mask(M.ID_MASK_TEXT))
    fx.mask("null_mask", lambda r, c, t: M.mask_null(c, r.allowed_raw()))
    fx.mask("email_partial", lambda r, c, t: M.mask_email(c))
    fx.mask("redact", lambda r, c, t: M.redact(c, M.REDACTED_TEXT, t))
    fx.filter("scope_filter", scope_filter)
    fx.filter("any_scope_filter", any_scope_filter)
    return fx


@dataclass(frozen=True)
class Control:
    kind: str                 # MASK or FILTER
    function: str
    columns: tuple[str, ...]  # MASK: the masked column; FILTER: argument columns
    origin: str = "manual"


class ControlConflict(ValueError):
    pass


class UnknownControl(ValueError):
    pass


def _as_controls(controls: Iterable) -> list[Control]:
    out = []
    for c in controls:
        if isinstance(c, Control):
            out.append(c)
        elif isinstance(c, Mapping):
            out.append(Control(c["kind"], c["function"], tuple(c["columns"]), c.get("origin", "manual")))
        else:  # Row
            d = c.asDict()
            out.append(Control(d["kind"], d["function"], tuple(d["columns"]), d.get("origin") or "manual"))
    return out


def _resolve(df: DataFrame, name: str) -> str:
    for c in df.columns:
        if c.lower() == name.lower():
            return c
    raise ValueError(f"column {name!r} not in {df.columns}")


def protect(df: DataFrame, controls: Iterable, reader: Reader,
            functions: Functions | None = None) -> DataFrame:
    """Filters first, on raw values; then masks, keeping name, position and type.

    Two masks on one column or two filters on one table raise ControlConflict; a control of
    an unknown kind raises, since skipping it would show what it hides.
    """
    fx = functions or default_functions()
    reader = reader.fresh()
    ctl = _as_controls(controls)
    for c in ctl:
        if c.kind not in (FILTER, MASK):
            raise UnknownControl(f"control of kind {c.kind!r}: {c}")
    filters = [c for c in ctl if c.kind == FILTER]
    mask_ctl = [c for c in ctl if c.kind == MASK]
    if len(filters) > 1:
        raise ControlConflict(f"{len(filters)} row filters on one table: {filters}")
    seen: dict[str, Control] = {}
    for c in mask_ctl:
        col = _resolve(df, c.columns[0])
        if col in seen:
            raise ControlConflict(f"two masks on column {col}: {seen[col]} and {c}")
        seen[col] = c
    out = df
    for c in filters:
        out = fx.filters[c.function](reader, out, [_resolve(out, x) for x in c.columns])
    if seen:
        types = {f.name: f.dataType for f in out.schema.fields}
        out = out.withColumns({col: fx.masks[c.function](reader, out[col], types[col])
                               for col, c in seen.items()})
    return out


def protected_view(name: str, df: DataFrame, controls: Iterable, reader: Reader,
                   functions: Functions | None = None) -> DataFrame:
    """V1: register what the reader may see under a view name. A view outlives one read,
    so its entitlements stay live subqueries; re-register it after the underlying files
    are overwritten."""
    out = protect(df, controls, reader.live(), functions)
    out.createOrReplaceTempView(name)
    return out


def export_protected(df: DataFrame, path: str) -> DataFrame:
    """V2: write one reader's protected result as a table of its own and read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
