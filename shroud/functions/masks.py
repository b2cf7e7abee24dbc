"""Column masks (M1-M5). Each returns a native Column expression: no Python runs per row,
so a masked projection stays inside whole-stage codegen and column pruning still works."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts shown in place of hidden values.
ID_MASK_TEXT = "XXX-XX-XXXX"      # constant shown for a hidden identifier (tax number)
EMAIL_HIDDEN_TEXT = "****"        # what replaces the hidden part of an address
REDACTED_TEXT = "[REDACTED]"      # unconditional redaction used by policies


def _typed_lit(value, dtype: T.DataType | None) -> Column:
    lit = F.lit(value)
    if dtype is None or isinstance(dtype, T.StringType):
        return lit
    # Keep the column's type; under ANSI an impossible cast fails the query
    # instead of silently becoming NULL.
    return lit.cast(dtype)


def mask_const(col: Column, allowed: Column, text: str, dtype: T.DataType | None = None) -> Column:
    """M1: raw value when ``allowed`` is true, else ``text``. A NULL input also becomes the
    constant when not allowed, so NULL-ness itself is hidden."""
    return F.when(allowed, col).otherwise(_typed_lit(text, dtype))


def mask_null(col: Column, allowed: Column) -> Column:
    """M2: raw value when allowed, else NULL of the column's own type."""
    return F.when(allowed, col)


def mask_email(col: Column) -> Column:
    """M3: partial e-mail mask, not gated by any entitlement.

    NULL -> NULL; no '@' -> '****'; otherwise first character + '****@' + everything
    after the first '@' (a one-letter local part is therefore shown whole).
    """
    at = F.instr(col, "@")
    head = col.substr(F.lit(1), F.lit(1))
    tail = col.substr(at + 1, F.length(col) + 1)
    return (F.when(col.isNull(), F.lit(None).cast("string"))
            .when(at == 0, F.lit(EMAIL_HIDDEN_TEXT))
            .otherwise(F.concat(head, F.lit(EMAIL_HIDDEN_TEXT + "@"), tail)))


def redact(col: Column, text: str = REDACTED_TEXT, dtype: T.DataType | None = None) -> Column:
    """M5: the value is never shown; who is exempt is decided by the policy (EXCEPT)."""
    return _typed_lit(text, dtype)
