"""Registered queries: one per operator of the inventory, each with a DuckDB oracle
where the operator is expressible in SQL."""

from __future__ import annotations

from . import classification, governance, privileges, protection

_MODULES = [protection, governance, privileges, classification]


def all_queries() -> dict:
    out: dict = {}
    for m in _MODULES:
        out.update(m.QUERIES)
    return out


def all_oracles() -> dict:
    out: dict = {}
    for m in _MODULES:
        out.update(m.ORACLES)
    return out
