"""Registered queries of the numbered operators, each over its whole table."""

from __future__ import annotations

from importlib import import_module

MODULES = [
    "mixing", "importance", "mtree", "sharding", "simple8b", "packing", "oddsketch", "linecrf", "bloomlm", "hosts", "convrepair",
    "bwtspans", "divergence",
]


def _parts() -> list:
    return [import_module(f"flowspark.llm.queries.{m}") for m in MODULES]


def queries() -> dict:
    return {p.NAME: p.query for p in _parts()}


def oracle_sql() -> dict[str, str]:
    return {p.NAME: p.SQL for p in _parts() if p.SQL}
