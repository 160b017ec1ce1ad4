"""Registered queries by area, each with an SQL counterpart where one exists."""

from __future__ import annotations

from importlib import import_module

AREAS = ["flows", "relational", "corpus", "lint", "evaluation", "metadata", "requests", "streams"]


def _collect(attribute: str) -> dict:
    merged: dict = {}
    for area in AREAS:
        merged.update(getattr(import_module(f"flowspark.catalog.{area}"), attribute))
    return merged


def queries() -> dict:
    return _collect("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _collect("ORACLE")
