"""The registered queries, by subject: each module has QUERIES and ORACLES."""

from __future__ import annotations

from importlib import import_module

MODULES = ("market", "ops", "checks", "streams", "more", "landing", "extra", "timed", "found", "rest")


def _all(attribute: str) -> dict:
    found: dict = {}
    for name in MODULES:
        found |= getattr(import_module(f"{__name__}.{name}"), attribute)
    return found


def queries() -> dict:
    return _all("QUERIES")


def oracle_sql() -> dict:
    return _all("ORACLES")
