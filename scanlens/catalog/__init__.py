"""Registered queries with the SQL each one is checked against."""

from __future__ import annotations

from importlib import import_module

from scanlens.catalog.registry import ORACLES, QUERIES

for _name in ("prep", "aggregates", "evaluation", "logs", "learning", "streams", "sources"):
    import_module(f"scanlens.catalog.{_name}")

__all__ = ["QUERIES", "ORACLES"]
