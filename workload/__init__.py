"""The registered queries, by area, each with the SQL that gives the same rows."""

from __future__ import annotations

from importlib import import_module

QUERIES: dict = {}
ORACLES: dict = {}
for _area in ("ingest", "catalog", "discovery", "semantic", "runs", "index"):
    _module = import_module(f"workload.{_area}")
    QUERIES |= _module.QUERIES
    ORACLES |= _module.ORACLES
