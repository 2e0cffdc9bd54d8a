"""Bindings of every operator to the given tables, with the SQL that must give the same rows."""

from __future__ import annotations

from workloads.registry import ORACLES, QUERIES
from workloads import facts, files, lookup, pipeline, sales, scalars, serving, spatial  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
