"""Registered queries: each operator over whole tables, next to the SQL it must agree with."""

from __future__ import annotations

from tidemark.queries.registry import SQL, QUERIES

from tidemark.queries import diffing, fields, ingesting, lakes, reconciling, shaping, writing  # noqa: F401  (they register)

__all__ = ["QUERIES", "SQL"]
