"""Queries by name, and the SQL that gives the same rows."""

from __future__ import annotations

from . import pages, relational, textual

QUERIES = {**relational.QUERIES, **textual.QUERIES, **pages.QUERIES}
ORACLES = {**relational.ORACLES, **textual.ORACLES, **pages.ORACLES}
