"""Queries over the driver's tables, one or more per operator, with equivalent SQL."""

from __future__ import annotations

from annoforge.plans import curation, decisions, detector, releases

_parts = [detector, curation, decisions, releases]

QUERIES: dict = {name: query for part in _parts for name, query in part.QUERIES.items()}
ORACLES: dict[str, str] = {name: sql for part in _parts for name, sql in part.ORACLES.items()}
