"""All queries of the timeline engine: name → DataFrame function, name → DuckDB SQL."""

from __future__ import annotations

from chronomark.plans import aggregates, buckets, classes, features, formats, io, joins, overlays, projections, reports, rules, text, windows  # noqa: F401  they register their queries
from chronomark.plans._base import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
