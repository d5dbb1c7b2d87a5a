"""Every registered query of the engine with its SQL, by name."""

from __future__ import annotations

from . import driver_queries, evidence_queries, more_queries, source_queries

QUERIES: dict = {**driver_queries.QUERIES, **more_queries.QUERIES, **evidence_queries.QUERIES, **source_queries.QUERIES}
ORACLES: dict = {**driver_queries.ORACLES, **more_queries.ORACLES, **evidence_queries.ORACLES, **source_queries.ORACLES}
