"""Registered queries of the card engine, and their SQL for DuckDB."""

from __future__ import annotations

from . import queries_archives, queries_sets, queries_streams, queries_text

QUERIES = queries_text.QUERIES | queries_sets.QUERIES | queries_archives.QUERIES | queries_streams.QUERIES
ORACLES = queries_text.ORACLES | queries_sets.ORACLES | queries_archives.ORACLES | queries_streams.ORACLES
