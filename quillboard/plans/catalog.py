"""All registered queries, the SQL of those that have one, and those that have none."""

from __future__ import annotations

from quillboard.plans import board_queries, check_queries, corpus_queries, dating_queries, deadline_queries, gate_queries, grounding_queries, json_queries, oracles, page_queries, queries, record_queries, registry, screen_queries, selection_queries, stream_queries  # noqa: F401

QUERIES = queries.QUERIES | registry.QUERIES
ORACLES = oracles.ORACLES | registry.ORACLES
WITHOUT_SQL = oracles.WITHOUT_SQL | registry.WITHOUT_SQL
