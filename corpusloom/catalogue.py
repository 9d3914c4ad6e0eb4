"""All queries of the library by name, and DuckDB SQL with the same result."""

from __future__ import annotations

from corpusloom.operators import corpus_queries, evidence_queries, repair_queries, review_queries

QUERIES = corpus_queries.QUERIES | review_queries.QUERIES | repair_queries.QUERIES | evidence_queries.QUERIES
ORACLES = corpus_queries.ORACLES | review_queries.ORACLES | repair_queries.ORACLES | evidence_queries.ORACLES
