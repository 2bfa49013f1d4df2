"""All registered queries of the reference operators and their SQL counterparts."""

from __future__ import annotations

from . import check_queries, claim_queries, concept_queries, control_queries, document_queries, graph_queries, lake_queries, page_queries, search_queries, text_queries

_PARTS = (text_queries, concept_queries, claim_queries, graph_queries, control_queries, document_queries, search_queries, lake_queries, check_queries, page_queries)

QUERIES = {k: f for part in _PARTS for k, f in part.QUERIES.items()}
ORACLES = {k: sql for part in _PARTS for k, sql in part.ORACLES.items()}
