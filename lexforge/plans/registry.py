"""All queries of the core library and their SQL oracles."""

from __future__ import annotations

from lexforge.plans import corpus, function_queries, records_queries, search_queries

QUERIES: dict = {}
ORACLE: dict = {}
for _module in (corpus, records_queries, search_queries, function_queries):
    QUERIES.update(_module.QUERIES)
    ORACLE.update(_module.ORACLE)
