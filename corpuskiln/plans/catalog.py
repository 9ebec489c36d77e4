"""The registry of every query."""

from __future__ import annotations

from corpuskiln.plans import table_queries, text_queries
from corpuskiln.plans.registry import Registry

REGISTRY = Registry()
for part in (text_queries.R, table_queries.R):
    for name, query in part.queries.items():
        REGISTRY.add(name, part.sql.get(name))(query)
