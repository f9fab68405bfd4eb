"""Queries over the driver's tables, one for each operator, and the SQL that gives the same rows."""

from __future__ import annotations

from veritrail.plans import attach_queries, corpus_queries, graph_queries, log_queries, recovery_queries, rule_queries

MODULES = (log_queries, graph_queries, corpus_queries, recovery_queries, rule_queries, attach_queries)
QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
ORACLES = {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
