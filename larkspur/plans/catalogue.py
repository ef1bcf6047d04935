"""Every registered query of the library itself."""

from __future__ import annotations

from larkspur.plans import er_queries, tabular_queries

QUERIES = {**er_queries.QUERIES, **tabular_queries.QUERIES}
ORACLES = {**er_queries.ORACLES, **tabular_queries.ORACLES}
flagship = er_queries.flagship
