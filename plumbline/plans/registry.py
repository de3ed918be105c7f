"""Every query by name, with the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from plumbline.plans import kpi_queries, order_queries, source_queries, table_queries, version_queries  # noqa: F401  each registers its queries

QUERIES = kpi_queries.QUERIES
ORACLES = kpi_queries.ORACLES
