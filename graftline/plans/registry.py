"""Every registered query of the graph engine and the SQL it is checked against."""

from __future__ import annotations

from . import building_queries, file_queries, format_queries, graph_queries, queries  # noqa: F401 (importing registers its queries)

QUERIES = dict(queries.QUERIES)
ORACLE_SQL = dict(queries.ORACLE_SQL)
