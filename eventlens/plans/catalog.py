"""Everything the driver contract exposes: query functions and oracle SQL."""

from __future__ import annotations

from eventlens.plans import incremental_queries, ingest_queries, oracle_sql, queries, view_queries


def query_functions() -> dict:
    out = dict(queries.all_queries())
    out.update(ingest_queries.all_queries())
    out.update(view_queries.all_queries())
    out.update(incremental_queries.all_queries())
    return out


def oracle_statements() -> dict[str, str]:
    statements = dict(oracle_sql.all_sql())
    statements.update(oracle_sql.all_view_sql())
    names = set(query_functions())
    return {k: v for k, v in statements.items() if k in names}
