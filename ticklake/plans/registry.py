"""All queries over the given tables, and the SQL that checks them."""

from __future__ import annotations

from ticklake.plans import file_queries, history_queries, lake_queries, more_queries, store_queries, stream_queries, tape_queries

PARTS = (tape_queries, history_queries, lake_queries, more_queries, store_queries, file_queries, stream_queries)
QUERIES: dict = {name: query for part in PARTS for name, query in part.QUERIES.items()}
SQL: dict[str, str] = {name: text for part in PARTS for name, text in part.SQL.items()}
