"""All registered queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpuslink.plans import linkage_queries, page_queries, prefix_queries, search_queries, source_queries, text_queries

_GROUPS = (search_queries, prefix_queries, text_queries, linkage_queries, page_queries, source_queries)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: query for group in _GROUPS for name, query in group.QUERIES.items()
}
SQL: dict[str, str] = {name: text for group in _GROUPS for name, text in group.SQL.items()}
