"""Registered queries over the test tables, each with SQL that must agree."""

from threadloom.checks import (  # noqa: F401  (importing registers the queries)
    enrichment_queries,
    message_queries,
    table_queries,
    thread_queries,
    vector_queries,
)
