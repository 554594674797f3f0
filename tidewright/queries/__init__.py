"""Registered queries: each operator on the given tables, with SQL that gives the same rows."""

from tidewright.queries.registry import ORACLE, QUERIES
from tidewright.queries import (  # noqa: F401  (each module registers its queries)
    boxes,
    clicks,
    loads,
    models,
    ranking,
    relational,
    scalars,
    streams,
    tabular,
    vectors,
)

__all__ = ["ORACLE", "QUERIES"]
