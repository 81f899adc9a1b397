"""Imports every module of named queries, so that the registry is complete."""

from slicemill.plans import compare_queries, elt_queries, history_queries, mart_queries, quality_queries, source_queries, table_queries  # noqa: F401
from slicemill.plans.registry import COVERS, ORACLE, QUERIES  # noqa: F401
