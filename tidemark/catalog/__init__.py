"""All registered queries."""

from tidemark.catalog.base import spark_queries, sql_queries
from tidemark.catalog import panel_queries, model_queries  # noqa: F401

__all__ = ["spark_queries", "sql_queries"]
