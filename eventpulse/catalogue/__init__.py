"""Queries over the supplied tables, each with SQL that gives the same rows."""

from . import check_queries, file_queries, model_queries, operator_queries, source_queries, warehouse_queries  # noqa: F401
from .base import ORACLES, QUERIES  # noqa: F401
