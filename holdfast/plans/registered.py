"""All registered queries of the library's own operators, with the SQL that checks them."""

from . import file_queries, model_queries, queries, similarity_queries
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "file_queries", "model_queries", "queries", "similarity_queries"]
