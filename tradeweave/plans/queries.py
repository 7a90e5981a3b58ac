"""All registered queries of the library, without those of the llm subpackage."""

from . import audit_queries, learning_queries, mapping_queries, scalar_queries  # noqa: F401  they register
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
