"""Every registered query, in the order of the inventory."""

from wardframe.checks.registry import ORACLES, QUERIES
from wardframe.checks import concept_queries, label_queries, operator_queries, source_queries

__all__ = ["ORACLES", "QUERIES"]
