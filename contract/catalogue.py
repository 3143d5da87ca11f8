"""All queries."""

from contract import function_queries, job_queries, layer_queries, operator_queries  # noqa: F401
from contract.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
