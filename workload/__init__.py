"""Queries over the given test tables, each with its SQL check."""

from workload import files, functions, products, relational  # noqa: F401
from workload.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
