"""Registered queries, each with SQL that gives the same result where SQL can."""

from . import aggregates, calendar, layers, reshape, scalars, shape, table_tests, time, values  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
