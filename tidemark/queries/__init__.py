"""Registered queries over the sample tables, each with its SQL counterpart."""

from tidemark.queries.registry import ORACLE, QUERIES  # noqa: F401
