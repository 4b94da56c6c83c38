"""The promotion mart and the registered queries."""

from __future__ import annotations


def all_queries():
    from . import queries_constructs, queries_mart  # noqa: F401
    from .registry import QUERIES

    return QUERIES
