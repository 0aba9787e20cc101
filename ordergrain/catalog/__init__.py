"""The registered queries over the test tables, each with its SQL counterpart."""

from __future__ import annotations


def all_queries():
    """Name to query, in the order of registration."""
    from ordergrain.catalog import analytics, model, relational  # noqa: F401  (they register)
    from ordergrain.catalog.registry import QUERIES

    return dict(QUERIES)
