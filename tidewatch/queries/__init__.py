"""All registered queries and their SQL twins."""

from __future__ import annotations


def all_queries():
    from tidewatch.queries import drifts, learning, mining, modeling, registry, tables  # noqa: F401

    return dict(registry.QUERIES), dict(registry.ORACLE)
