"""Registered queries: each runs an operator over the given tables, beside the SQL
that must return the same rows."""

from starloom.catalog.registry import REGISTRY, Query

# Importing a family registers its queries.
from starloom.catalog import (  # noqa: E402,F401
    aggregates,
    checks,
    joining,
    layered,
    music,
    scalars,
    shaping,
    storage,
    staging,
)

__all__ = ["REGISTRY", "Query"]
