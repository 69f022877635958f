"""Registered queries: each reads the given tables and, where SQL can say it, has a twin in SQL."""

from snapledger.queries import (  # noqa: F401
    assembly, catalog, geometry, identity, ledger, pages, reads, scalars, storage, streams, warehouse,
)
from snapledger.queries.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
