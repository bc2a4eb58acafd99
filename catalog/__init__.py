"""Queries over the given tables, each with the SQL that states its result."""

from catalog import checks, declared, health, layers, maintenance, marts, reports, reshape, scalars, streams, windows
from catalog.base import QUERIES

__all__ = ["QUERIES"]
