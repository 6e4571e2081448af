"""Registered queries, each with the SQL it must agree with."""

from . import builds, checks, documents, edits, keys, relations, reports, scalars, shapes, storage  # noqa: F401
from .base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
