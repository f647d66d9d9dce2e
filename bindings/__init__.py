"""Queries over the test tables, each next to the SQL that must give the same rows."""

from bindings import evaluation, features, jobs, models, quality, regularize, signals, sources, tables  # noqa: F401
from bindings.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
