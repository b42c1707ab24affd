"""Every operator as a named query with the SQL that checks it."""

from . import aggregates, columns, jobs, joins, pandas_api, quality, storage, udfs, windows  # noqa: F401
from .registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
