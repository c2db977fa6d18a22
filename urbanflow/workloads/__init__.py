"""The registered queries: the library applied to the given tables, each next to its SQL."""

from .registry import ORACLES, QUERIES
from . import audits, loads, objects, series, tables  # noqa: F401  (registers the queries)

__all__ = ["ORACLES", "QUERIES"]
