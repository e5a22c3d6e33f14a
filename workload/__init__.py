"""The registered queries, each with the SQL that must give the same rows."""

from .registry import ORACLES, QUERIES
from . import scans, sinks, edits, joins, aggregates, columns, plans  # noqa: F401

__all__ = ["QUERIES", "ORACLES"]
