"""All named queries, grouped by what they are about; importing this package registers them."""

from tidemark.catalog import casebook, checks, lakes, relational, runs, star, streams  # noqa: F401
from tidemark.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
