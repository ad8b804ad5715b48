"""Registered queries (Spark) and their independent SQL statements (DuckDB)."""

from .oracle import SQL
from .queries import QUERIES, present

__all__ = ["QUERIES", "SQL", "present"]
