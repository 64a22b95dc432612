"""Queries over the driver's tables, and the SQL that checks them."""

from .corpus import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
