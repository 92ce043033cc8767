"""The registered queries over the test tables, and their SQL oracles."""

from tallystream.plans.oracle import ORACLE_SQL
from tallystream.plans.queries import QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
