"""All registered queries."""

from finledger.registry import bank, details, operations, payments, stored, streams  # noqa: F401
from finledger.registry.core import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
