"""All registered queries."""

from checks import ingest_checks, payments_checks, risk_checks, warehouse_checks  # noqa: F401
from checks.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
