"""Payments, customer and risk analytics on Spark DataFrames."""

from ledgerlens.plans.workspace import Workspace
from ledgerlens.session import build_session, configure

__all__ = ["Workspace", "build_session", "configure"]
