"""Registered study queries. Importing this package fills the registry."""

from casebook.plans import bank, delivery, diner, funnel, mart, retail, subscriptions, variants  # noqa: F401
from casebook.plans.registry import DOC, ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE", "DOC"]
