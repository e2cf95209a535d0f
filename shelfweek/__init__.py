"""Retail weekly facts, reports and inbound stock tracking as PySpark DataFrame functions."""

from shelfweek.sources.tables import Sources

__all__ = ["Sources"]
