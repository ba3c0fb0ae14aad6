"""Registered queries and the SQL each one is checked against, side by side."""

from . import registry

__all__ = ["registry"]
