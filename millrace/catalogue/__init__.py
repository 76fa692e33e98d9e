"""Registered queries over the driver tables, each with its SQL twin."""

from . import checks, files, marts, observe, rows, streams  # noqa: F401
from .registry import CATALOGUE, Query

__all__ = ["CATALOGUE", "Query"]
