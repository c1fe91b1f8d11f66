"""The named queries over the driver tables."""

from __future__ import annotations

from . import entries, pages, replies, sequences
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "entries", "pages", "replies", "sequences"]
