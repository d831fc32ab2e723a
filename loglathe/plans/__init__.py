"""End-to-end queries over the given tables, and their SQL counterparts."""

from .catalog import QUERIES
from .oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]
