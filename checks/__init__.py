"""Queries over the supplied tables, one per operator, each with its DuckDB twin where SQL can say it."""

from .base import CHECKS  # noqa: F401
from . import families, scans, structures, tables, trades, windowing  # noqa: F401,E402
