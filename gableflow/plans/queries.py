"""All queries of the catalogue, and their DuckDB SQL."""

from __future__ import annotations

from . import catalogue_jobs  # noqa: F401  registers its queries
from .catalogue import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
