"""Queries over the driver's tables, each with the SQL that must give the same rows."""

from checks.registry import ORACLES, QUERIES
from checks import history, match_data, measures, quality, scalars, windows  # noqa: F401  (each registers its queries)

__all__ = ["ORACLES", "QUERIES"]
