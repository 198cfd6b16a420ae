"""Birth years from a reference table of names."""

from __future__ import annotations

from pyspark.sql import DataFrame

from matchlytics.functions import short_name
from matchlytics.functions import values as V
from matchlytics.operators import fallback_lookup


def enrich_birth_year(player_dim: DataFrame, people: DataFrame) -> DataFrame:
    """Fills missing birth years from ``people(name, birth_year)``: by full name, else by first and last word."""
    filled = fallback_lookup(
        player_dim,
        people,
        ["player_name", short_name("player_name")],
        "name",
        "birth_year",
        "birth_year",
        V.BIRTH_YEARS,
    )
    return filled.select(*player_dim.columns)
