"""Pitch geometry. The pitch is 120 x 80; x grows towards the opponent's goal."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from matchlytics.functions.nested import as_col

# Zone borders and the opponent's penalty box.
BAND_LIMITS = (20, 40, 60, 80, 100)
ROW_LIMITS = (26.6, 53.3)
BOX_X, BOX_Y0, BOX_Y1 = 102, 18, 62
BOX_ZONE = 19


def in_rect(x: Column | str, y: Column | str, x0=BOX_X, y0=BOX_Y0, y1=BOX_Y1) -> Column:
    """``x >= x0 and y0 <= y <= y1``."""
    return (as_col(x) >= x0) & as_col(y).between(y0, y1)


def pitch_zone(x: Column | str, y: Column | str, legacy_null_zone: bool = False) -> Column:
    """Zone 1..18 of a 6 x 3 grid, or 19 inside the box.

    A missing coordinate gives NULL; ``legacy_null_zone`` lets it run through the ladder to the last band or row.
    """
    x, y = as_col(x), as_col(y)

    def passed(c: Column, limits) -> Column:
        # Limits not above the value; `c < limit` is NULL for a NULL value, so that counts as passed.
        return sum(F.when(c < limit, 0).otherwise(1) for limit in limits)

    zone = F.when(in_rect(x, y), BOX_ZONE).otherwise(passed(x, BAND_LIMITS) * 3 + passed(y, ROW_LIMITS) + 1)
    return zone if legacy_null_zone else F.when(x.isNotNull() & y.isNotNull(), zone)
