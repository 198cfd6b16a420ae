"""Ratios and results."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from matchlytics.functions.nested import as_col


def rate(part: Column | str, whole: Column | str, scale: float = 1) -> Column:
    """``part / whole * scale``, NULL for an empty whole."""
    return F.try_divide(as_col(part), as_col(whole)) * F.lit(scale)


def per90(total: Column | str, minutes: Column | str) -> Column:
    return rate(total, minutes, 90)


def padj(total: Column | str, minutes: Column | str, own_possession: Column | str, opponent_possession: Column | str) -> Column:
    """Per-90 value scaled by the opponent's share of the ball over one's own."""
    return per90(total, minutes) * F.try_divide(as_col(opponent_possession), as_col(own_possession))


def match_result(scored: Column | str, conceded: Column | str) -> Column:
    scored, conceded = as_col(scored), as_col(conceded)
    return F.when(scored > conceded, "W").when(scored < conceded, "L").otherwise("D")


def safe_sum(c: Column | str, type: str = "decimal(28,6)", limit: float | None = None) -> Column:
    """Sum in exact decimals; NULL counts as 0, as does a value beyond ``limit`` in size.

    Without a limit every value counts: one that does not fit ``type`` fails the job rather than being left out.
    """
    c = as_col(c)
    value = c if limit is None else F.when(F.abs(c) <= limit, c)
    return F.sum(F.coalesce(value.cast(type), F.lit(0).cast(type)))
