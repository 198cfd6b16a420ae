"""Time between entering and leaving."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def spans_played(
    moves: DataFrame, ends: DataFrame, group: Sequence[str], member: Sequence[str], extra: Mapping[str, Column] | None = None
) -> DataFrame:
    """``minutes_played`` per group member: from ``entry_min`` to the earliest ``exit_min``, else the group's ``end_min``.

    A row of ``moves`` is an entry or an exit, the other minute being NULL. Members without an entry are left out, and
    an exit before the entry counts as zero. All moves meet in one aggregation, so several exits of a member cannot
    multiply rows. ``extra`` aggregates of the moves come along.
    """
    extra = extra or {}
    keys = [*group, *member]
    spans = (
        moves.groupBy(*keys)
        .agg(F.min("entry_min").alias("entry_min"), F.min("exit_min").alias("exit_min"), *[c.alias(n) for n, c in extra.items()])
        .where(F.col("entry_min").isNotNull())
    )
    minutes = F.coalesce("exit_min", "end_min") - F.col("entry_min")
    return spans.join(ends.select(*group, "end_min"), list(group)).select(
        *keys, F.greatest(F.lit(0), minutes).cast("int").alias("minutes_played"), *extra
    )


def intervals_played(
    entries: DataFrame, exits: DataFrame, ends: DataFrame, group: Sequence[str], member: Sequence[str]
) -> DataFrame:
    """``spans_played`` of entries and exits that come as separate tables."""
    keys = [*group, *member]
    moves = entries.select(*keys, "entry_min").unionByName(exits.select(*keys, "exit_min"), allowMissingColumns=True)
    return spans_played(moves, ends, group, member)
