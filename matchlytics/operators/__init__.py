from matchlytics.operators.aggregate import (
    correlation,
    cond_counts,
    cube_levels,
    distinct_by_key,
    grid,
    histogram,
    opponent_total,
    pivot_table,
    rollup_levels,
)
from matchlytics.operators.history import (
    changed_starts,
    check_intervals,
    last_per_day,
    latest,
    scd2,
    scd2_day,
    scd2_merge,
    with_previous,
)
from matchlytics.operators.load import fill_nulls, not_loaded, only_configured, only_date, retract, upsert
from matchlytics.operators.lookup import (
    fallback_lookup,
    join_loss,
    null_safe_lookup,
    temporal_lookup,
)
from matchlytics.operators.ordered import (
    in_order,
    league_position,
    next_value,
    previous_value,
    recent,
    row_index,
    running_total,
    top_k,
)
from matchlytics.operators.playing_time import intervals_played, spans_played
from matchlytics.operators.quality import check_fk, check_rules, check_unique, null_profile, split_rejects, tag_rejects
from matchlytics.operators.shape import flatten, role_rows, standardise, typed

__all__ = [
    "changed_starts",
    "check_fk",
    "check_intervals",
    "check_rules",
    "check_unique",
    "cond_counts",
    "correlation",
    "cube_levels",
    "distinct_by_key",
    "fallback_lookup",
    "fill_nulls",
    "flatten",
    "grid",
    "histogram",
    "in_order",
    "intervals_played",
    "join_loss",
    "last_per_day",
    "latest",
    "league_position",
    "next_value",
    "not_loaded",
    "null_profile",
    "null_safe_lookup",
    "only_configured",
    "only_date",
    "opponent_total",
    "pivot_table",
    "previous_value",
    "recent",
    "role_rows",
    "retract",
    "rollup_levels",
    "row_index",
    "running_total",
    "scd2",
    "scd2_day",
    "scd2_merge",
    "spans_played",
    "split_rejects",
    "standardise",
    "tag_rejects",
    "temporal_lookup",
    "top_k",
    "typed",
    "upsert",
    "with_previous",
]
