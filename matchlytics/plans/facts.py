"""The event fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from matchlytics.functions import clock_seconds, coalesce_leaf, date_key, first_point, hash_key, null_outside, pitch_zone
from matchlytics.functions import values as V
from matchlytics.operators import flatten, null_safe_lookup, tag_rejects, temporal_lookup, typed


def flat_events(events: DataFrame, legacy_null_zone: bool = False) -> DataFrame:
    """Raw events as flat, cleaned columns with their natural keys and zones."""
    end_x, end_y = first_point("pass.end_location", "shot.end_location", "carry.end_location", "goalkeeper.end_location")
    flat = flatten(
        events,
        {
            "event_id": "id",
            "match_natural_id": F.col("match_id").cast("string"),
            "index": "index",
            "team_natural_id": F.col("team.id").cast("string"),
            "player_natural_id": F.col("player.id").cast("string"),
            "event_type": "type.name",
            "outcome": coalesce_leaf(events, "outcome.name"),
            "play_pattern_id": F.col("play_pattern.id").cast("int"),
            "location_x": ("location", 0),
            "location_y": ("location", 1),
            "end_location_x": end_x,
            "end_location_y": end_y,
            "period": F.col("period").cast("int"),
            "minute": F.col("minute").cast("int"),
            "second": F.col("second").cast("int"),
            "event_relative_time": clock_seconds("timestamp", V.MAX_CLOCK_SECONDS),
            "duration": null_outside("duration", 0, V.MAX_DURATION),
            "under_pressure": "under_pressure",
            "pass_length": "pass.length",
            "pass_angle": "pass.angle",
            "shot_xg": "shot.statsbomb_xg",
            "possession_id": F.col("possession").cast("string"),
        },
    )
    return flat.withColumns(
        {
            "location_id": pitch_zone("location_x", "location_y", legacy_null_zone),
            "end_location_id": pitch_zone("end_location_x", "end_location_y", legacy_null_zone),
        }
    )


# Stored precision of the measurements.
DECIMALS = {
    "location_x": "decimal(5,2)",
    "location_y": "decimal(5,2)",
    "end_location_x": "decimal(5,2)",
    "end_location_y": "decimal(5,2)",
    "event_relative_time": "decimal(10,3)",
    "duration": "decimal(10,3)",
    "pass_length": "decimal(6,2)",
    "pass_angle": "decimal(6,4)",
    "shot_xg": "decimal(6,4)",
}
# The columns of the event fact.
FACT_EVENT = [
    "event_id",
    "date_id",
    "match_sk",
    "team_sk",
    "player_sk",
    "event_type_sk",
    "play_pattern_sk",
    "location_id",
    "end_location_id",
    "location_x",
    "location_y",
    "end_location_x",
    "end_location_y",
    "period",
    "minute",
    "second",
    "event_relative_time",
    "duration",
    "under_pressure",
    "pass_length",
    "pass_angle",
    "shot_xg",
    "possession_id",
]


# An event lacking one of these keeps its row, with the reason in ``reject_reason``.
REQUIRED_KEYS = ("match_sk", "team_sk", "event_type_sk")
NATURAL_KEYS = ["match_natural_id", "team_natural_id", "player_natural_id"]


def event_keys(flat: DataFrame, match_dim: DataFrame, team_dim: DataFrame, player_dim: DataFrame) -> DataFrame:
    """(match, team, player) as they occur together, with day and surrogate keys; those of unknown matches are left out.

    A match of thousands of events has a few dozen such keys, and only they meet the versions of the dimensions.
    """
    matches = match_dim.select("match_natural_id", "match_sk", "match_date")
    keys = flat.select(*NATURAL_KEYS).distinct().join(matches, "match_natural_id")
    keys = temporal_lookup(keys, team_dim, ["team_natural_id"], "match_date", ["team_sk"])
    keys = temporal_lookup(keys, player_dim, ["player_natural_id"], "match_date", ["player_sk"])
    return keys.withColumn("date_id", date_key("match_date")).where(F.col("date_id").isNotNull()).drop("match_date")


def _member(rows: DataFrame, dim: DataFrame, key: str, of: list[str]) -> DataFrame:
    """Adds the hashed key of the columns ``of`` where the dimension holds it, else NULL."""
    known = dim.select(F.col(key).alias("__known"))
    hashed = rows.withColumn("__hash", hash_key(*of))
    return hashed.join(known, F.col("__hash") == F.col("__known"), "left").withColumnRenamed("__known", key).drop("__hash")


def unmatched(natural: Column, found: str) -> Column:
    """How many rows have a natural key that the lookup did not find."""
    return F.count_if(natural.isNotNull() & F.col(found).isNull())


def fact_event(
    events: DataFrame,
    match_dim: DataFrame,
    team_dim: DataFrame,
    player_dim: DataFrame,
    event_type_dim: DataFrame,
    play_pattern_dim: DataFrame,
    legacy_null_zone: bool = False,
    loss: Observation | None = None,
) -> DataFrame:
    """Events with surrogate keys. Events of unknown matches are left out; other unknown keys stay NULL.

    ``reject_reason`` names the required keys that are missing and the measurements that were too wide for their type, or is
    NULL. Versions are looked up once for each (match, team, player) that occurs, so that events meet only equality joins.
    ``loss`` receives the events and, for each lookup, those whose key it did not find, when the rows are first used.
    """
    flat = flat_events(events, legacy_null_zone)
    keys = event_keys(flat, match_dim, team_dim, player_dim)
    facts = null_safe_lookup(flat, keys, NATURAL_KEYS, ["date_id", "match_sk", "team_sk", "player_sk"])
    facts = facts.where(F.col("date_id").isNotNull())
    facts = _member(facts, event_type_dim, "event_type_sk", ["event_type", "outcome"])
    facts = _member(facts, play_pattern_dim.dropna(subset=["play_pattern_id"]), "play_pattern_sk", ["play_pattern_id"])
    if loss is not None:
        natural = {"team": "team_natural_id", "player": "player_natural_id", "event_type": "event_type", "play_pattern": "play_pattern_id"}
        lost = [unmatched(F.col(c), f"{name}_sk").alias(name) for name, c in natural.items()]
        facts = facts.observe(loss, F.count("*").alias("rows"), *lost)
    facts = facts.withColumns({f"__given_{c}": F.col(c).isNotNull() for c in DECIMALS})
    rules = {key: F.col(key).isNotNull() for key in REQUIRED_KEYS}
    rules |= {f"{c} too wide": ~F.col(f"__given_{c}") | F.col(c).isNotNull() for c in DECIMALS}
    return tag_rejects(typed(facts, DECIMALS), rules).select(*FACT_EVENT, "reject_reason")
