"""The declared constraints of the warehouse, checked over its tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from matchlytics.operators import check_fk, check_intervals, check_rules, check_unique, null_profile

# Keys that identify a row.
UNIQUE = {
    "dim_date": ["date_id"],
    "dim_team": ["team_sk"],
    "dim_player": ["player_sk"],
    "dim_match": ["match_sk"],
    "dim_event_type": ["event_type_sk"],
    "dim_play_pattern": ["play_pattern_sk"],
    "dim_location": ["location_id"],
    "fact_event": ["event_id"],
    "fact_player_match_stats": ["player_sk", "match_sk"],
    "fact_team_match_stats": ["team_sk", "match_sk"],
    "fact_player_season_stats": ["player_sk", "season", "team_sk"],
}
# References as {table: {column: (parent, its column)}}.
REFERENCES = {
    "dim_match": {"home_team_sk": ("dim_team", "team_sk"), "away_team_sk": ("dim_team", "team_sk")},
    "fact_event": {
        "date_id": ("dim_date", "date_id"),
        "match_sk": ("dim_match", "match_sk"),
        "team_sk": ("dim_team", "team_sk"),
        "player_sk": ("dim_player", "player_sk"),
        "event_type_sk": ("dim_event_type", "event_type_sk"),
        "play_pattern_sk": ("dim_play_pattern", "play_pattern_sk"),
        "location_id": ("dim_location", "location_id"),
        "end_location_id": ("dim_location", "location_id"),
    },
    "fact_player_match_stats": {
        "date_id": ("dim_date", "date_id"),
        "player_sk": ("dim_player", "player_sk"),
        "match_sk": ("dim_match", "match_sk"),
        "team_sk": ("dim_team", "team_sk"),
    },
    "fact_team_match_stats": {
        "date_id": ("dim_date", "date_id"),
        "team_sk": ("dim_team", "team_sk"),
        "opponent_team_sk": ("dim_team", "team_sk"),
        "match_sk": ("dim_match", "match_sk"),
    },
    "fact_player_season_stats": {"player_sk": ("dim_player", "player_sk"), "team_sk": ("dim_team", "team_sk")},
}
# Columns that must be filled.
NOT_NULL = {
    "dim_date": ["date_value"],
    "fact_event": ["date_id", "match_sk", "team_sk", "event_type_sk"],
    "fact_player_match_stats": ["date_id", "player_sk", "match_sk", "team_sk"],
    "fact_team_match_stats": ["date_id", "team_sk", "opponent_team_sk", "match_sk"],
    "fact_player_season_stats": ["player_sk", "team_sk", "season"],
}
VERSIONED = {"dim_team": "team_natural_id", "dim_player": "player_natural_id"}


def _rules() -> dict:
    return {
        "fact_player_match_stats": {"minutes_not_negative": F.col("minutes_played") >= 0},
        "fact_team_match_stats": {
            "possession_in_percent": F.col("possession_pct").between(0, 100),
            "known_result": F.col("result").isin("W", "D", "L"),
        },
        "dim_team": {"team_name_length": F.length("team_name") <= 255},
        "dim_player": {"player_name_length": F.length("player_name") <= 255},
    }


def violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, rule, violations`` for every constraint of the given tables, by table name."""

    def named(df: DataFrame, table: str, rule, count) -> DataFrame:
        return df.select(F.lit(table).alias("table_name"), rule.alias("rule"), count.alias("violations"))

    found = []
    for table, df in tables.items():
        if table in UNIQUE:
            repeated = check_unique(df, UNIQUE[table]).agg(F.count("*").alias("n"))
            found.append(named(repeated, table, F.lit("unique"), F.col("n")))
        parents = {
            column: (tables[parent], {column: key})
            for column, (parent, key) in REFERENCES.get(table, {}).items()
            if parent in tables
        }
        if parents:
            orphans = check_fk(df, parents)
            found.append(named(orphans, table, F.concat(F.lit("reference "), "reference"), F.col("unmatched_rows")))
        if table in NOT_NULL:
            nulls = null_profile(df, NOT_NULL[table])
            found.append(named(nulls, table, F.concat(F.lit("filled "), "column"), F.col("nulls")))
        if table in _rules():
            broken = check_rules(df, _rules()[table])
            found.append(named(broken, table, F.col("rule"), F.col("violations")))
        if table in VERSIONED:
            overlaps = check_intervals(df, VERSIONED[table]).agg(F.count("*").alias("n"))
            found.append(named(overlaps, table, F.lit("intervals"), F.col("n")))
    return reduce(DataFrame.unionByName, found)
