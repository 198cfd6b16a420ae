"""Dimensions of the match warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from matchlytics.functions import classify_in, classify_like, coalesce_leaf, date_key, field, hash_key
from matchlytics.functions import values as V
from matchlytics.functions.pitch import BAND_LIMITS, BOX_ZONE
from matchlytics.operators import distinct_by_key, fill_nulls, flatten, role_rows, scd2, scd2_day, scd2_merge, temporal_lookup
from matchlytics.operators.history import OPEN_END

TEAM_VERSIONS = {
    "key": "team_natural_id",
    "day": "match_date",
    "tracked": ["manager_name", "team_name"],
    "attrs": ["home_stadium"],
    "tie": "match_id",
}
PLAYER_VERSIONS = {
    "key": "player_natural_id",
    "day": "match_date",
    "tracked": ["team_id"],
    "attrs": ["player_name", "nationality", "specific_position", "team_name"],
    "tie": "match_id",
}


def date_dim(df: DataFrame, column: str = "match_date") -> DataFrame:
    """One row per day that occurs."""
    day = F.col("date_value")
    return (
        df.select(F.to_date(column).alias("date_value"))
        .where(day.isNotNull())
        .distinct()
        .select(
            date_key(day).alias("date_id"),
            day,
            F.year(day).alias("year"),
            F.month(day).alias("month"),
            F.dayofmonth(day).alias("day"),
            F.dayofweek(day).isin(1, 7).alias("is_weekend"),
        )
        .orderBy("date_value")
    )


def zone_dim(spark: SparkSession) -> DataFrame:
    """The 19 zones that ``pitch_zone`` assigns, named after the grid, with the names in use before."""
    thirds, flanks = ("Defensive", "Middle", "Attacking"), ("Left", "Center", "Right")
    borders = (0, *BAND_LIMITS, 120)
    rows = []
    for zone, legacy in enumerate(V.LEGACY_ZONES, start=1):
        band, row = divmod(zone - 1, 3)
        name = (
            "Penalty Box"
            if zone == BOX_ZONE
            else f"Zone {zone} ({thirds[band // 2]} {flanks[row]} {borders[band]}-{borders[band + 1]})"
        )
        rows.append((zone, name, zone in V.BOX_ZONES, legacy))
    return spark.createDataFrame(rows, "location_id int, field_zone string, is_box boolean, legacy_name string")


def event_type_dim(events: DataFrame, event_type="type.name", outcome=None, categories=V.EVENT_CATEGORIES) -> DataFrame:
    """Distinct (category, type, outcome)."""
    outcome = coalesce_leaf(events, "outcome.name") if outcome is None else outcome
    kind = field(event_type)
    return (
        events.select(
            classify_in(kind, categories).alias("event_category"), kind.alias("event_type"), outcome.alias("outcome")
        )
        .distinct()
        .select(hash_key("event_type", "outcome").alias("event_type_sk"), "*")
    )


def play_pattern_dim(events: DataFrame) -> DataFrame:
    """One name per play pattern id."""
    named = events.select(
        F.col("play_pattern.id").cast("int").alias("play_pattern_id"), F.col("play_pattern.name").alias("play_pattern_name")
    )
    patterns = distinct_by_key(named, "play_pattern_id", "play_pattern_name")
    return patterns.select(hash_key("play_pattern_id").alias("play_pattern_sk"), "*")


def team_observations(matches: DataFrame) -> DataFrame:
    """Each side of each match: name, first manager, and the ground when at home."""

    def side(team: str, stadium) -> dict:
        return {
            "team_natural_id": F.col(f"{team}_team.{team}_team_id").cast("string"),
            "team_name": F.col(f"{team}_team.{team}_team_name"),
            "manager_name": field((f"{team}_team.managers", 0, "name")),
            "home_stadium": stadium,
        }

    roles = {"home": side("home", F.col("stadium.name")), "away": side("away", F.lit(None).cast("string"))}
    return (
        role_rows(matches, roles, ["match_id", "match_date"])
        .withColumn("match_date", F.to_date("match_date"))
        .where(F.col("team_natural_id").isNotNull())
    )


def _teams(versions: DataFrame) -> DataFrame:
    return versions.select(
        hash_key("team_natural_id", "effective_from").alias("team_sk"),
        "team_natural_id",
        F.col("team_name").alias("kaggle_team_name"),
        "team_name",
        "manager_name",
        "home_stadium",
        "effective_from",
        "effective_to",
        "is_current",
    )


def team_dim(matches: DataFrame) -> DataFrame:
    """Versions of each team, a new one when its manager or its name changes."""
    return _teams(scd2(team_observations(matches), **TEAM_VERSIONS))


def team_dim_merge(existing: DataFrame, history: DataFrame, incoming: DataFrame) -> DataFrame:
    """``existing`` after ``incoming`` matches, given the ``history`` of all matches."""
    return _teams(scd2_merge(existing, team_observations(history), team_observations(incoming), **TEAM_VERSIONS))


def team_dim_day(existing: DataFrame, at: str, touched: DataFrame, matches: DataFrame, later: DataFrame) -> DataFrame:
    """``existing`` once the day ``at`` holds just ``matches``; ``later`` are the matches after it."""
    return _teams(scd2_day(existing, at, touched, team_observations(matches), team_observations(later), **TEAM_VERSIONS))


def player_observations(lineups: DataFrame, matches: DataFrame) -> DataFrame:
    """Each listed player of each match: team, name, nationality and first position."""
    days = matches.select("match_id", F.to_date("match_date").alias("match_date"))
    listed = lineups.select("match_id", "team_id", "team_name", F.explode("lineup").alias("p"))
    return flatten(
        listed,
        {
            "match_id": "match_id",
            "team_id": "team_id",
            "team_name": "team_name",
            "player_natural_id": F.col("p.player_id").cast("string"),
            "player_name": "p.player_name",
            "nationality": "p.country.name",
            "specific_position": ("p.positions", 0, "position"),
        },
    ).where(F.col("player_natural_id").isNotNull()).join(days, "match_id")


def _players(versions: DataFrame, groups) -> DataFrame:
    return versions.select(
        hash_key("player_natural_id", "effective_from").alias("player_sk"),
        "player_natural_id",
        "player_name",
        F.col("player_name").alias("kaggle_name"),
        "nationality",
        classify_like("specific_position", groups).alias("position_group"),
        "specific_position",
        "team_id",
        "team_name",
        F.lit(None).cast("int").alias("birth_year"),
        "effective_from",
        "effective_to",
        "is_current",
    )


def player_dim(lineups: DataFrame, matches: DataFrame, position_groups=V.POSITION_GROUPS) -> DataFrame:
    """Versions of each player, a new one when the team changes."""
    return _players(scd2(player_observations(lineups, matches), **PLAYER_VERSIONS), position_groups)


def player_dim_merge(
    existing: DataFrame,
    history: tuple[DataFrame, DataFrame],
    incoming: tuple[DataFrame, DataFrame],
    position_groups=V.POSITION_GROUPS,
) -> DataFrame:
    """``existing`` after ``incoming`` (lineups, matches), given all lineups and matches. Known birth years stay."""
    merged = scd2_merge(existing, player_observations(*history), player_observations(*incoming), **PLAYER_VERSIONS)
    return _with_known_years(_players(merged, position_groups), existing)


def player_dim_day(
    existing: DataFrame,
    at: str,
    touched: DataFrame,
    today: tuple[DataFrame, DataFrame],
    later: tuple[DataFrame, DataFrame],
    position_groups=V.POSITION_GROUPS,
) -> DataFrame:
    """``existing`` once the day ``at`` holds just ``today`` (lineups, matches). Known birth years stay."""
    versions = scd2_day(existing, at, touched, player_observations(*today), player_observations(*later), **PLAYER_VERSIONS)
    return _with_known_years(_players(versions, position_groups), existing)


def _with_known_years(players: DataFrame, existing: DataFrame) -> DataFrame:
    years = existing.groupBy("player_natural_id").agg(F.max("birth_year").alias("birth_year"))
    return fill_nulls(players, years, ["player_natural_id"], "birth_year")


def match_dim(matches: DataFrame, team_dim: DataFrame) -> DataFrame:
    """One row per match with the versions of both teams on its day."""
    flat = flatten(
        matches,
        {
            "match_natural_id": F.col("match_id").cast("string"),
            "season": "season.season_name",
            "competition": "competition.competition_name",
            "match_date": F.to_date("match_date"),
            "kickoff_time": F.try_to_timestamp(F.concat("match_date", F.lit(" "), "kick_off")),
            "home_team_natural_id": F.col("home_team.home_team_id").cast("string"),
            "away_team_natural_id": F.col("away_team.away_team_id").cast("string"),
            "home_score": F.col("home_score").cast("int"),
            "away_score": F.col("away_score").cast("int"),
            "stadium": F.trim("stadium.name"),
            "referee": "referee.name",
            "round": F.col("match_week").cast("int"),
            "season_stage": "competition_stage.name",
        },
    )
    for role in ("home", "away"):
        flat = temporal_lookup(
            flat, team_dim, {f"{role}_team_natural_id": "team_natural_id"}, "match_date", ["team_sk"], prefix=f"{role}_"
        )
    return flat.select(
        hash_key("match_natural_id").alias("match_sk"),
        "match_natural_id",
        "season",
        "competition",
        "match_date",
        "kickoff_time",
        "home_team_sk",
        "away_team_sk",
        "home_score",
        "away_score",
        "stadium",
        "referee",
        "round",
        "season_stage",
        F.col("match_date").alias("effective_from"),
        F.lit(OPEN_END).cast("date").alias("effective_to"),
        F.lit(True).alias("is_current"),
    )
