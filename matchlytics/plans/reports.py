"""Reports over the facts and dimensions of the warehouse."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from matchlytics.functions import padj, per90, rate
from matchlytics.functions import values as V
from matchlytics.operators import (
    cond_counts,
    correlation,
    grid,
    histogram,
    league_position,
    next_value,
    opponent_total,
    previous_value,
    recent,
    rollup_levels,
    running_total,
    top_k,
)
from matchlytics.plans.stats import INDEX_BUCKET, TOTAL, XG, _measured, is_a, possession


def match_phases(events: DataFrame) -> DataFrame:
    """Possession, pressure, recoveries and xG for and against, per team, by period and over the match (NULL period)."""
    measured = _measured(events).where(F.col("team_natural_id").isNotNull())
    per_period = cond_counts(
        measured,
        ["match_natural_id", "team_natural_id", "period"],
        {"pressures": is_a("Pressure"), "recoveries": is_a("Ball Recovery")},
        {"xg_for": ("xg", XG), "ball_time": ("duration", "decimal(18,6)", V.MAX_POSSESSION_DURATION)},
    )
    sums = {c: ("sum", c) for c in ("pressures", "recoveries", "xg_for", "ball_time")}
    levels = rollup_levels(per_period, ["match_natural_id", "team_natural_id", "period"], sums)
    sides = opponent_total(levels.where(F.col("level") >= 2), ["match_natural_id", "level", "period"], ["xg_for", "ball_time"])
    return sides.select(
        "match_natural_id",
        "team_natural_id",
        "period",
        "pressures",
        "recoveries",
        possession("ball_time", "ball_time_match").alias("possession_pct"),
        F.col("xg_for").cast(TOTAL),
        F.col("xg_for_opponent").cast(TOTAL).alias("xg_against"),
    )


def _performance(minutes: str) -> dict[str, Column]:
    return {
        "g_minus_xg": F.col("goals") - F.col("xg"),
        "touches_in_box_90": per90("touches_in_box", minutes),
        "interceptions_90": per90("interceptions", minutes),
        "tackle_success_pct": rate("tackles_won", "tackles_total", 100),
        "pass_accuracy_pct": rate("accurate_passes", "total_passes", 100),
    }


def player_performance(player_match_stats: DataFrame, team_match_stats: DataFrame) -> DataFrame:
    """Per player and match: finishing, box touches, tackling, passing, and interceptions adjusted for possession."""
    share = team_match_stats.select("match_sk", "team_sk", F.col("possession_pct").cast("double").alias("own_share"))
    stats = player_match_stats.withColumn("xg", F.col("xg_total").cast("double")).join(share, ["match_sk", "team_sk"], "left")
    adjusted = padj("interceptions", "minutes_played", "own_share", 100 - F.col("own_share"))
    return stats.withColumns({**_performance("minutes_played"), "padj_interceptions_90": adjusted}).select(
        "match_sk", "team_sk", "player_sk", "minutes_played", *_performance(""), "padj_interceptions_90"
    )


def player_season_performance(player_match_stats: DataFrame, team_match_stats: DataFrame, match_dim: DataFrame) -> DataFrame:
    """The same over a season; possession adjusts each match by itself and weighs by minutes."""
    single = player_performance(player_match_stats, team_match_stats).select("match_sk", "player_sk", "padj_interceptions_90")
    stats = player_match_stats.join(single, ["match_sk", "player_sk"], "left").join(
        match_dim.select("match_sk", "season"), "match_sk"
    )
    sums = [
        "minutes_played", "goals", "touches_in_box", "interceptions", "tackles_won", "tackles_total",
        "accurate_passes", "total_passes",
    ]
    totals = stats.groupBy("season", "team_sk", "player_sk").agg(
        *[F.sum(c).alias(c) for c in sums],
        F.sum("xg_total").cast("double").alias("xg"),
        F.sum(F.col("padj_interceptions_90") * F.col("minutes_played")).alias("weighted"),
    )
    adjusted = rate("weighted", "minutes_played")
    return totals.withColumns({**_performance("minutes_played"), "padj_interceptions_90": adjusted}).select(
        "season", "team_sk", "player_sk", "minutes_played", *_performance(""), "padj_interceptions_90"
    )


def team_form(team_match_stats: DataFrame, team_dim: DataFrame, n: int = 5) -> DataFrame:
    """Results of a team's last ``n`` matches up to each match, across versions of the team."""
    teams = team_dim.select("team_sk", "team_natural_id")
    results = team_match_stats.join(teams, "team_sk").select(
        "team_natural_id", "date_id", "match_sk", "result", "goals_scored", "goals_conceded", "total_xg"
    )

    def count(result: str) -> Column:
        return F.count_if(F.col("result") == result)

    return recent(
        results,
        ["team_natural_id"],
        ["date_id", "match_sk"],
        n,
        {
            "recent_wins": count("W"),
            "recent_draws": count("D"),
            "recent_losses": count("L"),
            "recent_goals": F.sum("goals_scored"),
            "recent_xg": F.sum("total_xg"),
        },
    )


def home_away(team_match_stats: DataFrame, team_dim: DataFrame) -> DataFrame:
    """Average measures of each team at home and away."""
    teams = team_dim.select("team_sk", "team_natural_id")
    return team_match_stats.join(teams, "team_sk").groupBy("team_natural_id", "is_home").agg(
        F.count("*").alias("matches"),
        F.count_if(F.col("result") == "W").alias("wins"),
        *[F.avg(c).alias(f"avg_{c}") for c in ("goals_scored", "goals_conceded", "total_xg", "possession_pct", "ppda")],
    )


def scouting(
    player_match_stats: DataFrame,
    match_dim: DataFrame,
    player_dim: DataFrame,
    metric: str,
    season: str | None = None,
    position_groups: Sequence[str] = (),
    nationalities: Sequence[str] = (),
    birth_years: tuple[int, int] | None = None,
    min_minutes: int = 0,
    bucket_width: float = 1.0,
) -> DataFrame:
    """Players by a metric per 90 minutes: season mean, spread between matches, and position among their peers.

    The position is taken within season and position group before players are filtered out by name or age.
    """
    stats = player_match_stats.join(match_dim.select("match_sk", "season"), "match_sk")
    if season:
        stats = stats.where(F.col("season") == season)
    people = player_dim.select("player_sk", "player_natural_id", "player_name", "nationality", "position_group", "birth_year")
    value = F.col(metric).cast("double")
    seasons = (
        stats.join(people, "player_sk")
        .groupBy("season", "position_group", "player_natural_id")
        .agg(
            F.max("player_name").alias("player_name"),
            F.max("nationality").alias("nationality"),
            F.max("birth_year").alias("birth_year"),
            F.count("*").alias("matches"),
            F.sum("minutes_played").alias("minutes"),
            rate(F.sum(value), F.sum("minutes_played"), 90).alias("per_90"),
            F.avg(value).alias("match_mean"),
            F.stddev_samp(value).alias("match_stddev"),
        )
        .where(F.col("minutes") >= min_minutes)
    )
    ranked = league_position(seasons, ["season", "position_group"], "per_90", bucket=F.floor(F.col("per_90") / bucket_width))
    wanted = F.lit(True)
    if position_groups:
        wanted &= F.col("position_group").isin(*position_groups)
    if nationalities:
        wanted &= F.col("nationality").isin(*nationalities)
    if birth_years:
        wanted &= F.col("birth_year").between(*birth_years)
    return ranked.where(wanted)


def player_progress(season_stats: DataFrame, player_dim: DataFrame, measures: Sequence[str] = ("goals", "assists", "minutes")) -> DataFrame:
    """Each player's season totals beside those of the season before."""
    players = player_dim.select("player_sk", "player_natural_id")
    seasons = (
        season_stats.join(players, "player_sk")
        .groupBy("player_natural_id", "season")
        .agg(*[F.sum(m).alias(m) for m in measures])
    )
    earlier = previous_value(seasons, ["player_natural_id"], ["season"], {f"previous_{m}": m for m in measures})
    return earlier.withColumns({f"{m}_change": F.col(m) - F.col(f"previous_{m}") for m in measures})


def milestones(
    player_match_stats: DataFrame, player_dim: DataFrame, thresholds: Sequence[int], measure: str = "goals"
) -> DataFrame:
    """The day on which a player's running total reached each threshold."""
    players = player_dim.select("player_sk", "player_natural_id")
    days = (
        player_match_stats.join(players, "player_sk")
        .groupBy("player_natural_id", "date_id")
        .agg(F.sum(measure).alias("on_day"))
    )
    totals = running_total(days, ["player_natural_id"], ["date_id"], "on_day", "total")
    reached = totals.withColumn("threshold", F.explode(F.array(*[F.lit(t) for t in thresholds])))
    crossed = (F.col("total") >= F.col("threshold")) & (F.col("total") - F.col("on_day") < F.col("threshold"))
    return reached.where(crossed).select("player_natural_id", "threshold", "date_id", "total")


def head_to_head(team_match_stats: DataFrame, team_dim: DataFrame) -> DataFrame:
    """Results and mean measures of each team against each opponent."""
    teams = team_dim.select("team_sk", "team_natural_id")
    opponents = teams.toDF("opponent_team_sk", "opponent_natural_id")
    games = team_match_stats.join(teams, "team_sk").join(opponents, "opponent_team_sk")
    return games.groupBy("team_natural_id", "opponent_natural_id").agg(
        F.count("*").alias("matches"),
        *[F.count_if(F.col("result") == r).alias(n) for r, n in (("W", "wins"), ("D", "draws"), ("L", "losses"))],
        F.sum("goals_scored").alias("goals_scored"),
        F.sum("goals_conceded").alias("goals_conceded"),
        *[F.avg(c).alias(f"avg_{c}") for c in ("possession_pct", "ppda", "total_xg")],
    )


def key_players(season_stats: DataFrame, player_dim: DataFrame, team_dim: DataFrame, measure: str, k: int = 3) -> DataFrame:
    """The best ``k`` players of each team and season by a measure."""
    players = player_dim.select("player_sk", "player_natural_id", "player_name")
    teams = team_dim.select("team_sk", "team_natural_id")
    totals = (
        season_stats.join(players, "player_sk")
        .join(teams, "team_sk")
        .groupBy("season", "team_natural_id", "player_natural_id")
        .agg(F.max("player_name").alias("player_name"), F.sum(measure).alias(measure))
    )
    return top_k(totals, ["season", "team_natural_id"], [F.col(measure).desc(), "player_natural_id"], k)


def event_map(fact_event: DataFrame, event_type_dim: DataFrame, event_types: Sequence[str]) -> DataFrame:
    """Located events of some types with outcome and xG, for shot and defensive-action maps."""
    types = event_type_dim.where(F.col("event_type").isin(*event_types)).select("event_type_sk", "event_type", "outcome")
    return fact_event.where(F.col("location_x").isNotNull()).join(types, "event_type_sk").select(
        "date_id", "match_sk", "team_sk", "player_sk", "event_type", "outcome", "location_x", "location_y", "location_id", "shot_xg"
    )


def heatmap(fact_event: DataFrame, cell: float = 10, group: Sequence[str] = ("player_sk",)) -> DataFrame:
    """Events per cell of the pitch."""
    return grid(fact_event, "location_x", "location_y", cell, cell, group)


def pass_accuracy_histogram(player_match_stats: DataFrame, width: float = 5) -> DataFrame:
    return histogram(player_match_stats, rate("accurate_passes", "total_passes", 100), width)


def xg_goal_correlation(team_match_stats: DataFrame) -> DataFrame:
    return correlation(team_match_stats, F.col("total_xg").cast("double"), F.col("goals_scored").cast("double"))


def top_event_types(events: DataFrame, n: int = 10) -> DataFrame:
    """The most frequent event types."""
    counted = events.groupBy(F.col("type.name").alias("event_type")).agg(F.count("*").alias("events"))
    return counted.orderBy(F.col("events").desc(), "event_type").limit(n)


def pass_network(events: DataFrame) -> DataFrame:
    """How often a pass of one player was received by another of the team in the next event."""
    rows = _measured(events).select("match_natural_id", "team_natural_id", "player_natural_id", "index", "type")
    following = next_value(
        rows,
        ["match_natural_id"],
        ["index"],
        {"next_type": "type", "next_team": "team_natural_id", "receiver": "player_natural_id"},
        bucket=F.floor(F.col("index") / INDEX_BUCKET),
    )
    received = (
        is_a("Pass")
        & (F.col("next_type") == "Ball Receipt*")
        & (F.col("next_team") == F.col("team_natural_id"))
        & F.col("receiver").isNotNull()
    )
    return (
        following.where(received)
        .groupBy("match_natural_id", "team_natural_id", F.col("player_natural_id").alias("passer"), "receiver")
        .agg(F.count("*").alias("passes"))
    )


def formation_usage(events: DataFrame, match_dim: DataFrame, team_dim: DataFrame, team_match_stats: DataFrame) -> DataFrame:
    """Matches and results per team and starting formation."""
    return formations_summed(match_formations(events, match_dim, team_dim, team_match_stats))


def match_formations(events: DataFrame, match_dim: DataFrame, team_dim: DataFrame, team_match_stats: DataFrame) -> DataFrame:
    """The starting formation of each team and match beside the result."""
    formations = events.where(F.col("type.name") == "Starting XI").select(
        F.col("match_id").cast("string").alias("match_natural_id"),
        F.col("team.id").cast("string").alias("team_natural_id"),
        F.col("tactics.formation").alias("formation"),
    )
    results = (
        team_match_stats.select("date_id", "match_sk", "team_sk", "result", "goals_scored")
        .join(match_dim.select("match_sk", "match_natural_id"), "match_sk")
        .join(team_dim.select("team_sk", "team_natural_id"), "team_sk")
    )
    return formations.join(results, ["match_natural_id", "team_natural_id"]).select(
        "date_id", "match_sk", "team_natural_id", "formation", "result", "goals_scored"
    )


def formations_summed(formations: DataFrame) -> DataFrame:
    return formations.groupBy("team_natural_id", "formation").agg(
        F.count("*").alias("matches"),
        *[F.count_if(F.col("result") == r).alias(n) for r, n in (("W", "wins"), ("D", "draws"), ("L", "losses"))],
        F.avg("goals_scored").alias("avg_goals"),
    )


def play_pattern_effect(events: DataFrame) -> DataFrame:
    """Shots, goals and xG per play pattern, e.g. from corners or counters."""
    return play_patterns_summed(match_play_patterns(events))


def match_play_patterns(events: DataFrame) -> DataFrame:
    """Shots, goals and xG of each match by play pattern."""
    shots = events.where(F.col("type.name") == "Shot").select(
        F.col("match_id").cast("string").alias("match_natural_id"),
        F.col("play_pattern.name").alias("play_pattern"),
        F.col("shot.outcome.name").alias("outcome"),
        F.col("shot.statsbomb_xg").alias("xg"),
    )
    keys = ["match_natural_id", "play_pattern"]
    return cond_counts(shots, keys, {"goals": F.col("outcome") == "Goal"}, {"xg": ("xg", XG)}, shots=F.count("*"))


def play_patterns_summed(patterns: DataFrame) -> DataFrame:
    effect = patterns.groupBy("play_pattern").agg(*[F.sum(c).alias(c) for c in ("shots", "goals", "xg")])
    return effect.select(
        "play_pattern", "shots", "goals", F.col("xg").cast("decimal(12,3)").alias("xg"), rate("goals", "shots", 100).alias("conversion_pct")
    )
