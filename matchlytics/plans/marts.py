"""Data marts: the reports stored as tables, by day, by season or whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, functions as F

from matchlytics.functions import date_key
from matchlytics.functions import values as V
from matchlytics.plans import reports as R
from matchlytics.plans.daily import CHANGES, Warehouse
from matchlytics.sources import MissingSource, clear_partitions, replace_partitions, replace_table

MAPPED = ("Shot", *V.DEFENSIVE_ACTIONS)
MILESTONES = (1, 5, 10, 25, 50, 100)
Rows = Callable[[], DataFrame]


def _day_marts(wh: Warehouse, days: list[int] | None) -> dict[str, Rows]:
    """Marts whose rows belong to a day, with ``date_id``; of these days only, or of all."""

    def on(column: Column) -> Column:
        return F.lit(True) if days is None else column.isin(*days)

    dim = wh.read("dim_match").withColumn("date_id", date_key("match_date"))
    dated = {k: dim.select(k, "date_id") for k in ("match_sk", "match_natural_id")}
    events = wh.landed("events").where(F.lit(True) if days is None else F.col("date").isin(*[F.to_date(F.lit(str(d)), "yyyyMMdd") for d in days]))
    teams, types = wh.read("dim_team"), wh.read("dim_event_type")
    players, sides = (wh.accepted(t).where(on(F.col("date_id"))) for t in ("fact_player_match_stats", "fact_team_match_stats"))
    facts = wh.read("fact_event").where(on(F.col("date_id")))
    return {
        "match_phases": lambda: R.match_phases(events).join(dated["match_natural_id"], "match_natural_id"),
        "match_player_performance": lambda: R.player_performance(players, sides).join(dated["match_sk"], "match_sk"),
        "match_event_map": lambda: R.event_map(facts, types, MAPPED),
        "match_heatmap": lambda: R.heatmap(facts, 10, ["date_id", "match_sk", "team_sk"]),
        "match_pass_network": lambda: R.pass_network(events).join(dated["match_natural_id"], "match_natural_id"),
        "match_formations": lambda: R.match_formations(events, dim, teams, sides),
        "match_play_patterns": lambda: R.match_play_patterns(events).join(dated["match_natural_id"], "match_natural_id"),
    }


def _season_marts(wh: Warehouse, seasons: list[str] | None, metric: str) -> dict[str, Rows]:
    """Marts whose rows belong to a season; of these seasons only, or of all."""
    wanted = F.lit(True) if seasons is None else F.col("season").isin(*seasons)
    matches, teams, players = wh.read("dim_match").where(wanted), wh.read("dim_team"), wh.read("dim_player")
    player_stats, team_stats = (
        wh.accepted(t).join(matches.select("match_sk"), "match_sk", "left_semi") for t in ("fact_player_match_stats", "fact_team_match_stats")
    )
    totals = wh.read("fact_player_season_stats").where(wanted)
    return {
        "scouting_season_performance": lambda: R.player_season_performance(player_stats, team_stats, matches),
        "scouting_shortlist": lambda: R.scouting(player_stats, matches, players, metric, bucket_width=0.05),
        "strategy_key_players": lambda: R.key_players(totals, players, teams, "goals"),
    }


def _whole_marts(wh: Warehouse) -> dict[str, Rows]:
    """Marts over all time, from facts of a row per team or player and match and from marts by day; never from events."""
    teams, players = wh.read("dim_team"), wh.read("dim_player")
    player_stats, team_stats = wh.accepted("fact_player_match_stats"), wh.accepted("fact_team_match_stats")
    return {
        "strategy_team_form": lambda: R.team_form(team_stats, teams),
        "strategy_home_away": lambda: R.home_away(team_stats, teams),
        "strategy_head_to_head": lambda: R.head_to_head(team_stats, teams),
        "strategy_formations": lambda: R.formations_summed(wh.read("mart_match_formations")),
        "strategy_play_patterns": lambda: R.play_patterns_summed(wh.read("mart_match_play_patterns")),
        "scouting_progress": lambda: R.player_progress(wh.read("fact_player_season_stats"), players),
        "scouting_milestones": lambda: R.milestones(player_stats, players, MILESTONES),
    }


def build_marts(wh: Warehouse, scouting_metric: str = "xg_total") -> dict[str, int]:
    """Writes the match, scouting and strategy marts anew; returns the rows of each table."""
    rows = {name: replace_table(make(), wh.path(f"mart_{name}"), ["date_id"]) for name, make in _day_marts(wh, None).items()}
    rows |= {name: replace_table(make(), wh.path(f"mart_{name}"), ["season"]) for name, make in _season_marts(wh, None, scouting_metric).items()}
    rows |= {name: replace_table(make(), wh.path(f"mart_{name}")) for name, make in _whole_marts(wh).items()}
    clear_partitions(wh.spark, wh.path(CHANGES), [])
    return rows


def _refresh(wh: Warehouse, name: str, rows: DataFrame, column: str, values: list) -> int:
    """Makes the partitions of these values hold just these rows; the others keep their files."""
    seen = Observation()
    rows = rows.observe(seen, F.collect_set(column).alias("values"))
    written = replace_partitions(rows, wh.path(f"mart_{name}"), [column])
    for value in set(values) - set(seen.get["values"]):
        clear_partitions(wh.spark, wh.path(f"mart_{name}"), [(column, value)])
    return written


def refresh_marts(wh: Warehouse, scouting_metric: str = "xg_total") -> dict[str, int]:
    """Brings the marts up to date after loads; returns the rows written of each, none if no load came since.

    Marts by day and by season are rewritten for the days and seasons that the loads have named, whatever the others hold.
    The list of changes goes last, so that a refresh that was cut off starts over.
    """
    try:
        changes = wh.read(CHANGES).distinct().collect()  # a row a day or season
    except MissingSource:
        return {}
    days = sorted(int(r.value) for r in changes if r.kind == "day")
    seasons = sorted(r.value for r in changes if r.kind == "season")
    rows = {name: _refresh(wh, name, make(), "date_id", days) for name, make in _day_marts(wh, days).items()}
    rows |= {name: _refresh(wh, name, make(), "season", seasons) for name, make in _season_marts(wh, seasons, scouting_metric).items()}
    rows |= {name: replace_table(make(), wh.path(f"mart_{name}")) for name, make in _whole_marts(wh).items()}
    clear_partitions(wh.spark, wh.path(CHANGES), [])
    return rows
