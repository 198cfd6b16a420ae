from __future__ import annotations

import re
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import Observation, functions as F

from matchlytics.operators import intervals_played
from matchlytics.plans import dimensions as D
from matchlytics.plans import reports as R
from matchlytics.plans import stats as S
from matchlytics.plans.enrich import enrich_birth_year
from matchlytics.plans.facts import fact_event
from tests import league as L

SQUADS = {1: [11, 12, 13, 14], 2: [21, 22, 23, 24], 3: [31, 32, 33, 34]}


def minutes(df):
    return {int(r.player_natural_id): r.minutes_played for r in df.collect()}


def test_minutes_played(spark):
    s = L.Script(7).starting(1, [1, 3, 4, 5])
    s.swap(1, 4, 2, 60).swap(1, 2, 6, 80).card(1, 3, 30, "Red Card").swap(1, 5, 7, 50).card(1, 5, 70, "Second Yellow")
    s.card(1, 1, 20, "Yellow Card").add("Half End", 1, minute=93)
    assert minutes(S.minutes_played(L.events(spark, s.rows))) == {1: 93, 2: 20, 3: 30, 4: 60, 5: 50, 6: 13, 7: 43}


def test_intervals_from_separate_tables(spark):
    entries = spark.createDataFrame([(1, "a", 10), (1, "b", 50)], "m int, p string, entry_min bigint")
    exits = spark.createDataFrame([(1, "a", 30), (1, "b", 40), (1, "c", 5)], "m int, p string, exit_min bigint")
    ends = spark.createDataFrame([(1, 90)], "m int, end_min bigint")
    got = intervals_played(entries, exits, ends, ["m"], ["p"]).collect()
    assert sorted((r.p, r.minutes_played) for r in got) == [("a", 20), ("b", 0)]


def test_player_measures(spark):
    s = L.Script(7)
    s.passed(1, 11).passed(1, 11, outcome="Incomplete").shot(1, 11, xg=0.3, outcome="Goal").shot(1, 11, xg=0.0335)
    s.passed(1, 11, **{"pass": {"goal_assist": True}}).add("Interception", 1, 11)
    for outcome in ("Won", "Success In Play", "Success Out", "Lost In Play", None):
        duel = {"type": L.named(11, "Tackle")}
        s.add("Duel", 1, 11, duel={**duel, "outcome": L.named(1, outcome)} if outcome else duel)
    s.add("Duel", 1, 11, duel={"type": L.named(10, "Aerial Lost"), "outcome": L.named(4, "Won")})
    s.card(1, 11, 40, "Yellow Card").card(1, 11, 60, "Second Yellow").add("Half End", 1)
    (row,) = S.player_measures(L.events(spark, s.rows)).collect()
    assert row.asDict() == {
        "match_natural_id": "7", "team_natural_id": "1", "player_natural_id": "11", "total_passes": 3, "accurate_passes": 2,
        "total_shots": 2, "goals": 1, "assists": 1, "interceptions": 1, "touches_in_box": 2, "tackles_total": 5, "tackles_won": 3,
        "yellow_cards": 2, "red_cards": 1, "xg": Decimal("0.3335000000"),
    }


def test_expected_assists(spark):
    s = L.Script(7).passed(1, 11).shot(1, 12, xg=0.25).passed(1, 11).add("Carry", 1, 12).shot(1, 12, xg=0.5)
    s.passed(1, 13).shot(2, 21, xg=0.125).passed(1, 11)
    rows = S.expected_assists(L.events(spark, s.rows)).collect()
    assert {r.player_natural_id: float(r.xa) for r in rows} == {"11": 0.75}


def test_expected_assists_pass_over_receipts_and_carries_only(spark):
    s = L.Script(7).passed(1, 11).add("Ball Receipt*", 1, 12).add("Carry", 1, 12).shot(1, 12, xg=0.25)
    s.passed(1, 13).shot(2, 21, xg=0.125).passed(1, 14).add("Dribble", 1, 14).shot(1, 14, xg=0.5)
    rows = S.expected_assists(L.events(spark, s.rows)).collect()
    assert {r.player_natural_id: float(r.xa) for r in rows} == {"11": 0.25}


def team(spark, s):
    rows = S.team_measures(L.events(spark, s.rows)).collect()
    return {r.team_natural_id: r for r in rows}


def test_team_measures(spark):
    s = L.Script(7)
    for _ in range(4):
        s.passed(1, 11, location=[39.9, 40.0])
    s.passed(1, 11, location=[40.0, 40.0], duration=5000.0)
    s.passed(2, 21, location=[80.0, 1.0], duration=2.0)
    s.add("Pressure", 2, 21, location=[20.0, 1.0]).add("Block", 2, 22, location=[60.0, 1.0]).add("Foul Committed", 2, 22)
    by_team = team(spark, s)
    assert (by_team["2"].passes_opponent, by_team["2"].defensive_actions) == (5, 3)
    assert (by_team["2"].passes_high_opponent, by_team["2"].defensive_actions_high) == (1, 1)
    assert (by_team["1"].ball_time, by_team["1"].ball_time_match) == (Decimal("6"), Decimal("8"))
    assert by_team["1"].defensive_actions == 0


def star(spark, fixtures=None):
    games = fixtures or [
        L.match(1, "2018-05-06", 1, 2, (1, 1)),
        L.match(2, "2018-05-13", 2, 3, (2, 0), ("A", "Z")),
        L.match(3, "2018-05-20", 3, 1, (0, 0), ("Z", "New")),
    ]
    events = L.events(spark, [e for m in games for e in L.played(m, SQUADS)])
    listings = [
        L.listed(m["match_id"], t, SQUADS[t], "Left Wing")
        for m in games
        for t in (m["home_team"]["home_team_id"], m["away_team"]["away_team_id"])
    ]
    matches, lineups = L.matches(spark, games), L.lineups(spark, listings)
    teams, players = D.team_dim(matches), D.player_dim(lineups, matches)
    return events, matches, lineups, D.match_dim(matches, teams), teams, players


@pytest.fixture(scope="module")
def tables(spark):
    events, matches, lineups, match_dim, teams, players = star(spark)
    return {
        "events": events,
        "matches": matches,
        "lineups": lineups,
        "match_dim": match_dim,
        "teams": teams,
        "players": players,
        "player_stats": S.player_match_stats(events, match_dim, teams, players).cache(),
        "team_stats": S.team_match_stats(events, match_dim, teams).cache(),
    }


def test_team_dimension(tables):
    rows = sorted((r.team_natural_id, r.manager_name, str(r.effective_from), r.home_stadium) for r in tables["teams"].collect())
    assert rows == [
        ("1", "H", "2018-05-06", " Ground 1 "),
        ("1", "New", "2018-05-20", None),
        ("2", "A", "2018-05-06", None),
        ("3", "Z", "2018-05-13", None),
    ]


def test_team_without_manager(spark):
    matches = L.matches(spark, [L.match(1, "2018-05-06", 1, 2, managers=(None, "A"))])
    assert D.team_dim(matches).where("manager_name is null").count() == 1


def test_player_dimension(spark):
    matches = L.matches(spark, [L.match(i, f"2018-05-0{i}", 1, 2) for i in (1, 2, 3)])
    listings = [L.listed(1, 1, [9], None), L.listed(2, 1, [9], "Striker"), L.listed(3, 2, [9], "Left Center Forward"), L.listed(4, 2, [9])]
    rows = D.player_dim(L.lineups(spark, listings), matches).orderBy("effective_from").collect()
    assert [(r.team_name, r.position_group, r.specific_position, r.is_current) for r in rows] == [
        ("Team 1", "Unknown", None, False),
        ("Team 2", "Forward", "Left Center Forward", True),
    ]
    assert rows[0].effective_to == date(2018, 5, 2) and rows[0].kaggle_name == "Player 9" and rows[0].birth_year is None


def test_match_dimension(tables):
    row = tables["match_dim"].where("match_natural_id = '3'").first()
    current = {r.team_natural_id: r.team_sk for r in tables["teams"].where("is_current").collect()}
    assert (row.home_team_sk, row.away_team_sk) == (current["3"], current["1"])
    assert row.stadium == "Ground 3" and str(row.kickoff_time) == "2018-05-20 20:45:00" and row["round"] == 3


def test_date_and_pattern_dimensions(spark, tables):
    days = {r.date_id: r.is_weekend for r in D.date_dim(L.matches(spark, [L.match(i, f"2018-05-0{d}", 1, 2) for i, d in enumerate((6, 6, 7))])).collect()}
    assert days == {20180506: True, 20180507: False}
    assert [r.play_pattern_name for r in D.play_pattern_dim(tables["events"]).collect()] == ["Regular Play"]


def test_zone_dimension(spark):
    rows = {r.location_id: r for r in D.zone_dim(spark).collect()}
    assert len(rows) == 19 and [i for i, r in sorted(rows.items()) if r.is_box] == [16, 19]
    assert rows[4].field_zone == "Zone 4 (Defensive Left 20-40)" and rows[4].legacy_name == "Zone 4 (Defensive Right)"


def test_fact_event(tables):
    types, patterns = D.event_type_dim(tables["events"]), D.play_pattern_dim(tables["events"])
    facts = fact_event(tables["events"], tables["match_dim"], tables["teams"], tables["players"], types, patterns).cache()
    assert facts.count() == tables["events"].count()
    for key in ("match_sk", "team_sk", "event_type_sk", "play_pattern_sk"):
        assert facts.where(F.col(key).isNull()).count() == 0
    assert facts.where("player_sk is null").count() == 6  # the six Starting XI
    goal = facts.where("shot_xg = 0.375 and date_id = 20180506").first()
    assert (goal.location_id, goal.end_location_id, goal.date_id) == (19, 19, 20180506)
    assert str(goal.event_relative_time) == "1200.000" and goal.under_pressure is None
    unknown = fact_event(tables["events"], tables["match_dim"].where("match_natural_id <> '1'"), tables["teams"], tables["players"], types, patterns)
    assert unknown.select("date_id").distinct().count() == 2
    assert facts.where("reject_reason is not null").count() == 0


def test_fact_event_names_what_is_missing_or_too_wide(tables, spark):
    t = tables
    types, patterns = D.event_type_dim(t["events"]).where("event_type <> 'Shot'"), D.play_pattern_dim(t["events"])
    rows = [
        {"match_id": 1, "id": "wide", "type": L.named(1, "Pass"), "team": L.named(1), "pass": {"length": 123456.0, "angle": 0.5}, "location": [1e9, 2.0]},
        {"match_id": 1, "id": "team", "type": L.named(1, "Pass"), "team": L.named(77), "player": L.named(78)},
        {"match_id": 1, "id": "type", "type": L.named(1, "Shot"), "player": L.named(13)},
    ]
    loss = Observation()
    facts = fact_event(L.events(spark, rows), t["match_dim"], t["teams"], t["players"], types, patterns, loss=loss)
    got = {r.event_id: r for r in facts.collect()}
    assert got["wide"].reject_reason == "location_x too wide,pass_length too wide" and got["wide"].location_x is None
    assert got["team"].reject_reason == "team_sk" and got["type"].reject_reason == "team_sk,event_type_sk"
    assert loss.get == {"rows": 3, "team": 1, "player": 1, "event_type": 1, "play_pattern": 0}


def stored(df, path):
    df.write.mode("overwrite").parquet(str(path))
    return df.sparkSession.read.parquet(str(path))


def scans_of(df, path):
    return str(df._jdf.queryExecution().executedPlan()).count(f"{path}]")


def test_versions_are_looked_up_above_an_aggregate_and_few_scans(tables, tmp_path):
    """The fact: once for the keys, once for the events. Statistics: one aggregation, and two scans for the order of events."""
    t = {k: stored(tables[k], tmp_path / k) for k in ("events", "match_dim", "teams", "players")}
    dims = t["match_dim"], t["teams"], t["players"]
    facts = fact_event(t["events"], *dims, stored(D.event_type_dim(t["events"]), tmp_path / "types"), stored(D.play_pattern_dim(t["events"]), tmp_path / "patterns"))
    player = S.player_match_stats(t["events"], *dims)
    for df, scans, joins in ((facts, 2, 2), (player, 3, 2)):
        assert scans_of(df, tmp_path / "events") == scans
        text = str(df._jdf.queryExecution().optimizedPlan())
        temporal = [m.end() for m in re.finditer(r"Join .*>=.*", text)]
        assert len(temporal) == joins and all("Aggregate [" in text[a : text.index("Relation", a)] for a in temporal)


def test_statistics_without_a_dimension_row_are_rejected_with_their_reason(tables):
    t = tables
    players = t["players"].where("player_natural_id <> '13'")
    loss = Observation()
    checked = S.checked_player_stats(t["events"], t["match_dim"], t["teams"].where("team_natural_id <> '2'"), players, loss).collect()
    reasons = sorted(r.reject_reason for r in checked if r.reject_reason)
    assert len(checked) == 18 and set(reasons) == {"player_sk", "team_sk"}
    assert loss.get == {"rows": 18, "team": reasons.count("team_sk"), "player": reasons.count("player_sk")}
    kept = S.player_match_stats(t["events"], t["match_dim"], t["teams"].where("team_natural_id <> '2'"), players)
    assert kept.count() == 18 - len(reasons) and "reject_reason" not in kept.columns
    teams = S.checked_team_stats(t["events"], t["match_dim"], t["teams"].where("team_natural_id <> '2'")).collect()
    assert sorted(str(r.reject_reason) for r in teams).count("team_sk") == 2 and len(teams) == 6
    assert S.team_match_stats(t["events"], t["match_dim"], t["teams"].where("team_natural_id <> '2'")).count() == 4


def test_player_match_stats(tables):
    stats = tables["player_stats"].join(tables["players"], "player_sk").collect()
    assert len(stats) == len({(r.player_sk, r.match_sk) for r in stats}) == 18  # substitutes have no event of their own
    third = next(r for r in stats if r.player_natural_id == "13" and r.date_id == 20180506)
    assert (third.minutes_played, third.goals, third.starts, third.touches_in_box) == (93, 1, 1, 1)
    assert (float(third.xg_total), float(third.xa_total)) == (0.25, 0.0)
    second = next(r for r in stats if r.player_natural_id == "12" and r.date_id == 20180506)
    assert (second.assists, second.tackles_won, float(second.xa_total)) == (1, 1, 0.25)
    assert all(0 <= r.minutes_played <= 93 for r in stats)


def test_team_match_stats(tables):
    rows = tables["team_stats"].collect()
    assert len(rows) == 6
    share = {}
    for r in rows:
        share[r.match_sk] = share.get(r.match_sk, 0) + float(r.possession_pct)
        assert r.opponent_team_sk and r.opponent_team_sk != r.team_sk
    assert all(abs(s - 100) <= 0.011 for s in share.values())
    first = {r.is_home: r for r in rows if r.date_id == 20180506}
    assert [first[h].result for h in (True, False)] == ["D", "D"]
    second = {r.is_home: r for r in rows if r.date_id == 20180513}
    assert (second[True].result, second[True].goals_scored, second[False].result) == ("W", 2, "L")
    # Away made 6 passes against 2 defensive actions of the home side (pressure, duel).
    assert float(first[True].ppda) == 3.0


def test_team_without_actions_or_time(spark):
    game = L.match(1, "2018-05-06", 1, 2)
    s = L.Script(1).add("Pass", 1, 11).add("Pass", 2, 21)
    matches = L.matches(spark, [game])
    teams = D.team_dim(matches)
    rows = S.team_match_stats(L.events(spark, s.rows), D.match_dim(matches, teams), teams).collect()
    assert [(r.ppda, float(r.possession_pct)) for r in rows] == [(None, 50.0)] * 2


def test_season_stats(tables):
    seasons = S.season_stats(tables["player_stats"], tables["match_dim"]).join(tables["players"], "player_sk")
    rows = {(r.player_natural_id, r.matches_played): r for r in seasons.collect()}
    # Player 13's two matches fall into two versions of team 1.
    assert len([1 for p, _ in rows if p == "13"]) == 1 and rows["13", 1].goals == 1
    assert rows["23", 2].goals == 2 and rows["23", 2].starts == 2 and rows["23", 2].minutes == 186
    assert rows["22", 2].yellow_cards == 1 and rows["22", 2].red_cards == 0


def test_birth_years(spark, tables):
    people = spark.createDataFrame([("Player 11", 1990), ("Player 12", 1950)], "name string, birth_year int")
    filled = enrich_birth_year(tables["players"], people)
    assert filled.columns == tables["players"].columns
    assert {r.player_name for r in filled.where("birth_year is not null").collect()} == {"Player 11"}


def test_reports(tables):
    t = tables
    seasons = S.season_stats(t["player_stats"], t["match_dim"])
    form = R.team_form(t["team_stats"], t["teams"], 2).where("team_natural_id = '2'").orderBy("date_id").collect()
    assert [(r.recent_wins, r.recent_draws, r.recent_goals) for r in form] == [(0, 1, 1), (1, 1, 3)]
    sides = {(r.team_natural_id, r.is_home): r for r in R.home_away(t["team_stats"], t["teams"]).collect()}
    assert sides["2", True].wins == 1 and sides["2", False].matches == 1
    h2h = {(r.team_natural_id, r.opponent_natural_id): r for r in R.head_to_head(t["team_stats"], t["teams"]).collect()}
    assert (h2h["2", "3"].wins, h2h["3", "2"].losses, h2h["1", "3"].draws) == (1, 1, 1)
    best = R.key_players(seasons, t["players"], t["teams"], "goals", 1).collect()
    assert {r.player_natural_id for r in best} == {"13", "23", "33"}
    marks = {(r.player_natural_id, r.threshold): r.date_id for r in R.milestones(t["player_stats"], t["players"], [1, 2]).collect()}
    assert marks["23", 1] == 20180506 and marks["23", 2] == 20180513 and ("11", 1) not in marks
    network = R.pass_network(t["events"])
    edge = network.where("passer = '11' and receiver = '12' and match_natural_id = '1'").first()
    assert edge.passes == 4
    formations = {r.team_natural_id: r for r in R.formation_usage(t["events"], t["match_dim"], t["teams"], t["team_stats"]).collect()}
    assert (formations["2"].formation, formations["2"].matches, formations["2"].wins) == (442, 2, 1)
    effect = R.play_pattern_effect(t["events"]).first()
    assert (effect.shots, effect.goals, effect.conversion_pct) == (6, 6, 100.0)
    assert R.top_event_types(t["events"], 2).count() == 2
    progress = R.player_progress(seasons, t["players"]).where("player_natural_id = '13'").first()
    assert progress.goals == 2 and progress.previous_goals is None
    assert R.pass_accuracy_histogram(t["player_stats"]).agg(F.sum("rows")).first()[0] == 18
    assert R.xg_goal_correlation(t["team_stats"]).count() == 1


def test_performance_reports(tables):
    t = tables
    single = R.player_performance(t["player_stats"], t["team_stats"]).join(t["players"], "player_sk")
    row = single.where("player_natural_id = '13'").orderBy("g_minus_xg").first()
    assert row.g_minus_xg == pytest.approx(0.625) and row.touches_in_box_90 == pytest.approx(90 / 93)
    assert row.tackle_success_pct is None
    season = R.player_season_performance(t["player_stats"], t["team_stats"], t["match_dim"]).join(t["players"], "player_sk")
    two = season.where("player_natural_id = '23'").first()
    assert two.minutes_played == 186 and two.g_minus_xg == pytest.approx(2 - 0.375 - 0.25)


def test_phases_and_scouting(tables):
    t = tables
    phases = R.match_phases(t["events"]).where("match_natural_id = '1'").collect()
    whole = {r.team_natural_id: r for r in phases if r.period is None}
    assert sum(r.possession_pct for r in whole.values()) == pytest.approx(100)
    assert (float(whole["1"].xg_for), float(whole["1"].xg_against)) == (0.25, 0.375)
    assert whole["1"].pressures == 1 and {r.period for r in phases} == {None, 1, 2}
    shortlist = R.scouting(t["player_stats"], t["match_dim"], t["players"], "goals", position_groups=["Forward"], bucket_width=0.5)
    rows = {r.player_natural_id: r for r in shortlist.collect()}
    assert {p for p, r in rows.items() if r["rank"] == 1} == {"13", "23", "33"} and rows["11"]["rank"] == 4
    assert R.scouting(t["player_stats"], t["match_dim"], t["players"], "goals", nationalities=["Peru"]).count() == 0


def test_maps(tables):
    t = tables
    types = D.event_type_dim(t["events"])
    facts = fact_event(t["events"], t["match_dim"], t["teams"], t["players"], types, D.play_pattern_dim(t["events"]))
    shots = R.event_map(facts, types, ["Shot"]).collect()
    assert len(shots) == 6 and {r.outcome for r in shots} == {"Goal"}
    cells = R.heatmap(facts, 10, ["match_sk"])
    assert cells.agg(F.sum("rows")).first()[0] == facts.where("location_x is not null").count()
