"""A small invented league, as raw documents."""

from __future__ import annotations

import json
from pathlib import Path

from matchlytics.sources import EVENTS, LINEUPS, MATCHES


def events(spark, rows):
    """Events from dicts holding only the fields of interest."""
    return spark.createDataFrame(rows, f"match_id bigint, {EVENTS}")


def matches(spark, rows):
    return spark.createDataFrame(rows, MATCHES)


def lineups(spark, rows):
    return spark.createDataFrame(rows, f"match_id bigint, {LINEUPS}")


def named(id, name=None):
    return {"id": id, "name": name or f"n{id}"}


class Script:
    """Events of one match, numbered as they are added."""

    def __init__(self, match_id: int):
        self.match_id, self.rows = match_id, []

    def add(self, type, team=None, player=None, minute=0, **fields):
        self.rows.append(
            {
                "match_id": self.match_id,
                "id": f"{self.match_id}-{len(self.rows) + 1}",
                "index": len(self.rows) + 1,
                "period": 1 if minute <= 45 else 2,
                "minute": minute,
                "second": 0,
                "timestamp": f"00:{minute % 60:02d}:00.000",
                "type": named(1, type),
                "play_pattern": named(1, "Regular Play"),
                "possession": 1,
                **({"team": named(team)} if team else {}),
                **({"player": named(player)} if player else {}),
                **fields,
            }
        )
        return self

    def starting(self, team, players, formation=442):
        lineup = [{"player": named(p), "jersey_number": p} for p in players]
        return self.add("Starting XI", team, tactics={"formation": formation, "lineup": lineup})

    def swap(self, team, off, on, minute):
        return self.add("Substitution", team, off, minute, substitution={"replacement": named(on)})

    def card(self, team, player, minute, card):
        return self.add("Foul Committed", team, player, minute, foul_committed={"card": named(7, card)})

    def passed(self, team, player, minute=10, outcome=None, **fields):
        detail = {"length": 10.0, "angle": 0.5, "end_location": [60.0, 40.0]}
        if outcome:
            detail["outcome"] = named(9, outcome)
        return self.add("Pass", team, player, minute, **{"location": [50.0, 40.0], "duration": 1.5, "pass": detail, **fields})

    def shot(self, team, player, minute=10, xg=0.1, outcome="Saved"):
        detail = {"statsbomb_xg": xg, "end_location": [120.0, 40.0], "outcome": named(97, outcome)}
        return self.add("Shot", team, player, minute, location=[110.0, 40.0], duration=0.5, shot=detail)


def match(id, date, home, away, score=(1, 0), managers=("H", "A"), season="2017/2018", competition="League"):
    def team(side, team_id, manager):
        names = [named(1, manager)] if manager else []
        return {f"{side}_team_id": team_id, f"{side}_team_name": f"Team {team_id}", "managers": names}

    return {
        "match_id": id,
        "match_date": date,
        "kick_off": "20:45:00.000",
        "season": {"season_id": 1, "season_name": season},
        "competition": {"competition_id": 11, "competition_name": competition, "country_name": "X"},
        "competition_stage": named(1, "Regular Season"),
        "match_week": 3,
        "home_team": team("home", home, managers[0]),
        "away_team": team("away", away, managers[1]),
        "home_score": score[0],
        "away_score": score[1],
        "stadium": named(5, f" Ground {home} "),
        "referee": named(6, "Referee"),
    }


def listed(match_id, team, players, position="Left Back"):
    return {
        "match_id": match_id,
        "team_id": team,
        "team_name": f"Team {team}",
        "lineup": [
            {
                "player_id": p,
                "player_name": f"Player {p}",
                "country": named(1, "Spain"),
                "positions": [{"position_id": 1, "position": position, "from": "00:00"}] if position else [],
            }
            for p in players
        ],
    }


def played(m, squads):
    """Script of a match in which both sides pass, shoot, defend and substitute."""
    home, away = m["home_team"]["home_team_id"], m["away_team"]["away_team_id"]
    s = Script(m["match_id"])
    for team in (home, away):
        s.starting(team, squads[team][:3])
    for n, team in enumerate((home, away)):
        first, second, third, sub = squads[team]
        for i in range(3 + n + m["match_id"] % 3):
            s.passed(team, first, 5 + i, outcome="Incomplete" if i % 3 == 2 else None)
            s.add("Ball Receipt*", team, second, 5 + i, location=[60.0, 40.0])
        s.passed(team, second, 20, **{"pass": {"goal_assist": True, "length": 5.0}}).shot(team, third, 20, 0.25 + n / 8, "Goal")
        s.add("Pressure", team, first, 30, location=[70.0, 30.0], duration=0.4)
        s.add("Duel", team, second, 31, location=[30.0, 30.0], duel={"type": named(11, "Tackle"), "outcome": named(4, "Won")})
        s.swap(team, first, sub, 60)
    return s.card(away, squads[away][1], 70, "Yellow Card").passed(home, squads[home][1], 93).rows


def write(root: Path, m: dict, lineup_rows: list[dict], event_rows: list[dict]) -> None:
    """Documents of a match in the folder of its day; match ids only where the provider has them."""
    for kind, rows in (("matches", [m]), ("lineups", lineup_rows), ("events", event_rows)):
        folder = root / kind / f"date={m['match_date']}"
        folder.mkdir(parents=True, exist_ok=True)
        if kind != "matches":
            rows = [{k: v for k, v in r.items() if k != "match_id"} for r in rows]
        (folder / f"{m['match_id']}.json").write_text(json.dumps(rows))
