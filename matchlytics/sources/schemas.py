"""Schemas of the raw JSON kinds, as DDL. Declared, so that no inference pass reads the data and every struct exists."""

_NAMED = "struct<id: bigint, name: string>"
_POINT = "array<double>"

MATCHES = f"""
    match_id bigint, match_date string, kick_off string,
    season struct<season_id: bigint, season_name: string>,
    competition struct<competition_id: bigint, competition_name: string, country_name: string>,
    competition_stage {_NAMED}, match_week bigint,
    home_team struct<home_team_id: bigint, home_team_name: string, managers: array<{_NAMED}>>,
    away_team struct<away_team_id: bigint, away_team_name: string, managers: array<{_NAMED}>>,
    home_score bigint, away_score bigint, stadium {_NAMED}, referee {_NAMED}
"""

LINEUPS = f"""
    team_id bigint, team_name string,
    lineup array<struct<
        player_id: bigint, player_name: string, player_nickname: string, jersey_number: bigint, country: {_NAMED},
        cards: array<struct<time: string, card_type: string, reason: string, period: bigint>>,
        positions: array<struct<
            position_id: bigint, position: string, `from`: string, `to`: string,
            from_period: bigint, to_period: bigint, start_reason: string, end_reason: string>>>>
"""

EVENTS = f"""
    id string, index bigint, period bigint, timestamp string, minute bigint, second bigint,
    type {_NAMED}, possession bigint, possession_team {_NAMED}, play_pattern {_NAMED}, team {_NAMED}, player {_NAMED},
    location {_POINT}, duration double, under_pressure boolean,
    pass struct<length: double, angle: double, end_location: {_POINT}, goal_assist: boolean, outcome: {_NAMED}>,
    shot struct<statsbomb_xg: double, end_location: {_POINT}, outcome: {_NAMED}>,
    carry struct<end_location: {_POINT}>,
    goalkeeper struct<end_location: {_POINT}, outcome: {_NAMED}>,
    duel struct<type: {_NAMED}, outcome: {_NAMED}>,
    substitution struct<replacement: {_NAMED}, outcome: {_NAMED}>,
    tactics struct<formation: bigint, lineup: array<struct<player: {_NAMED}, jersey_number: bigint>>>,
    bad_behaviour struct<card: {_NAMED}>,
    foul_committed struct<card: {_NAMED}>
"""

RAW = {"matches": MATCHES, "lineups": LINEUPS, "events": EVENTS}
