"""The match plans on documents that Spark derives from the ``events`` table.

A day is a match between team 1 and team 2, a user a player, and each row an event of the raw schema: clicks are passes and
their receipts, purchases shots, views duels, pressures, recoveries and interceptions, sign-ups starting line-ups and substitutions (by the
next user of the team), errors fouls.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query, text
from matchlytics.functions import date_key
from matchlytics.plans import dimensions as D
from matchlytics.plans import reports as R
from matchlytics.plans import stats as S
from matchlytics.plans.enrich import enrich_birth_year
from matchlytics.plans.facts import fact_event


def _named(name):
    return F.struct(F.lit(None).cast("bigint").alias("id"), name.alias("name"))


def _of(kind, *fields):
    return F.when(F.col("event_type") == kind, F.struct(*fields))


def events(t):
    v, k, user = F.col("value"), F.col("k"), F.col("user_id")
    no_name = F.lit(None).cast("string")
    rows = t.events.withColumn("k", F.from_json("props", "k bigint")["k"])
    named_user = F.struct(user.alias("id"), F.concat(F.lit("U"), user).alias("name"))
    kinds = {"click": "Pass", "purchase": "Shot", "view": "Duel", "signup": "Starting XI", "error": "Foul Committed"}
    special = {("view", 0): "Pressure", ("view", 1): "Ball Recovery", ("view", 2): "Interception", ("signup", 0): "Substitution", ("click", 9): "Ball Receipt*"}
    kind = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])[F.col("event_type")]
    for (event_type, digit), name in special.items():
        kind = F.when((F.col("event_type") == event_type) & (k % 10 == digit), name).otherwise(kind)
    pattern = F.floor(k / 25)
    point = F.array(F.least(v * 1.5, F.lit(120.0)), k * 0.8)
    card = F.when(v > 200, "Red Card").when(v > 100, "Yellow Card").otherwise(no_name)
    nowhere = F.lit(None).cast("array<double>")
    return rows.select(
        date_key("ts").cast("bigint").alias("match_id"),
        F.to_date("ts").alias("date"),
        F.col("event_id").cast("string").alias("id"),
        F.col("event_id").alias("index"),
        F.when(F.hour("ts") < 12, 1).otherwise(2).cast("bigint").alias("period"),
        F.date_format("ts", "HH:mm:ss.SSS").alias("timestamp"),
        (F.hour("ts") * 60 + F.minute("ts")).cast("bigint").alias("minute"),
        F.second("ts").cast("bigint").alias("second"),
        _named(kind).alias("type"),
        k.alias("possession"),
        F.struct(pattern.alias("id"), F.concat(F.lit("P"), pattern).alias("name")).alias("play_pattern"),
        F.struct((user.bitwiseAND(1) + 1).alias("id"), no_name.alias("name")).alias("team"),
        named_user.alias("player"),
        F.array(k * 1.2, F.least(v, F.lit(80.0))).alias("location"),
        v.alias("duration"),
        F.when(k >= 50, True).alias("under_pressure"),
        F.when(
            kind == "Pass",
            F.struct(
                v.alias("length"),
                (k / 100).alias("angle"),
                point.alias("end_location"),
                F.when(v > 100, True).alias("goal_assist"),
                _named(F.when(v < 20, "Incomplete")).alias("outcome"),
            ),
        ).alias("pass"),
        _of(
            "purchase",
            (v * 0.0013579).alias("statsbomb_xg"),
            F.array(F.lit(120.0), F.lit(40.0)).alias("end_location"),
            _named(F.when(v > 100, "Goal").otherwise("Saved")).alias("outcome"),
        ).alias("shot"),
        F.struct(nowhere.alias("end_location")).alias("carry"),
        F.struct(nowhere.alias("end_location")).alias("goalkeeper"),
        F.when(
            kind == "Duel",
            F.struct(_named(F.when(v > 5, "Tackle")).alias("type"), _named(F.when(v > 50, "Won").otherwise("Lost")).alias("outcome")),
        ).alias("duel"),
        F.when(kind == "Substitution", F.struct(F.struct((user + 2).alias("id"), no_name.alias("name")).alias("replacement"))).alias("substitution"),
        F.when(
            kind == "Starting XI", F.struct((pattern + 400).alias("formation"), F.array(F.struct(named_user.alias("player"))).alias("lineup"))
        ).alias("tactics"),
        F.struct(_named(no_name).alias("card")).alias("bad_behaviour"),
        _of("error", _named(card).alias("card")).alias("foul_committed"),
    )


def matches(t):
    goal = (F.col("event_type") == "purchase") & (F.col("value") > 100)
    odd = F.col("user_id").bitwiseAND(1) == 1
    days = t.events.groupBy(F.to_date("ts").alias("day")).agg(
        F.count_if(goal & ~odd).alias("home_score"),
        F.count_if(goal & odd).alias("away_score"),
        F.min(F.col("user_id").bitwiseAND(1) + 1).alias("home_id"),
        F.max(F.col("user_id").bitwiseAND(1) + 1).alias("away_id"),
    )

    def team(side, manager):
        id = F.col(f"{side}_id")
        name = F.concat(F.lit("Team "), id)
        managers = F.array(_named(manager)).alias("managers")
        return F.struct(id.alias(f"{side}_team_id"), name.alias(f"{side}_team_name"), managers).alias(f"{side}_team")

    return days.select(
        date_key("day").cast("bigint").alias("match_id"),
        text("day").alias("match_date"),
        F.lit("20:45:00.000").alias("kick_off"),
        F.struct(F.date_format("day", "yyyy").alias("season_name")).alias("season"),
        F.struct(F.lit("League").alias("competition_name")).alias("competition"),
        _named(F.lit("Regular Season")).alias("competition_stage"),
        F.dayofmonth("day").cast("bigint").alias("match_week"),
        team("home", F.concat(F.lit("M"), text(F.date_trunc("week", "day")))),
        team("away", F.lit("B")),
        "home_score",
        "away_score",
        _named(F.concat(F.lit(" Ground "), F.dayofweek("day"))).alias("stadium"),
        _named(F.lit("R")).alias("referee"),
    )


def lineups(t):
    """A row per player and day, so that no line-up is collected."""
    listed = t.events.select(date_key("ts").cast("bigint").alias("match_id"), "user_id").distinct()
    team = F.col("user_id").bitwiseAND(1) + 1
    position = F.when(team == 1, F.array(F.struct(F.lit("Left Center Forward").alias("position"))))
    empty = F.array().cast("array<struct<position: string>>")
    return listed.select(
        "match_id",
        team.alias("team_id"),
        F.concat(F.lit("Team "), team).alias("team_name"),
        F.array(
            F.struct(
                F.col("user_id").alias("player_id"),
                F.concat(F.lit("U"), "user_id").alias("player_name"),
                _named(F.lit("Spain")).alias("country"),
                F.coalesce(position, empty).alias("positions"),
            )
        ).alias("lineup"),
    )


class Star:
    def __init__(self, t):
        # The dimensions are tables in a warehouse; here they are cached, as each plan meets them several times.
        self.events, self.matches = events(t), matches(t)
        self.teams = D.team_dim(self.matches).persist()
        self.players = D.player_dim(lineups(t), self.matches).persist()
        self.match_dim = D.match_dim(self.matches, self.teams).persist()

    def player_stats(self):
        return S.player_match_stats(self.events, self.match_dim, self.teams, self.players)

    def team_stats(self):
        return S.team_match_stats(self.events, self.match_dim, self.teams)


BASE_SQL = """
    e AS (SELECT CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_id, CAST(ts AS DATE) AS day, event_id AS idx, (user_id & 1) + 1 AS team,
                 user_id AS player, value AS v, CAST(json_extract(props, '$.k') AS BIGINT) AS k, ts,
                 CASE WHEN event_type = 'view' AND k % 10 = 0 THEN 'pressure' WHEN event_type = 'view' AND k % 10 = 1 THEN 'recovery'
                      WHEN event_type = 'view' AND k % 10 = 2 THEN 'interception' WHEN event_type = 'signup' AND k % 10 = 0 THEN 'substitution'
                      WHEN event_type = 'click' AND k % 10 = 9 THEN 'receipt' ELSE event_type END AS kind,
                 CASE WHEN hour(ts) < 12 THEN 1 ELSE 2 END AS period, hour(ts) * 60 + minute(ts) AS minute FROM events),
    days AS (SELECT day, date_id, count(*) FILTER (kind = 'purchase' AND v > 100 AND team = 1) AS home_score,
                    count(*) FILTER (kind = 'purchase' AND v > 100 AND team = 2) AS away_score FROM e GROUP BY ALL),
    obs AS (SELECT 1 AS team, day, 'M' || strftime(date_trunc('week', day), '%Y-%m-%d') AS manager FROM days
            UNION ALL SELECT 2, day, 'B' FROM days),
    tv AS (SELECT team, manager, min(day) AS f FROM obs GROUP BY ALL),
    teams AS (SELECT *, md5(concat_ws('~', coalesce(length(CAST(team AS VARCHAR)) || ':' || CAST(team AS VARCHAR), '-'), coalesce(length(CAST(f AS VARCHAR)) || ':' || CAST(f AS VARCHAR), '-'))) AS team_sk, coalesce(lead(f) OVER (PARTITION BY team ORDER BY f) - 1, DATE '9999-12-31') AS u FROM tv),
    players AS (SELECT player, team, min(day) AS f, md5(concat_ws('~', coalesce(length(CAST(player AS VARCHAR)) || ':' || CAST(player AS VARCHAR), '-'), coalesce(length(CAST(min(day) AS VARCHAR)) || ':' || CAST(min(day) AS VARCHAR), '-'))) AS player_sk FROM e GROUP BY player, team),
    games AS (SELECT d.*, md5(concat_ws('~', coalesce(length(CAST(date_id AS VARCHAR)) || ':' || CAST(date_id AS VARCHAR), '-'))) AS match_sk, h.team_sk AS home_sk, a.team_sk AS away_sk FROM days d
              JOIN teams h ON h.team = 1 AND day BETWEEN h.f AND h.u JOIN teams a ON a.team = 2 AND day BETWEEN a.f AND a.u)"""
TEAM_STATS_SQL = """
    tm AS (SELECT date_id, team, count(*) FILTER (kind = 'click') AS passes, count(*) FILTER (kind IN ('view', 'error', 'pressure', 'interception')) AS actions,
                  count(*) FILTER (kind = 'click' AND k * 1.2::DOUBLE >= 40) AS passes_high,
                  count(*) FILTER (kind IN ('view', 'error', 'pressure', 'interception') AND k * 1.2::DOUBLE >= 40) AS actions_high,
                  sum(CAST(CASE WHEN kind = 'purchase' THEN v * 0.0013579::DOUBLE ELSE 0 END AS DECIMAL(18,10))) AS xg,
                  sum(CAST(v AS DECIMAL(18,6))) AS ball FROM e GROUP BY ALL),
    ts AS (SELECT date_id, g.match_sk, tm.team, CASE WHEN team = 1 THEN home_sk ELSE away_sk END AS team_sk,
                  CASE WHEN team = 1 THEN away_sk ELSE home_sk END AS opponent_team_sk, team = 1 AS is_home,
                  CAST(CAST(ball AS DOUBLE) / CAST(sum(ball) OVER w AS DOUBLE) * 100 AS DECIMAL(5,2)) AS possession_pct,
                  CAST((sum(passes) OVER w - passes) / nullif(actions, 0) AS DECIMAL(18,2)) AS ppda,
                  CAST((sum(passes_high) OVER w - passes_high) / nullif(actions_high, 0) AS DECIMAL(18,2)) AS ppda_high,
                  CAST(xg AS DECIMAL(18,3)) AS total_xg, CAST(sum(xg) OVER w - xg AS DECIMAL(18,3)) AS conceded_xg,
                  CAST(CASE WHEN team = 1 THEN home_score ELSE away_score END AS INTEGER) AS goals_scored,
                  CAST(CASE WHEN team = 1 THEN away_score ELSE home_score END AS INTEGER) AS goals_conceded
           FROM tm JOIN games g USING (date_id) WINDOW w AS (PARTITION BY date_id)),
    tstats AS (SELECT *, CASE WHEN goals_scored > goals_conceded THEN 'W' WHEN goals_scored < goals_conceded THEN 'L' ELSE 'D' END AS result FROM ts)"""
PLAYER_STATS_SQL = """
    nx AS (SELECT date_id, player, kind, lead(kind) OVER w AS next_kind, lead(v) OVER w AS next_v, team, period, lead(team) OVER w AS next_team,
                  lead(period) OVER w AS next_period FROM e WHERE kind <> 'receipt'
           WINDOW w AS (PARTITION BY date_id ORDER BY idx)),
    xa AS (SELECT date_id, player, sum(CAST(next_v * 0.0013579::DOUBLE AS DECIMAL(18,10))) AS xa FROM nx
           WHERE kind = 'click' AND next_kind = 'purchase' AND team = next_team AND period = next_period GROUP BY ALL),
    ends AS (SELECT date_id, max(minute) AS end_min FROM e GROUP BY ALL),
    mv AS (SELECT date_id, player, 0 AS entry_min, NULL AS exit_min, 1 AS starts FROM e WHERE kind = 'signup'
           UNION ALL SELECT date_id, player + 2, minute, NULL, 0 FROM e WHERE kind = 'substitution'
           UNION ALL SELECT date_id, player, NULL, minute, 0 FROM e WHERE kind = 'substitution' OR (kind = 'error' AND v > 200)),
    sp AS (SELECT date_id, player, min(entry_min) AS entry_min, min(exit_min) AS exit_min, max(starts) AS starts FROM mv
           GROUP BY ALL HAVING min(entry_min) IS NOT NULL),
    pm AS (SELECT date_id, team, player, count(*) FILTER (kind = 'interception') AS interceptions,
                  count(*) FILTER (kind = 'click') AS total_passes, count(*) FILTER (kind = 'click' AND v >= 20) AS accurate_passes,
                  count(*) FILTER (kind = 'purchase') AS total_shots, count(*) FILTER (kind = 'purchase' AND v > 100) AS goals,
                  count(*) FILTER (kind = 'click' AND v > 100) AS assists,
                  count(*) FILTER (k * 1.2::DOUBLE >= 102 AND least(v, 80.0::DOUBLE) BETWEEN 18 AND 62) AS touches_in_box,
                  count(*) FILTER (kind = 'view' AND v > 5) AS tackles_total, count(*) FILTER (kind = 'view' AND v > 50) AS tackles_won,
                  count(*) FILTER (kind = 'error' AND v > 100 AND v <= 200) AS yellow_cards, count(*) FILTER (kind = 'error' AND v > 200) AS red_cards,
                  sum(CAST(CASE WHEN kind = 'purchase' THEN v * 0.0013579::DOUBLE ELSE 0 END AS DECIMAL(18,10))) AS xg FROM e GROUP BY ALL),
    pstats AS (SELECT pm.date_id, p.player_sk, g.match_sk, t.team_sk, CAST(greatest(0, coalesce(exit_min, end_min) - entry_min) AS INTEGER) AS minutes_played,
                  CAST(total_passes AS INTEGER) AS total_passes, CAST(accurate_passes AS INTEGER) AS accurate_passes,
                  CAST(total_shots AS INTEGER) AS total_shots, CAST(goals AS INTEGER) AS goals, CAST(assists AS INTEGER) AS assists,
                  CAST(interceptions AS INTEGER) AS interceptions, CAST(touches_in_box AS INTEGER) AS touches_in_box,
                  CAST(tackles_total AS INTEGER) AS tackles_total, CAST(tackles_won AS INTEGER) AS tackles_won, CAST(starts AS INTEGER) AS starts,
                  CAST(yellow_cards AS INTEGER) AS yellow_cards, CAST(red_cards AS INTEGER) AS red_cards,
                  CAST(xg AS DECIMAL(18,3)) AS xg_total, CAST(coalesce(xa, 0) AS DECIMAL(18,3)) AS xa_total
           FROM pm JOIN sp USING (date_id, player) JOIN ends USING (date_id) JOIN games g USING (date_id) JOIN players p USING (player)
                JOIN teams t ON t.team = pm.team AND g.day BETWEEN t.f AND t.u LEFT JOIN xa USING (date_id, player))"""


def doubles(df, *columns):
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


@query(f"""
    WITH {BASE_SQL}
    SELECT team_sk, CAST(team AS VARCHAR) AS team_natural_id, 'Team ' || team AS kaggle_team_name, 'Team ' || team AS team_name,
           manager AS manager_name, CASE WHEN team = 1 THEN ' Ground ' || (dayofweek(f) + 1) END AS home_stadium,
           strftime(f, '%Y-%m-%d') AS effective_from, strftime(u, '%Y-%m-%d') AS effective_to, u = DATE '9999-12-31' AS is_current
    FROM teams""")
def q60_team_dimension(t):
    versions = D.team_dim(matches(t))
    return versions.withColumns({c: text(c) for c in ("effective_from", "effective_to")})


@query(f"""
    WITH {BASE_SQL}
    SELECT player_sk, CAST(player AS VARCHAR) AS player_natural_id, 'U' || player AS player_name,
           CASE WHEN team = 1 THEN 'Forward' ELSE 'Unknown' END AS position_group,
           CASE WHEN team = 1 THEN 'Left Center Forward' END AS specific_position, 'Team ' || team AS team_name, 'Spain' AS nationality,
           strftime(f, '%Y-%m-%d') AS effective_from, TRUE AS is_current, 'U' || player AS kaggle_name, CAST(NULL AS INTEGER) AS birth_year,
           '9999-12-31' AS effective_to, CAST(team AS BIGINT) AS team_id
    FROM players""")
def q61_player_dimension(t):
    versions = D.player_dim(lineups(t), matches(t))
    return versions.withColumns({c: text(c) for c in ("effective_from", "effective_to")})


@query(f"""
    WITH {BASE_SQL}
    SELECT match_sk, CAST(date_id AS VARCHAR) AS match_natural_id, strftime(day, '%Y') AS season, strftime(day, '%Y-%m-%d') AS match_date,
           strftime(day, '%Y-%m-%d') || ' 20:45' AS kickoff, home_sk AS home_team_sk, away_sk AS away_team_sk,
           CAST(home_score AS INTEGER) AS home_score, CAST(away_score AS INTEGER) AS away_score, 'Ground ' || (dayofweek(day) + 1) AS stadium,
           CAST(day(day) AS INTEGER) AS round
    FROM games""")
def q62_match_dimension(t):
    games = matches(t)
    dim = D.match_dim(games, D.team_dim(games))
    return dim.select(
        "match_sk", "match_natural_id", "season", text("match_date").alias("match_date"),
        F.date_format("kickoff_time", "yyyy-MM-dd HH:mm").alias("kickoff"), "home_team_sk", "away_team_sk",
        "home_score", "away_score", "stadium", "round",
    )


def _zone_sql(x, y):
    return f"""CASE WHEN {x} >= 102 AND {y} >= 18 AND {y} <= 62 THEN 19 WHEN {x} IS NULL OR {y} IS NULL THEN NULL
      ELSE 3 * (CASE WHEN {x} < 20 THEN 0 WHEN {x} < 40 THEN 1 WHEN {x} < 60 THEN 2 WHEN {x} < 80 THEN 3 WHEN {x} < 100 THEN 4 ELSE 5 END)
         + (CASE WHEN {y} < 26.6 THEN 1 WHEN {y} < 53.3 THEN 2 ELSE 3 END) END"""


FACT_SQL = f"""
    f AS (SELECT e.*, k * 1.2::DOUBLE AS x, least(v, 80.0::DOUBLE) AS y,
                 CASE kind WHEN 'click' THEN least(v * 1.5, 120.0::DOUBLE) WHEN 'purchase' THEN 120.0::DOUBLE END AS ex,
                 CASE kind WHEN 'click' THEN k * 0.8::DOUBLE WHEN 'purchase' THEN 40.0::DOUBLE END AS ey,
                 CASE kind WHEN 'click' THEN 'Pass' WHEN 'purchase' THEN 'Shot' WHEN 'view' THEN 'Duel' WHEN 'signup' THEN 'Starting XI'
                           WHEN 'pressure' THEN 'Pressure' WHEN 'recovery' THEN 'Ball Recovery' WHEN 'interception' THEN 'Interception'
                           WHEN 'substitution' THEN 'Substitution' WHEN 'receipt' THEN 'Ball Receipt*' ELSE 'Foul Committed' END AS type,
                 CASE kind WHEN 'click' THEN CASE WHEN v < 20 THEN 'Incomplete' END
                           WHEN 'purchase' THEN CASE WHEN v > 100 THEN 'Goal' ELSE 'Saved' END
                           WHEN 'view' THEN CASE WHEN v > 50 THEN 'Won' ELSE 'Lost' END END AS outcome,
                 hour(ts) * 3600 + minute(ts) * 60 + CAST(millisecond(ts) AS DECIMAL(18,3)) / 1000 AS s
          FROM e)"""


@query(f"""
    WITH {BASE_SQL},
    {FACT_SQL}
    SELECT f.date_id, g.match_sk, t.team_sk, md5(concat_ws('~', coalesce(length(CAST(type AS VARCHAR)) || ':' || CAST(type AS VARCHAR), '-'), coalesce(length(CAST(outcome AS VARCHAR)) || ':' || CAST(outcome AS VARCHAR), '-'))) AS event_type_sk,
           md5(concat_ws('~', coalesce(length(CAST(k // 25 AS VARCHAR)) || ':' || CAST(k // 25 AS VARCHAR), '-'))) AS play_pattern_sk, CAST({_zone_sql('x', 'y')} AS INTEGER) AS location_id,
           CAST({_zone_sql('ex', 'ey')} AS INTEGER) AS end_location_id, count(*) AS events, count(DISTINCT p.player_sk) AS players,
           CAST(sum(CAST(x AS DECIMAL(5,2))) AS DOUBLE) AS x, CAST(sum(CAST(ey AS DECIMAL(5,2))) AS DOUBLE) AS end_y,
           round(CAST(sum(CAST(s AS DECIMAL(10,3))) FILTER (s <= 18000) AS DOUBLE), 3) AS seconds,
           CAST(sum(CAST(CASE WHEN kind = 'purchase' THEN v * 0.0013579::DOUBLE END AS DECIMAL(6,4))) AS DOUBLE) AS xg,
           CAST(sum(CAST(CASE WHEN kind = 'click' THEN k / 100 END AS DECIMAL(6,4))) AS DOUBLE) AS angle,
           count(*) FILTER (k >= 50) AS under_pressure, CAST(sum(period) AS BIGINT) AS periods, CAST(sum(minute) AS BIGINT) AS minutes,
           CAST(sum(second(ts)) AS BIGINT) AS in_minute, CAST(sum(CAST(v AS DECIMAL(10,3))) AS DOUBLE) AS duration,
           CAST(sum(CAST(CASE WHEN kind = 'click' THEN v END AS DECIMAL(6,2))) AS DOUBLE) AS pass_length, CAST(sum(k) AS BIGINT) AS possessions,
           CAST(sum(idx) AS BIGINT) AS ids, CAST(sum(CAST(y AS DECIMAL(5,2))) AS DOUBLE) AS y, CAST(sum(CAST(CAST(ex AS VARCHAR) AS DECIMAL(5,2))) AS DOUBLE) AS end_x,
           CAST(0 AS BIGINT) AS rejected
    FROM f JOIN games g USING (date_id) JOIN teams t ON t.team = f.team AND f.day BETWEEN t.f AND t.u JOIN players p ON p.player = f.player
    GROUP BY ALL""")
def q63_event_fact(t):
    s = Star(t)
    facts = fact_event(s.events, s.match_dim, s.teams, s.players, D.event_type_dim(s.events), D.play_pattern_dim(s.events))
    keys = ["date_id", "match_sk", "team_sk", "event_type_sk", "play_pattern_sk", "location_id", "end_location_id"]
    return facts.groupBy(*keys).agg(
        F.count("*").alias("events"),
        F.countDistinct("player_sk").alias("players"),
        F.sum("location_x").cast("double").alias("x"),
        F.sum("end_location_y").cast("double").alias("end_y"),
        F.round(F.sum("event_relative_time").cast("double"), 3).alias("seconds"),
        F.sum("shot_xg").cast("double").alias("xg"),
        F.sum("pass_angle").cast("double").alias("angle"),
        F.count_if("under_pressure").alias("under_pressure"),
        F.sum("period").alias("periods"),
        F.sum("minute").alias("minutes"),
        F.sum("second").alias("in_minute"),
        F.sum("duration").cast("double").alias("duration"),
        F.sum("pass_length").cast("double").alias("pass_length"),
        F.sum(F.col("possession_id").cast("bigint")).alias("possessions"),
        F.sum(F.col("event_id").cast("bigint")).alias("ids"),
        F.sum("location_y").cast("double").alias("y"),
        F.sum("end_location_x").cast("double").alias("end_x"),
        F.count("reject_reason").alias("rejected"),
    )


@query(f"""
    WITH {BASE_SQL}, {PLAYER_STATS_SQL}
    SELECT * REPLACE (CAST(xg_total AS DOUBLE) AS xg_total, CAST(xa_total AS DOUBLE) AS xa_total) FROM pstats""")
def q64_player_match_stats(t):
    return doubles(Star(t).player_stats(), "xg_total", "xa_total")


@query(f"""
    WITH {BASE_SQL}, {TEAM_STATS_SQL}
    SELECT * EXCLUDE (team) REPLACE (CAST(possession_pct AS DOUBLE) AS possession_pct, CAST(ppda AS DOUBLE) AS ppda,
             CAST(ppda_high AS DOUBLE) AS ppda_high, CAST(total_xg AS DOUBLE) AS total_xg, CAST(conceded_xg AS DOUBLE) AS conceded_xg)
    FROM tstats""")
def q65_team_match_stats(t):
    return doubles(Star(t).team_stats(), "possession_pct", "ppda", "ppda_high", "total_xg", "conceded_xg")


@query(f"""
    WITH {BASE_SQL}, {PLAYER_STATS_SQL}
    SELECT player_sk, team_sk, CAST(date_id // 10000 AS VARCHAR) AS season, CAST(count(*) AS INTEGER) AS matches_played,
           CAST(sum(minutes_played) AS INTEGER) AS minutes, CAST(sum(goals) AS INTEGER) AS goals, CAST(sum(assists) AS INTEGER) AS assists,
           CAST(sum(interceptions) AS INTEGER) AS interceptions, CAST(sum(touches_in_box) AS INTEGER) AS touches_in_box,
           CAST(sum(tackles_total) AS INTEGER) AS tackles_total, CAST(sum(tackles_won) AS INTEGER) AS tackles_won,
           CAST(sum(starts) AS INTEGER) AS starts, CAST(sum(yellow_cards) AS INTEGER) AS yellow_cards,
           CAST(sum(red_cards) AS INTEGER) AS red_cards, CAST(sum(xg_total) AS DOUBLE) AS xg_season, CAST(sum(xa_total) AS DOUBLE) AS xa_season
    FROM pstats GROUP BY ALL""")
def q66_season_stats(t):
    s = Star(t)
    return doubles(S.season_stats(s.player_stats(), s.match_dim), "xg_season", "xa_season")


@query(f"""
    WITH {BASE_SQL},
    p AS (SELECT date_id, team, period, count(*) FILTER (kind = 'pressure') AS pressures, count(*) FILTER (kind = 'recovery') AS recoveries,
                 sum(CAST(CASE WHEN kind = 'purchase' THEN v * 0.0013579::DOUBLE ELSE 0 END AS DECIMAL(18,10))) AS xg,
                 sum(CAST(v AS DECIMAL(18,6))) AS ball FROM e GROUP BY GROUPING SETS ((date_id, team, period), (date_id, team)))
    SELECT CAST(date_id AS VARCHAR) AS match_natural_id, CAST(team AS VARCHAR) AS team_natural_id, CAST(period AS BIGINT) AS period,
           pressures, recoveries,
           round(CAST(ball AS DOUBLE) / CAST(sum(ball) OVER w AS DOUBLE) * 100, 4) AS possession_pct,
           CAST(CAST(xg AS DECIMAL(18,3)) AS DOUBLE) AS xg_for, CAST(CAST(sum(xg) OVER w - xg AS DECIMAL(18,3)) AS DOUBLE) AS xg_against
    FROM p WINDOW w AS (PARTITION BY date_id, period)""")
def q67_match_phases(t):
    phases = doubles(R.match_phases(events(t)), "xg_for", "xg_against")
    return phases.withColumn("possession_pct", F.round("possession_pct", 4))


@query(f"""
    WITH {BASE_SQL}, {TEAM_STATS_SQL}, {PLAYER_STATS_SQL}
    SELECT p.match_sk, p.team_sk, p.player_sk, minutes_played, round(goals - CAST(xg_total AS DOUBLE), 4) AS g_minus_xg,
           round(CAST(touches_in_box AS DOUBLE) / nullif(minutes_played, 0) * 90, 4) AS touches_in_box_90,
           round(CAST(interceptions AS DOUBLE) / nullif(minutes_played, 0) * 90, 4) AS interceptions_90,
           round(CAST(tackles_won AS DOUBLE) / nullif(tackles_total, 0) * 100, 4) AS tackle_success_pct,
           round(CAST(accurate_passes AS DOUBLE) / nullif(total_passes, 0) * 100, 4) AS pass_accuracy_pct,
           round(CAST(interceptions AS DOUBLE) / nullif(minutes_played, 0) * 90
                 * ((100 - CAST(possession_pct AS DOUBLE)) / nullif(CAST(possession_pct AS DOUBLE), 0)), 4) AS padj_interceptions_90
    FROM pstats p JOIN tstats t ON p.match_sk = t.match_sk AND p.team_sk = t.team_sk""")
def q68_player_performance(t):
    s = Star(t)
    report = R.player_performance(s.player_stats(), s.team_stats())
    ratios = [c for c in report.columns if c.endswith(("_90", "_pct", "_xg"))]
    return report.withColumns({c: F.round(c, 4) for c in ratios})


@query(f"""
    WITH {BASE_SQL}, {TEAM_STATS_SQL}
    SELECT CAST(team AS VARCHAR) AS team_natural_id, date_id, match_sk, result, goals_scored, goals_conceded,
           CAST(total_xg AS DOUBLE) AS total_xg, count(*) FILTER (result = 'W') OVER w AS recent_wins,
           count(*) FILTER (result = 'D') OVER w AS recent_draws, count(*) FILTER (result = 'L') OVER w AS recent_losses,
           CAST(sum(goals_scored) OVER w AS BIGINT) AS recent_goals, CAST(sum(total_xg) OVER w AS DOUBLE) AS recent_xg
    FROM tstats WINDOW w AS (PARTITION BY team ORDER BY date_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""")
def q69_team_form(t):
    s = Star(t)
    return doubles(R.team_form(s.team_stats(), s.teams), "total_xg", "recent_xg")


@query(f"""
    WITH {BASE_SQL}, {TEAM_STATS_SQL}
    SELECT CAST(team AS VARCHAR) AS team_natural_id, CAST(3 - team AS VARCHAR) AS opponent_natural_id, count(*) AS matches,
           count(*) FILTER (result = 'W') AS wins, count(*) FILTER (result = 'D') AS draws, count(*) FILTER (result = 'L') AS losses,
           CAST(sum(goals_scored) AS BIGINT) AS goals_scored, CAST(sum(goals_conceded) AS BIGINT) AS goals_conceded,
           round(CAST(avg(possession_pct) AS DOUBLE), 3) AS avg_possession_pct, round(CAST(avg(ppda) AS DOUBLE), 3) AS avg_ppda,
           round(CAST(avg(total_xg) AS DOUBLE), 3) AS avg_total_xg
    FROM tstats GROUP BY team""")
def q70_head_to_head(t):
    s = Star(t)
    report = R.head_to_head(s.team_stats(), s.teams)
    return report.withColumns({c: F.round(F.col(c).cast("double"), 3) for c in report.columns if c.startswith("avg_")})


@query(f"""
    WITH {BASE_SQL}, {PLAYER_STATS_SQL},
    s AS (SELECT player_sk, sum(goals) AS goals, sum(minutes_played) AS minutes, count(*) AS matches FROM pstats GROUP BY ALL),
    r AS (SELECT p.player, s.goals, s.minutes, s.matches, CAST(s.goals AS DOUBLE) / nullif(s.minutes, 0) * 90 AS per_90,
                 CASE WHEN team = 1 THEN 'Forward' ELSE 'Unknown' END AS position_group FROM s JOIN players p USING (player_sk))
    SELECT CAST(player AS VARCHAR) AS player_natural_id, position_group, matches, CAST(minutes AS BIGINT) AS minutes,
           round(per_90, 4) AS per_90, rank() OVER w AS rank, round(percent_rank() OVER w, 6) AS percentile
    FROM r WINDOW w AS (PARTITION BY position_group ORDER BY per_90 DESC NULLS LAST)""")
def q71_scouting(t):
    s = Star(t)
    shortlist = R.scouting(s.player_stats(), s.match_dim, s.players, "goals", bucket_width=0.01)
    return shortlist.select(
        "player_natural_id", "position_group", "matches", "minutes", F.round("per_90", 4).alias("per_90"),
        F.col("rank").cast("bigint").alias("rank"), F.round("percentile", 6).alias("percentile"),
    )


@query(f"""
    WITH {BASE_SQL}, {PLAYER_STATS_SQL},
    g AS (SELECT player, date_id, sum(goals) AS on_day, sum(sum(goals)) OVER (PARTITION BY player ORDER BY date_id) AS total
          FROM pstats JOIN players USING (player_sk) GROUP BY player, date_id),
    m AS (SELECT * FROM (VALUES (1), (3)) AS x(threshold))
    SELECT CAST(player AS VARCHAR) AS player_natural_id, CAST(threshold AS INTEGER) AS threshold, date_id, CAST(total AS BIGINT) AS total
    FROM g, m WHERE total >= threshold AND total - on_day < threshold""")
def q72_goal_milestones(t):
    s = Star(t)
    return R.milestones(s.player_stats(), s.players, [1, 3])


@query(f"""
    WITH {BASE_SQL}, {PLAYER_STATS_SQL},
    s AS (SELECT t.team, p.player, CAST(sum(goals) AS BIGINT) AS goals FROM pstats x JOIN players p USING (player_sk) JOIN teams t ON t.team_sk = x.team_sk
          GROUP BY ALL)
    SELECT '2024' AS season, CAST(team AS VARCHAR) AS team_natural_id, CAST(player AS VARCHAR) AS player_natural_id, 'U' || player AS player_name,
           goals, CAST(row_number() OVER (PARTITION BY team ORDER BY goals DESC, CAST(player AS VARCHAR)) AS INTEGER) AS position
    FROM s QUALIFY position <= 3""")
def q73_key_players(t):
    s = Star(t)
    return R.key_players(S.season_stats(s.player_stats(), s.match_dim), s.players, s.teams, "goals", 3)


@query(f"""
    WITH {BASE_SQL}, {TEAM_STATS_SQL}
    SELECT CAST(e.team AS VARCHAR) AS team_natural_id, 400 + k // 25 AS formation, count(*) AS matches,
           count(*) FILTER (result = 'W') AS wins, count(*) FILTER (result = 'D') AS draws, count(*) FILTER (result = 'L') AS losses,
           round(avg(goals_scored), 4) AS avg_goals
    FROM e JOIN tstats s ON s.date_id = e.date_id AND s.team = e.team WHERE kind = 'signup' GROUP BY ALL""")
def q74_formation_usage(t):
    s = Star(t)
    usage = R.formation_usage(s.events, s.match_dim, s.teams, s.team_stats())
    return usage.withColumn("avg_goals", F.round("avg_goals", 4))


@query(f"""
    WITH {BASE_SQL}
    SELECT 'P' || (k // 25) AS play_pattern, count(*) AS shots, count(*) FILTER (v > 100) AS goals,
           CAST(CAST(sum(CAST(v * 0.0013579::DOUBLE AS DECIMAL(18,10))) AS DECIMAL(12,3)) AS DOUBLE) AS xg,
           round(count(*) FILTER (v > 100) / count(*) * 100, 4) AS conversion_pct
    FROM e WHERE kind = 'purchase' GROUP BY 1""")
def q75_play_pattern_effect(t):
    effect = doubles(R.play_pattern_effect(events(t)), "xg")
    return effect.withColumn("conversion_pct", F.round("conversion_pct", 4))


@query(f"""
    WITH {BASE_SQL},
    {FACT_SQL}
    SELECT f.date_id, g.match_sk, t.team_sk, type AS event_type, outcome, CAST({_zone_sql('x', 'y')} AS INTEGER) AS location_id, count(*) AS events,
           CAST(sum(CAST(x AS DECIMAL(5,2))) AS DOUBLE) AS x, CAST(sum(CAST(y AS DECIMAL(5,2))) AS DOUBLE) AS y,
           CAST(sum(CAST(CASE WHEN kind = 'purchase' THEN v * 0.0013579::DOUBLE END AS DECIMAL(6,4))) AS DOUBLE) AS xg
    FROM f JOIN games g USING (date_id) JOIN teams t ON t.team = f.team AND f.day BETWEEN t.f AND t.u
    WHERE type IN ('Shot', 'Pressure', 'Duel', 'Interception') GROUP BY ALL""")
def q76_event_map(t):
    s = Star(t)
    types = D.event_type_dim(s.events)
    facts = fact_event(s.events, s.match_dim, s.teams, s.players, types, D.play_pattern_dim(s.events))
    located = R.event_map(facts, types, ["Shot", "Pressure", "Duel", "Interception"])
    return located.groupBy("date_id", "match_sk", "team_sk", "event_type", "outcome", "location_id").agg(
        F.count("*").alias("events"),
        F.sum("location_x").cast("double").alias("x"),
        F.sum("location_y").cast("double").alias("y"),
        F.sum("shot_xg").cast("double").alias("xg"),
    )


@query(f"""
    WITH {BASE_SQL},
    n AS (SELECT date_id, team, player, kind, lead(kind) OVER w AS next_kind, lead(team) OVER w AS next_team, lead(player) OVER w AS receiver
          FROM e WINDOW w AS (PARTITION BY date_id ORDER BY idx))
    SELECT CAST(date_id AS VARCHAR) AS match_natural_id, CAST(team AS VARCHAR) AS team_natural_id, CAST(player AS VARCHAR) AS passer,
           CAST(receiver AS VARCHAR) AS receiver, count(*) AS passes
    FROM n WHERE kind = 'click' AND next_kind = 'receipt' AND team = next_team GROUP BY ALL""")
def q77_pass_network(t):
    return R.pass_network(events(t))


@query(f"""
    WITH {BASE_SQL}, {TEAM_STATS_SQL}
    SELECT CAST(team AS VARCHAR) AS team_natural_id, is_home, count(*) AS matches, count(*) FILTER (result = 'W') AS wins,
           round(avg(goals_scored), 3) AS avg_goals_scored, round(avg(goals_conceded), 3) AS avg_goals_conceded,
           round(avg(CAST(total_xg AS DOUBLE)), 3) AS avg_total_xg, round(avg(CAST(possession_pct AS DOUBLE)), 3) AS avg_possession_pct,
           round(avg(CAST(ppda AS DOUBLE)), 3) AS avg_ppda
    FROM tstats GROUP BY team, is_home""")
def q78_home_away(t):
    s = Star(t)
    stats = doubles(s.team_stats(), "total_xg", "possession_pct", "ppda")
    sides = R.home_away(stats, s.teams)
    return sides.withColumns({c: F.round(c, 3) for c in sides.columns if c.startswith("avg_")})


@query(f"""
    WITH {BASE_SQL}
    SELECT player_sk, CAST(player AS VARCHAR) AS player_natural_id,
           CASE WHEN player % 3 = 0 AND 1950 + player % 70 BETWEEN 1960 AND 2010 THEN CAST(1950 + player % 70 AS INTEGER) END AS birth_year
    FROM players""")
def q79_birth_years(t):
    user = F.col("user_id")
    people = t.events.where(user % 3 == 0).select(F.concat(F.lit("U"), user).alias("name"), (F.lit(1950) + user % 70).cast("int").alias("birth_year"))
    return enrich_birth_year(Star(t).players, people.distinct()).select("player_sk", "player_natural_id", "birth_year")
