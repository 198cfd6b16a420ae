"""Match and season statistics of players and teams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from matchlytics.functions import date_key, field, in_rect, match_result, rate
from matchlytics.functions import values as V
from matchlytics.operators import cond_counts, flatten, next_value, opponent_total, spans_played, tag_rejects, temporal_lookup
from matchlytics.plans.facts import unmatched

PLAYER_KEYS = ["match_natural_id", "team_natural_id", "player_natural_id"]
# Wide enough for any sum of values below 1e18; totals are stored with three decimals.
XG = "decimal(28,10)"
TOTAL = "decimal(18,3)"
RATIO = "decimal(18,2)"
# Events per window bucket; a match has some 3,500.
INDEX_BUCKET = 10_000


def _measured(events: DataFrame, more: dict[str, str] | None = None) -> DataFrame:
    return flatten(
        events,
        {
            **(more or {}),
            "match_natural_id": F.col("match_id").cast("string"),
            "index": "index",
            "period": "period",
            "minute": "minute",
            "team_natural_id": F.col("team.id").cast("string"),
            "player_natural_id": F.col("player.id").cast("string"),
            "type": "type.name",
            "x": ("location", 0),
            "y": ("location", 1),
            "duration": "duration",
            "pass_outcome": "pass.outcome.name",
            "goal_assist": "pass.goal_assist",
            "shot_outcome": "shot.outcome.name",
            "xg": "shot.statsbomb_xg",
            "duel_type": "duel.type.name",
            "duel_outcome": "duel.outcome.name",
            "card": F.coalesce("bad_behaviour.card.name", "foul_committed.card.name"),
        },
    )


def is_a(event_type: str) -> Column:
    return F.col("type") == event_type


def player_moves(events: DataFrame) -> DataFrame:
    """Entries and exits of players, all out of one pass over the events."""
    minute = F.col("minute")
    nobody = F.array().cast("array<struct<player_id:bigint,entry_min:bigint,exit_min:bigint,starts:int>>")

    def move(player: Column, entry: Column | None = None, exit: Column | None = None, starts: int = 0) -> Column:
        none = F.lit(None).cast("bigint")
        return F.struct(
            player.alias("player_id"),
            (none if entry is None else entry).alias("entry_min"),
            (none if exit is None else exit).alias("exit_min"),
            F.lit(starts).alias("starts"),
        )

    kind = F.col("type.name")
    starters = F.transform("tactics.lineup", lambda p: move(p["player"]["id"], entry=F.lit(0).cast("bigint"), starts=1))
    swap = F.array(
        move(F.col("substitution.replacement.id"), entry=minute), move(F.col("player.id"), exit=minute)
    )
    sent_off = F.col("bad_behaviour.card.name").isin(*V.SENT_OFF) | F.col("foul_committed.card.name").isin(*V.SENT_OFF)
    moves = (
        F.when(kind == "Starting XI", F.coalesce(starters, nobody))
        .when(kind == "Substitution", swap)
        .when(sent_off, F.array(move(F.col("player.id"), exit=minute)))
    )
    relevant = kind.isin("Starting XI", "Substitution") | sent_off
    return (
        events.where(relevant)
        .select(F.col("match_id").cast("string").alias("match_natural_id"), F.inline(moves))
        .withColumn("player_natural_id", F.col("player_id").cast("string"))
        .drop("player_id")
        .where(F.col("player_natural_id").isNotNull())
    )


def minutes_played(events: DataFrame) -> DataFrame:
    """Minutes of every player who started or came on, and whether they started."""
    match = F.col("match_id").cast("string").alias("match_natural_id")
    ends = events.groupBy(match).agg(F.max("minute").alias("end_min"))
    return spans_played(player_moves(events), ends, ["match_natural_id"], ["player_natural_id"], {"starts": F.max("starts")})


def expected_assists(events: DataFrame) -> DataFrame:
    """Per player and match, the xG of the shots that came right after a pass of theirs.

    Receiving and carrying the ball lies between a pass and its shot and is passed over; the shot must be of the same team
    and period.
    """
    rows = _measured(events).select(*PLAYER_KEYS, "index", "period", "type", "xg")
    rows = rows.where(F.col("type").isNull() | ~F.col("type").isin(*V.WITH_THE_BALL))
    following = next_value(
        rows,
        ["match_natural_id"],
        ["index"],
        {"next_type": "type", "next_xg": "xg", "next_team": "team_natural_id", "next_period": "period"},
        bucket=F.floor(F.col("index") / INDEX_BUCKET),
    )
    same = (F.col("next_team") == F.col("team_natural_id")) & F.col("next_period").eqNullSafe(F.col("period"))
    assists = following.where(is_a("Pass") & (F.col("next_type") == "Shot") & same & F.col("player_natural_id").isNotNull())
    return cond_counts(assists, PLAYER_KEYS, sums={"xa": ("next_xg", XG)})


def _player_counts() -> dict[str, Column]:
    a_pass, a_shot = is_a("Pass"), is_a("Shot")
    tackle = is_a("Duel") & (F.col("duel_type") == "Tackle")
    return {
        "total_passes": a_pass,
        "accurate_passes": a_pass & F.col("pass_outcome").isNull(),
        "total_shots": a_shot,
        "goals": a_shot & (F.col("shot_outcome") == "Goal"),
        "assists": F.col("goal_assist"),
        "interceptions": is_a("Interception"),
        "touches_in_box": in_rect("x", "y"),
        "tackles_total": tackle,
        "tackles_won": tackle & F.col("duel_outcome").isin(*V.TACKLE_WON),
        "yellow_cards": F.col("card").isin(*V.BOOKED),
        "red_cards": F.col("card").isin(*V.SENT_OFF),
    }


def player_measures(events: DataFrame) -> DataFrame:
    """The counted measures per match, team and player."""
    return cond_counts(_measured(events).where(F.col("player_natural_id").isNotNull()), PLAYER_KEYS, _player_counts(), {"xg": ("xg", XG)})


def player_totals(events: DataFrame) -> DataFrame:
    """``player_measures`` and ``minutes_played`` of the players who started or came on and have events of their own.

    One scan and one aggregation: an event counts for its own player, and a line-up or substitution also for those it brings
    on. The state of a (match, team, player) holds counts, earliest entry and exit, start flag and latest minute; the match's
    last minute is then the largest of these few rows.
    """
    minute, kind = F.col("minute"), F.col("type.name")
    none = F.lit(None).cast("bigint")

    def member(player: Column, own: bool, entry: Column = none, exit: Column = none, starts: int = 0) -> Column:
        named = {"member": player.cast("string"), "own": F.lit(own), "entry_min": entry, "exit_min": exit, "starts": F.lit(starts)}
        return F.struct(*[c.alias(n) for n, c in named.items()])

    sent_off = F.col("bad_behaviour.card.name").isin(*V.SENT_OFF) | F.col("foul_committed.card.name").isin(*V.SENT_OFF)
    leaves = F.when((kind == "Substitution") | sent_off, minute)
    own = F.array(member(F.col("player.id"), True, exit=leaves))
    starters = F.transform("tactics.lineup", lambda p: member(p["player"]["id"], False, entry=F.lit(0).cast("bigint"), starts=1))
    comes_on = F.array(member(F.col("substitution.replacement.id"), False, entry=minute))
    members = F.when((kind == "Starting XI") & F.col("tactics.lineup").isNotNull(), F.concat(own, starters)).when(kind == "Substitution", F.concat(own, comes_on)).otherwise(own)
    measured = _measured(events.withColumn("__members", members), {"members": "__members"})
    rows = measured.select(*[c for c in measured.columns if c != "members"], F.inline("members"))

    mine = F.col("own")
    totals = cond_counts(
        rows,
        ["match_natural_id", "team_natural_id", "member"],
        {"own_events": mine, **{name: mine & c for name, c in _player_counts().items()}},
        {"xg": (F.when(mine, F.col("xg")), XG)},
        entry_min=F.min("entry_min"),
        exit_min=F.min("exit_min"),
        starts=F.max("starts"),
        last_min=F.max("minute"),
    )
    in_match, one = Window.partitionBy("match_natural_id"), Window.partitionBy("match_natural_id", "member")
    spans = totals.withColumn("last_min", F.max("last_min").over(in_match)).withColumns(
        {"entry_min": F.min("entry_min").over(one), "exit_min": F.min("exit_min").over(one), "starts": F.max("starts").over(one)}
    )
    played = F.greatest(F.lit(0), F.coalesce("exit_min", "last_min") - F.col("entry_min")).cast("int")
    return (
        spans.where((F.col("own_events") > 0) & F.col("member").isNotNull() & F.col("entry_min").isNotNull())
        .withColumn("minutes_played", played)
        .withColumnRenamed("member", "player_natural_id")
        .drop("own_events", "entry_min", "exit_min", "last_min")
    )


PLAYER_COUNTS = [
    "minutes_played",
    "total_passes",
    "accurate_passes",
    "total_shots",
    "goals",
    "assists",
    "interceptions",
    "touches_in_box",
    "tackles_total",
    "tackles_won",
    "starts",
    "yellow_cards",
    "red_cards",
]


def _observed_loss(stats: DataFrame, loss: Observation | None, lookups: dict[str, str]) -> DataFrame:
    if loss is None:
        return stats
    return stats.observe(loss, F.count("*").alias("rows"), *[unmatched(F.col(c), f"{name}_sk").alias(name) for name, c in lookups.items()])


def checked_player_stats(
    events: DataFrame, match_dim: DataFrame, team_dim: DataFrame, player_dim: DataFrame, loss: Observation | None = None
) -> DataFrame:
    """One row per player and match, those lacking player, team or day with the reason in ``reject_reason``.

    The events are aggregated to players first, so all joins run on the few rows of a match. ``loss`` receives the rows and,
    for each lookup, those whose key it did not find.
    """
    stats = (
        player_totals(events)
        .join(expected_assists(events), PLAYER_KEYS, "left")
        .join(match_dim.select("match_natural_id", "match_sk", "match_date"), "match_natural_id")
    )
    stats = temporal_lookup(stats, team_dim, ["team_natural_id"], "match_date", ["team_sk"])
    stats = temporal_lookup(stats, player_dim, ["player_natural_id"], "match_date", ["player_sk"])
    rows = _observed_loss(stats, loss, {"team": "team_natural_id", "player": "player_natural_id"}).select(
        date_key("match_date").alias("date_id"),
        "player_sk",
        "match_sk",
        "team_sk",
        *[F.col(c).cast("int") for c in PLAYER_COUNTS],
        F.col("xg").cast(TOTAL).alias("xg_total"),
        F.coalesce("xa", F.lit(0)).cast(TOTAL).alias("xa_total"),
    )
    return tag_rejects(rows, {c: F.col(c).isNotNull() for c in ("player_sk", "team_sk", "date_id")})


def accepted(checked: DataFrame) -> DataFrame:
    """The rows without a reason to reject them, as they came."""
    return checked.where(F.col("reject_reason").isNull()).drop("reject_reason")


def player_match_stats(events: DataFrame, match_dim: DataFrame, team_dim: DataFrame, player_dim: DataFrame) -> DataFrame:
    """One row per player and match with known player, team and day."""
    return accepted(checked_player_stats(events, match_dim, team_dim, player_dim))


def team_measures(events: DataFrame) -> DataFrame:
    """Counted measures per match and team beside those of the opponent."""
    a_pass, defends = is_a("Pass"), F.col("type").isin(*V.DEFENSIVE_ACTIONS)
    pressing = F.col("x") >= V.PRESSING_LINE
    own = cond_counts(
        _measured(events).where(F.col("team_natural_id").isNotNull()),
        ["match_natural_id", "team_natural_id"],
        {
            "passes": a_pass,
            "defensive_actions": defends,
            "passes_high": a_pass & pressing,
            "defensive_actions_high": defends & pressing,
        },
        {"xg": ("xg", XG), "ball_time": ("duration", "decimal(18,6)", V.MAX_POSSESSION_DURATION)},
    )
    return opponent_total(own, ["match_natural_id"], ["passes", "passes_high", "ball_time", "xg"])


def possession(own: Column | str, total: Column | str) -> Column:
    """Share of the ball in percent; even shares when nothing was measured."""
    return F.when(field(total) > 0, rate(field(own).cast("double"), field(total).cast("double"), 100)).otherwise(50.0)


def checked_team_stats(events: DataFrame, match_dim: DataFrame, team_dim: DataFrame, loss: Observation | None = None) -> DataFrame:
    """One row per team and match: possession, pressing, xG and the result from the match.

    Those lacking a team or its opponent have the reason in ``reject_reason``; ``loss`` as for players.
    """
    matches = match_dim.select(
        "match_natural_id", "match_sk", "match_date", "home_team_sk", "away_team_sk", "home_score", "away_score"
    )
    stats = team_measures(events).join(matches, "match_natural_id")
    stats = temporal_lookup(stats, team_dim, ["team_natural_id"], "match_date", ["team_sk"])
    stats = _observed_loss(stats, loss, {"team": "team_natural_id"})
    home = F.coalesce(F.col("team_sk") == F.col("home_team_sk"), F.lit(False))

    def at_home(yes: str, no: str) -> Column:
        return F.when(home, F.col(yes)).otherwise(F.col(no))

    rows = (
        stats.select(
            date_key("match_date").alias("date_id"),
            "team_sk",
            at_home("away_team_sk", "home_team_sk").alias("opponent_team_sk"),
            "match_sk",
            home.alias("is_home"),
            possession("ball_time", "ball_time_match").cast("decimal(5,2)").alias("possession_pct"),
            rate("passes_opponent", "defensive_actions").cast(RATIO).alias("ppda"),
            rate("passes_high_opponent", "defensive_actions_high").cast(RATIO).alias("ppda_high"),
            F.col("xg").cast(TOTAL).alias("total_xg"),
            F.col("xg_opponent").cast(TOTAL).alias("conceded_xg"),
            at_home("home_score", "away_score").alias("goals_scored"),
            at_home("away_score", "home_score").alias("goals_conceded"),
        )
        .withColumn("result", match_result("goals_scored", "goals_conceded"))
    )
    return tag_rejects(rows, {c: F.col(c).isNotNull() for c in ("team_sk", "opponent_team_sk")})


def team_match_stats(events: DataFrame, match_dim: DataFrame, team_dim: DataFrame) -> DataFrame:
    """One row per team and match with known team and opponent."""
    return accepted(checked_team_stats(events, match_dim, team_dim))


def season_stats(player_match_stats: DataFrame, match_dim: DataFrame) -> DataFrame:
    """Totals per player version, team version and season."""
    totals = [c for c in PLAYER_COUNTS if c not in ("minutes_played", "total_passes", "accurate_passes", "total_shots")]
    played = player_match_stats.join(match_dim.select("match_sk", "season"), "match_sk")
    return played.groupBy("player_sk", "team_sk", "season").agg(
        F.count("match_sk").cast("int").alias("matches_played"),
        F.sum("minutes_played").cast("int").alias("minutes"),
        *[F.sum(c).cast("int").alias(c) for c in totals],
        F.sum("xg_total").cast(TOTAL).alias("xg_season"),
        F.sum("xa_total").cast(TOTAL).alias("xa_season"),
    )
