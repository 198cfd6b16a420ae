"""The daily load: one day's documents into the warehouse tables, repeatable for any day in any order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from matchlytics.functions import year_bucket
from matchlytics.operators import changed_starts, only_configured, only_date, retract, temporal_lookup, upsert
from matchlytics.plans import dimensions as D
from matchlytics.plans import stats as S
from matchlytics.plans.enrich import enrich_birth_year
from matchlytics.plans.facts import fact_event
from matchlytics.sources import (
    RAW,
    MissingSource,
    append,
    clear_partitions,
    read_raw,
    read_table,
    replace_partitions,
    replace_table,
    table_exists,
)

# Years with a storage range of their own; other days share the default range.
FIRST_YEAR, LAST_YEAR = 2017, 2020

BY_DAY = ["year_range", "date_id"]
# The days and seasons that loads have rewritten since the marts were last brought up to date.
CHANGES = "changes"

class Warehouse:
    """Paths of the tables under one folder."""

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out = spark, out

    def path(self, table: str) -> str:
        return f"{self.out}/{table}"

    def read(self, table: str) -> DataFrame:
        return read_table(self.spark, self.path(table))

    def exists(self, table: str) -> bool:
        return table_exists(self.spark, self.path(table))

    def replace(self, table: str, rows: DataFrame) -> None:
        replace_table(rows.withColumn("created_at", F.current_timestamp()), self.path(table))

    def stage(self, table: str, rows: DataFrame) -> DataFrame:
        """The new rows of a table, written beside it and read back; the table itself stays as it is."""
        staged = self.path(f"{table}__new")
        rows.write.mode("overwrite").parquet(staged)
        return self.spark.read.schema(rows.schema).parquet(staged)

    def put(self, table: str, rows: DataFrame, keys: list[str], stale: Column | None = None) -> None:
        """Replaces rows by key; existing rows that are ``stale`` go, whether or not a new one has their key."""
        rows = rows.withColumn("created_at", F.current_timestamp())
        if self.exists(table):
            kept = self.read(table)
            rows = upsert(kept if stale is None else kept.where(~F.coalesce(stale, F.lit(False))), rows, keys)
        replace_table(rows, self.path(table))

    def write_days(self, table: str, rows: DataFrame, days: list[str]) -> int:
        """Makes ``days`` hold just these rows, in yearly ranges; a day without rows has no partition left."""
        ranged = rows.withColumn("year_range", year_bucket("date_id", FIRST_YEAR, LAST_YEAR))
        seen = Observation()  # bounded by the days of one load
        ranged = ranged.withColumn("created_at", F.current_timestamp()).observe(seen, F.collect_set("date_id").alias("days"))
        written = replace_partitions(ranged, self.path(table), BY_DAY)
        for day in {int(d.replace("-", "")) for d in days} - set(seen.get["days"]):
            clear_partitions(self.spark, self.path(table), [None, ("date_id", day)])
        return written

    def accepted(self, table: str) -> DataFrame:
        """Rows of a fact table without a reason to reject them."""
        return S.accepted(self.read(table))

    def landed(self, kind: str) -> DataFrame:
        """Landed documents of all days; none if there are no files left."""
        try:
            return self.read(f"landed_{kind}")
        except MissingSource:
            own = "" if RAW[kind].strip().startswith("match_id") else "match_id bigint, "
            return self.spark.createDataFrame([], f"{own}{RAW[kind]}, date date")


def land(spark: SparkSession, root: str, wh: Warehouse, date: str, config: DataFrame | None = None) -> int:
    """Parses a day's JSON once into Parquet, a partition per kind and day, in place of what the day had before.

    ``config(competition_name, season_name)`` restricts the matches, and with them lineups and events.
    Returns the number of matches.
    """
    matches = only_date(read_raw(spark, root, "matches", date), "match_date", date)
    if config is not None:
        named = matches.withColumns(
            {"competition_name": F.col("competition.competition_name"), "season_name": F.col("season.season_name")}
        )
        matches = only_configured(named, config, ["competition_name", "season_name"]).drop("competition_name", "season_name")

    def put(kind: str, rows: DataFrame) -> int:
        path = wh.path(f"landed_{kind}")
        return replace_partitions(rows, path, ["date"]) or -clear_partitions(spark, path, [("date", date)])

    landed = put("matches", matches)
    for kind in ("lineups", "events"):
        if landed > 0:
            put(kind, read_raw(spark, root, kind, date).join(matches.select("match_id"), "match_id", "left_semi"))
        else:
            clear_partitions(spark, wh.path(f"landed_{kind}"), [("date", date)])
    return max(landed, 0)


def _day_keys(matches: DataFrame, lineups: DataFrame, events: DataFrame) -> DataFrame:
    """(kind, key, name) of all that a day's documents mention: what has to be looked at again should they change."""

    def of(kind: str, rows: DataFrame, key: str, name: str | None = None) -> DataFrame:
        named = F.col(name) if name else F.lit(None)
        return rows.select(F.lit(kind).alias("kind"), F.col(key).cast("string").alias("key"), named.cast("string").alias("name"))

    keys = of("team", D.team_observations(matches), "team_natural_id")
    keys = keys.unionByName(of("player", D.player_observations(lineups, matches), "player_natural_id"))
    keys = keys.unionByName(of("season", matches.select("season.season_name"), "season_name"))
    keys = keys.unionByName(of("event_type", D.event_type_dim(events), "event_type_sk"))
    patterns = events.select(F.col("play_pattern.id").cast("int").alias("id"), F.col("play_pattern.name").alias("name"))
    return keys.unionByName(of("play_pattern", patterns, "id", "name")).where(F.col("key").isNotNull()).distinct()


def _versions(wh: Warehouse, date: str, touched: DataFrame) -> list[str]:
    """Puts the day's observations in place of its former ones in the team and player versions.

    Returns the days whose facts point to other versions than before, the loaded day included. Of the landed documents only
    the day and those after it are read; the versions say what came before.
    """
    at = F.lit(date).cast("date")
    matches, lineups = wh.landed("matches"), wh.landed("lineups")
    today = lineups.where(F.col("date") == at), matches.where(F.col("date") == at)
    later = lineups.where(F.col("date") > at), matches.where(F.col("date") > at)

    def keys(kind: str, name: str) -> DataFrame:
        return touched.where(F.col("kind") == kind).select(F.col("key").alias(name))

    merged = {
        "dim_team": (
            "team_natural_id",
            D.team_observations(later[1]),
            lambda old, key: D.team_dim_day(old, date, keys("team", key), today[1], later[1]),
            lambda: D.team_dim(today[1]),
        ),
        "dim_player": (
            "player_natural_id",
            D.player_observations(*later),
            lambda old, key: D.player_dim_day(old, date, keys("player", key), today, later),
            lambda: D.player_dim(*today),
        ),
    }
    stale = {date}
    for table, (key, after, merge, build) in merged.items():
        if not wh.exists(table):
            wh.replace(table, build())
            continue
        before = wh.read(table)
        new = wh.stage(table, merge(before, key))
        # Starts only move from the day on, so that only later days can point elsewhere.
        moved = changed_starts(before, new, key).withColumn("moved", F.lit(True))
        pointing = temporal_lookup(after.select(key, "match_date"), moved, [key], "match_date", ["moved"])
        days = pointing.where("moved").select(F.date_format("match_date", "yyyy-MM-dd").alias("day")).distinct()
        stale |= {r.day for r in days.toLocalIterator()}
        wh.replace(table, new)
    return sorted(stale)


def run(spark: SparkSession, root: str, out: str, date: str, config: DataFrame | None = None) -> dict[str, int]:
    """Loads a day and whatever other days it changes; returns rows written per fact table, and rows that a lookup lost.

    A day may be loaded again with other documents, or with none: afterwards all tables are as if it had always been so.
    ``day_keys`` remembers what each day mentions. Its new keys are added before any other table is touched and the former
    ones go last, so that a load that was cut off and is run again still knows both.
    """
    wh = Warehouse(spark, out)
    landed = land(spark, root, wh, date, config)
    known = wh.path("day_keys")
    at = F.lit(date).cast("date")
    if not landed and not (wh.exists("day_keys") and not wh.read("day_keys").where(F.col("date") == at).isEmpty()):
        return {}

    today = {kind: wh.landed(kind).where(F.col("date") == at) for kind in ("matches", "lineups", "events")}
    keys = wh.stage("day_keys", _day_keys(**today).withColumn("date", at))
    append(keys, known, ["date"])
    every = wh.read("day_keys")
    touched = every.where(F.col("date") == at).select("kind", "key", "name").distinct()
    elsewhere = every.where(F.col("date") != at).unionByName(keys)

    days = _versions(wh, date, touched)
    in_days = F.col("date").isin(*[F.lit(d).cast("date") for d in days])
    matches, events = wh.landed("matches").where(in_days), wh.landed("events").where(in_days)
    teams, players = wh.read("dim_team"), wh.read("dim_player")
    on_days = lambda c: F.col(c).isin(*[F.lit(d).cast("date") for d in days])

    wh.put("dim_date", D.date_dim(matches), ["date_id"], on_days("date_value"))
    wh.replace("dim_location", D.zone_dim(spark))
    wh.put("dim_match", D.match_dim(matches, teams), ["match_natural_id"], on_days("match_date"))
    wh.put("dim_event_type", D.event_type_dim(today["events"]), ["event_type_sk"])
    patterns = today["events"].select("play_pattern")
    if wh.exists("dim_play_pattern"):
        stored = wh.read("dim_play_pattern").select(F.struct(F.col("play_pattern_id").cast("bigint").alias("id"), F.col("play_pattern_name").alias("name")).alias("play_pattern"))
        patterns = patterns.unionByName(stored)
    wh.replace("dim_play_pattern", D.play_pattern_dim(patterns))
    _forget(wh, touched, keys, elsewhere)

    match_dim = wh.read("dim_match")
    types, patterns = wh.read("dim_event_type"), wh.read("dim_play_pattern")
    loss = {name: Observation() for name in ("fact_event", "fact_player_match_stats", "fact_team_match_stats")}
    facts = {
        "fact_event": fact_event(events, match_dim, teams, players, types, patterns, loss=loss["fact_event"]),
        "fact_player_match_stats": S.checked_player_stats(events, match_dim, teams, players, loss["fact_player_match_stats"]),
        "fact_team_match_stats": S.checked_team_stats(events, match_dim, teams, loss["fact_team_match_stats"]),
    }
    written = {}
    for name, rows in facts.items():  # accepted and rejected rows in one pass, and what each lookup lost with them
        written[name] = wh.write_days(name, rows, days)
        lost = loss[name].get
        written |= {f"{name}: {lookup} not found": n for lookup, n in lost.items() if lookup != "rows"}
    seasons = touched.where(F.col("kind") == "season").select(F.col("key").alias("season"))
    others = match_dim.where(on_days("match_date")).select("season")
    seasons = wh.stage("changed_seasons", seasons.unionByName(others).distinct())
    written["fact_player_season_stats"] = _refresh_seasons(wh, seasons)
    changed = spark.createDataFrame([("day", d.replace("-", "")) for d in days], "kind string, value string")
    append(changed.unionByName(seasons.select(F.lit("season").alias("kind"), F.col("season").alias("value"))), wh.path(CHANGES))
    replace_partitions(keys, known, ["date"]) or clear_partitions(spark, known, [("date", date)])
    return written


def _forget(wh: Warehouse, touched: DataFrame, keys: DataFrame, elsewhere: DataFrame) -> None:
    """Takes out event types and play patterns that only the day's former documents had.

    The keys of other days are read only if the day has lost any.
    """
    gone = wh.stage("day_keys_gone", touched.join(keys, ["kind", "key"], "left_anti").where(F.col("kind").isin("event_type", "play_pattern")))
    renamed = touched.where(F.col("kind") == "play_pattern").join(keys, ["kind", "key", "name"], "left_anti")
    types = gone.where(F.col("kind") == "event_type").select(F.col("key").alias("event_type_sk"))
    if not types.isEmpty():
        there = elsewhere.where(F.col("kind") == "event_type").select(F.col("key").alias("event_type_sk"))
        wh.replace("dim_event_type", retract(wh.read("dim_event_type").drop("created_at"), types, there, ["event_type_sk"]))
    if not renamed.isEmpty():
        named = elsewhere.where(F.col("kind") == "play_pattern").select(F.col("key").cast("int").alias("id"), "name")
        raw = named.select(F.struct("id", "name").alias("play_pattern"))
        wh.replace("dim_play_pattern", D.play_pattern_dim(raw))


def _refresh_seasons(wh: Warehouse, seasons: DataFrame) -> int:
    """Totals of these seasons, each a partition; one without matches has none left."""
    in_season = wh.read("dim_match").join(seasons, "season", "left_semi")
    try:
        played = wh.accepted("fact_player_match_stats")
    except MissingSource:  # no day has any
        played = None
    path, written = wh.path("fact_player_season_stats"), 0
    found: set = set()
    if played is not None:
        seen = Observation()
        totals = S.season_stats(played, in_season).withColumn("created_at", F.current_timestamp())
        written = replace_partitions(totals.observe(seen, F.collect_set("season").alias("seasons")), path, ["season"])
        found = set(seen.get["seasons"])
    for r in seasons.toLocalIterator():
        if r.season not in found:
            clear_partitions(wh.spark, path, [("season", r.season)])
    return written


def enrich(wh: Warehouse, people: DataFrame) -> int:
    """Fills the birth years that stored players lack from ``people(name, birth_year)``; returns how many versions have one.

    Only NULLs change. Later loads keep the years: versions of a player that they make anew take them over.
    """
    wh.replace("dim_player", wh.stage("dim_player", enrich_birth_year(wh.read("dim_player").drop("created_at"), people)))
    return wh.read("dim_player").where(F.col("birth_year").isNotNull()).count()
