"""The daily load gives the same tables whatever the order and number of loads."""

from __future__ import annotations

import shutil

import pytest
from pyspark.sql import functions as F

from matchlytics.plans import daily
from matchlytics.plans.constraints import violations
from matchlytics.plans.marts import build_marts, refresh_marts
from matchlytics.sources import read_table
from tests import league as L

SQUADS = {1: [11, 12, 13, 14], 2: [21, 22, 23, 24], 3: [31, 32, 33, 34]}
TABLES = (
    "dim_date dim_location dim_team dim_player dim_match dim_event_type dim_play_pattern "
    "fact_event fact_player_match_stats fact_team_match_stats fact_player_season_stats"
).split()
# Manager of team 1: A, B, A again; the match of 05-13 is the one that splits A's time.
GAMES = [
    L.match(1, "2018-05-06", 1, 2, (1, 1), ("A", "X")),
    L.match(2, "2018-05-13", 3, 1, (0, 2), ("Z", "B")),
    L.match(3, "2018-05-20", 1, 3, (1, 0), ("A", "Z")),
    L.match(4, "2018-08-20", 2, 1, (1, 2), ("X", "A"), season="2018/2019"),
]


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    for m in GAMES:
        # Player 14 plays for team 3 in the second match.
        squads = {**SQUADS, 1: [11, 12, 13, 15], 3: [14, 32, 33, 34]} if m["match_id"] == 2 else SQUADS
        teams = (m["home_team"]["home_team_id"], m["away_team"]["away_team_id"])
        L.write(folder, m, [L.listed(m["match_id"], t, squads[t]) for t in teams], L.played(m, squads))
    return str(folder)


def load(spark, root, out, order, config=None):
    for day in order:
        written = daily.run(spark, root, str(out), day, config)
    return written


def content(spark, out):
    tables = {}
    for name in TABLES:
        df = read_table(spark, f"{out}/{name}").drop("created_at")
        cols = sorted(df.columns)
        tables[name] = sorted(map(str, df.select(*cols).collect()))
    return tables


@pytest.fixture(scope="module")
def first_three(spark, root, tmp_path_factory):
    out = tmp_path_factory.mktemp("first_three") / "out"
    load(spark, root, out, [m["match_date"] for m in GAMES[:3]])
    return out


@pytest.fixture(scope="module")
def in_order(spark, root, first_three, tmp_path_factory):
    out = tmp_path_factory.mktemp("in_order") / "out"
    shutil.copytree(first_three, out)
    load(spark, root, out, [GAMES[3]["match_date"]])
    return out


def test_counts_and_constraints(spark, in_order):
    def read(name):
        return read_table(spark, f"{in_order}/{name}")

    assert read("dim_match").count() == 4 and read("fact_team_match_stats").count() == 8
    assert read("dim_team").where("team_natural_id = '1'").count() == 3
    found = violations({name: read(name) for name in TABLES})
    assert found.where("violations > 0").collect() == [] and found.count() > 40
    assert read("fact_event").where("reject_reason is not null").count() == 0
    assert all("created_at" in read(name).columns for name in TABLES)


@pytest.mark.parametrize("order", [(2, 0, 3, 1)])
def test_order_of_loads_does_not_matter(spark, root, in_order, tmp_path, order):
    seasons = [("League", "2017/2018"), ("League", "2018/2019"), ("Cup", "2018/2019")]
    config = spark.createDataFrame(seasons, "competition_name string, season_name string")
    load(spark, root, tmp_path, [GAMES[i]["match_date"] for i in order], config)
    got, want = content(spark, tmp_path), content(spark, in_order)
    for name in TABLES:
        assert got[name] == want[name], name


def test_loading_twice_changes_nothing(spark, root, in_order):
    before = content(spark, in_order)
    written = load(spark, root, in_order, ["2018-05-13"])
    assert content(spark, in_order) == before
    assert written["fact_team_match_stats"] == 2


def test_day_without_matches_and_configuration(spark, root, tmp_path):
    assert daily.run(spark, root, str(tmp_path), "2018-05-07") == {}
    config = spark.createDataFrame([("Other League", "2017/2018")], "competition_name string, season_name string")
    assert daily.run(spark, root, str(tmp_path), "2018-05-06", config) == {}


def test_violations_are_found(spark, in_order):
    tables = {name: read_table(spark, f"{in_order}/{name}") for name in TABLES}
    stats = tables["fact_team_match_stats"]
    tables["fact_team_match_stats"] = stats.unionByName(stats.where("is_home").withColumn("result", F.lit("X")))
    tables["dim_match"] = tables["dim_match"].where("match_natural_id <> '1'")
    tables["dim_team"] = tables["dim_team"].withColumn("effective_to", F.lit("9999-12-31").cast("date"))
    bad = {(r.table_name, r.rule): r.violations for r in violations(tables).where("violations > 0").collect()}
    assert bad["fact_team_match_stats", "known_result"] == 4 and bad["fact_team_match_stats", "unique"] == 4
    assert bad["fact_team_match_stats", "reference match_sk"] == 3 and bad["dim_team", "intervals"] == 2


def marts_of(spark, out):
    tables = sorted(p.name for p in out.iterdir() if p.name.startswith("mart_") and not p.name.endswith(("__staged", "__new")))
    rows = {name: read_table(spark, f"{out}/{name}") for name in tables}
    return {name: sorted(map(str, df.select(*sorted(df.columns)).collect())) for name, df in rows.items()}


def test_marts_refreshed_by_day_equal_a_rebuild(spark, root, first_three, in_order, tmp_path):
    out, again = tmp_path / "out", tmp_path / "again"
    shutil.copytree(first_three, out)
    shutil.copytree(in_order, again)
    wh = daily.Warehouse(spark, str(out))
    assert all(n > 0 for n in build_marts(wh).values())
    assert refresh_marts(wh) == {}
    kept = [p for p in out.glob("mart_match_*/date_id=20180506/*.parquet")]
    assert len(kept) >= 7
    load(spark, root, out, [GAMES[3]["match_date"]])
    rows = refresh_marts(wh)
    assert rows["strategy_team_form"] == 8 and rows["strategy_head_to_head"] == 4
    assert all(p.exists() for p in kept)
    rebuilt = build_marts(daily.Warehouse(spark, str(again)))
    assert rebuilt["strategy_team_form"] == 8 and all(n > 0 for n in rebuilt.values())
    got, want = marts_of(spark, out), marts_of(spark, again)
    assert set(got) == set(want) == {f"mart_{n}" for n in rebuilt}
    for name in want:
        assert got[name] == want[name], name


def without(folder, day, kinds=("matches", "lineups", "events")):
    for kind in kinds:
        shutil.rmtree(folder / kind / f"date={day}")


def test_reload_with_fewer_matches_another_lineup_and_none(spark, root, first_three, tmp_path):
    """First a wrong 05-13: one match too many, another manager, no transfer. Then the right one, then none."""
    raw, out, day = tmp_path / "raw", tmp_path / "out", "2018-05-13"
    shutil.copytree(root, raw)
    shutil.copytree(first_three, out)
    without(raw, day)
    wrong = L.match(2, day, 3, 1, (0, 2), ("Z", "A"))
    L.write(raw, wrong, [L.listed(2, 3, SQUADS[3]), L.listed(2, 1, SQUADS[1])], L.played(wrong, SQUADS))
    extra = L.match(9, day, 4, 2, (3, 0), ("W", "Y"), season="Cup 2018")
    squads = {**SQUADS, 4: [41, 42, 43, 21]}
    rows = L.played(extra, squads)
    rows[-1] |= {"type": {"id": 99, "name": "Own Goal For"}, "play_pattern": {"id": 77, "name": "From Nowhere"}}
    rows[-2] |= {"play_pattern": {"id": 1, "name": "A Name Before All Others"}}
    L.write(raw, extra, [L.listed(9, t, squads[t]) for t in (4, 2)], rows)
    load(spark, str(raw), out, [day])
    bad = content(spark, out)
    assert len(bad["dim_match"]) == 4 and any("Own Goal For" in r for r in bad["dim_event_type"])
    assert any("A Name Before" in r for r in bad["dim_play_pattern"])

    without(raw, day)
    for kind in ("matches", "lineups", "events"):
        shutil.copytree(f"{root}/{kind}/date={day}", raw / kind / f"date={day}")
    load(spark, str(raw), out, [day])
    got, want = content(spark, out), content(spark, first_three)
    for name in TABLES:
        assert got[name] == want[name], name

    without(raw, day)
    load(spark, str(raw), out, [day])
    fresh = tmp_path / "fresh"
    load(spark, str(raw), fresh, [m["match_date"] for m in (GAMES[0], GAMES[2])])
    got, want = content(spark, out), content(spark, fresh)
    for name in TABLES:
        assert got[name] == want[name], name
    assert daily.run(spark, str(raw), str(out), day) == {}


def test_the_only_day_reloaded_with_none(spark, root, tmp_path):
    raw, out, day = tmp_path / "raw", tmp_path / "out", "2018-05-20"
    shutil.copytree(root, raw)
    load(spark, str(raw), out, [day])
    without(raw, day)
    assert set(load(spark, str(raw), out, [day]).values()) == {0}
    for name in TABLES:
        if name.startswith("fact"):
            assert not list((out / name).glob("**/*.parquet"))
        elif name != "dim_location":
            assert read_table(spark, f"{out}/{name}").count() == 0, name


def test_a_later_day_reads_no_history(spark, root, in_order, first_three, tmp_path):
    """The landed documents of the days before may be gone; versions, keys and facts go on from the tables."""
    out = tmp_path / "out"
    shutil.copytree(first_three, out)
    for kind in ("matches", "lineups", "events"):
        for m in GAMES[:3]:
            shutil.rmtree(out / f"landed_{kind}" / f"date={m['match_date']}")
    load(spark, root, out, [GAMES[3]["match_date"]])
    got, want = content(spark, out), content(spark, in_order)
    for name in TABLES:
        assert got[name] == want[name], name


def test_birth_years_stay_through_later_loads(spark, root, first_three, tmp_path):
    out = tmp_path / "out"
    shutil.copytree(first_three, out)
    wh = daily.Warehouse(spark, str(out))
    names = sorted({r.player_name for r in wh.read("dim_player").collect()})[:3]
    people = spark.createDataFrame([(n, 1990) for n in names], "name string, birth_year int")
    assert daily.enrich(wh, people) >= 3
    known = {r.player_natural_id for r in wh.read("dim_player").where("birth_year = 1990").collect()}
    # Whoever has a year keeps it, also in versions that a reload makes anew.
    assert daily.enrich(wh, people.withColumn("birth_year", F.lit(1980))) >= 3
    load(spark, root, out, ["2018-05-13", GAMES[3]["match_date"]])
    years = wh.read("dim_player").select("player_natural_id", "birth_year").collect()
    assert {r.player_natural_id for r in years if r.birth_year == 1990} == known
    assert all((r.birth_year == 1990) == (r.player_natural_id in known) for r in years)
