from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from matchlytics.operators import not_loaded, only_configured, only_date
from matchlytics.plans.dimensions import event_type_dim
from matchlytics.functions import year_bucket
from matchlytics.sources import MissingSource, append, read_raw, read_table, replace_partitions, replace_table, table_exists
from tests import league as L

SQUADS = {1: [11, 12, 13, 14], 2: [21, 22, 23, 24]}


@pytest.fixture()
def root(tmp_path):
    for i, day in ((101, "2018-05-06"), (102, "2018-05-07")):
        m = L.match(i, day, 1, 2)
        L.write(tmp_path, m, [L.listed(i, 1, SQUADS[1]), L.listed(i, 2, SQUADS[2])], L.played(m, SQUADS))
    return tmp_path


def test_day_and_all_days(spark, root):
    one = read_raw(spark, str(root), "lineups", "2018-05-06")
    assert [r.match_id for r in one.select("match_id").distinct().collect()] == [101]
    assert read_raw(spark, str(root), "lineups").select("match_id").distinct().count() == 2
    assert str(one.first().date) == "2018-05-06"
    assert read_raw(spark, str(root), "matches", "2018-05-07").first().match_id == 102


def test_only_one_folder_is_listed(spark, root):
    files = read_raw(spark, str(root), "events", "2018-05-06").inputFiles()
    assert len(files) == 1 and files[0].endswith("101.json")


def test_missing_day_and_kind(spark, root):
    empty = read_raw(spark, str(root), "events", "2018-05-08")
    assert empty.count() == 0 and "match_id" in empty.columns
    with pytest.raises(MissingSource):
        read_raw(spark, str(root / "nowhere"), "events", "2018-05-08")


def test_malformed_document_fails(spark, root):
    (root / "events" / "date=2018-05-06" / "103.json").write_text('[{"id": "x", "minute": }]')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_raw(spark, str(root), "events", "2018-05-06").collect()


def test_pretty_printed_documents(spark, tmp_path):
    folder = tmp_path / "lineups" / "date=2018-05-06"
    folder.mkdir(parents=True)
    row = {k: v for k, v in L.listed(9924, 1, [5], None).items() if k != "match_id"}
    (folder / "9924.json").write_text(json.dumps([row], indent=2))
    (got,) = read_raw(spark, str(tmp_path), "lineups", "2018-05-06", multi_line=True).collect()
    assert got.match_id == 9924 and got.lineup[0].positions == []


def test_inferred_schema_without_structs(spark, tmp_path):
    (tmp_path / "1.json").write_text('[{"type": {"name": "Pass"}, "minute": 1}]')
    bare = spark.read.json(str(tmp_path / "1.json"))
    assert event_type_dim(bare).select("event_category", "outcome").collect() == [("Ball Action", None)]


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 20170505), (2, "b", 20300101), (3, "c", None)], "id int, v string, date_id int")
    path = str(tmp_path / "t")
    assert not table_exists(spark, path)
    with pytest.raises(MissingSource):
        read_table(spark, path)
    ranged = df.withColumn("year_range", year_bucket("date_id", 2017, 2020))
    assert replace_partitions(ranged, path, ["year_range", "date_id"]) == 3
    assert {p.name for p in Path(path).iterdir() if p.is_dir()} == {"year_range=2017", "year_range=default"}
    assert replace_partitions(ranged.where("id = 1").withColumn("v", F.lit("z")), path, ["year_range", "date_id"]) == 1
    assert sorted(r.v for r in read_table(spark, path, ["v"]).collect()) == ["b", "c", "z"]
    plain = str(tmp_path / "p")
    assert append(df, plain) == 3 and append(df, plain) == 3
    assert replace_table(read_table(spark, plain).distinct(), plain) == 3
    assert read_table(spark, plain).count() == 3


def test_selection(spark):
    df = spark.createDataFrame([(1, "2018-05-06", "L"), (2, "2018-05-07", "M")], "id int, day string, c string")
    stamped = df.withColumn("ts", F.to_timestamp("day")).withColumn("d", F.to_date("day"))
    for column in ("day", "ts", "d"):
        assert [r.id for r in only_date(stamped, column, "2018-05-06").collect()] == [1]
    assert [r.id for r in only_configured(df, df.where("id = 2"), ["c"]).collect()] == [2]
    assert [r.id for r in not_loaded(df, df.where("id = 2"), ["id"]).collect()] == [1]
