from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from matchlytics.functions import (
    classify_in,
    classify_like,
    clock_seconds,
    coalesce_leaf,
    date_key,
    field,
    first_point,
    has_field,
    hash_key,
    id_from_path,
    match_result,
    null_outside,
    optional_col,
    padj,
    per90,
    pitch_zone,
    rate,
    safe_sum,
    short_name,
    year_bucket,
)
from matchlytics.functions import values as V
from matchlytics.operators import flatten, role_rows, standardise, typed


def column(df, c):
    return [r[0] for r in df.select(c).collect()]


def test_zone_borders(spark):
    points = [(None, None), (102.0, 18.0), (102.0, 62.0), (101.9, 40.0), (20.0, 26.6), (0.0, 0.0), (120.0, 80.0), (5.0, None)]
    df = spark.createDataFrame(points, "x double, y double")
    assert column(df, pitch_zone("x", "y")) == [None, 19, 19, 17, 5, 1, 18, None]
    assert column(df, pitch_zone("x", "y", legacy_null_zone=True)) == [18, 19, 19, 17, 5, 1, 18, 3]


def test_zone_by_exhaustive_grid(spark):
    points = [(float(x), float(y)) for x in range(0, 121, 2) for y in range(0, 81, 2)]

    def expected(x, y):
        if x >= 102 and 18 <= y <= 62:
            return 19
        return 3 * min(int(x // 20), 5) + (1 if y < 26.6 else 2 if y < 53.3 else 3)

    df = spark.createDataFrame(points, "x double, y double").withColumn("z", pitch_zone("x", "y"))
    assert all(r.z == expected(r.x, r.y) for r in df.collect())


def test_null_outside(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (10000.0,), (10001.0,), (None,)], "d double")
    assert column(df, null_outside("d", 0, 10000)) == [None, 0.0, 10000.0, None, None]


def test_clock(spark):
    texts = ["05:00:00.000", "05:00:00.001", "00:01:02.345", "46:58", "10:00.5", "x:y:z", "12", "", None]
    df = spark.createDataFrame([(v,) for v in texts], "c string")
    assert column(df, clock_seconds("c")) == [
        Decimal("18000.000"), None, Decimal("62.345"), Decimal("2818.000"), Decimal("600.500"), None, None, None, None,
    ]


def test_position_groups(spark):
    names = ["Goalkeeper", "Left Wing Back", "Right Midfield", "Left Wing", "Striker", "Left Center Forward", None]
    df = spark.createDataFrame([(n,) for n in names], "p string")
    assert column(df, classify_like("p", V.POSITION_GROUPS)) == [
        "Goalkeeper", "Defender", "Midfielder", "Forward", "Forward", "Forward", "Unknown",
    ]
    legacy = column(df, classify_like("p", V.LEGACY_POSITION_GROUPS))
    assert legacy[4:] == ["Forward", "Unknown", "Unknown"]


def test_event_categories(spark):
    df = spark.createDataFrame([("Pass",), ("Pressure",), ("Goal Keeper",), ("Offside",), ("Half Start",)], "t string")
    assert column(df, classify_in("t", V.EVENT_CATEGORIES)) == [
        "Ball Action", "Defensive Action", "Goalkeeper Action", "Foul/Offside", "Other",
    ]


def test_array_access_never_fails(spark):
    df = spark.createDataFrame([([{"n": "a"}],), ([],), (None,)], "m array<struct<n: string>>")
    assert column(df, field(("m", 0, "n"))) == ["a", None, None]


def test_optional_and_coalesced_columns(spark):
    full = spark.createDataFrame(
        [({"outcome": {"name": None}}, {"outcome": {"name": "Goal"}}, 1)],
        "pass struct<outcome: struct<name: string>>, shot struct<outcome: struct<name: string>>, n int",
    )
    bare = spark.createDataFrame([(1,)], "n int")
    assert column(full, coalesce_leaf(full, "outcome.name")) == ["Goal"]
    assert bare.select(coalesce_leaf(bare, "outcome.name").alias("o")).dtypes == [("o", "string")]
    assert column(full, optional_col(full, "shot.outcome.name")) == ["Goal"]
    missing = bare.select(optional_col(bare, "shot.xg", 0, "double").alias("xg"))
    assert missing.dtypes == [("xg", "double")] and missing.first().xg == 0.0
    assert not has_field(full.schema, "pass.outcome.id") and not has_field(full.schema, "n.m")


def test_first_point_per_axis(spark):
    df = spark.createDataFrame([(None, [1.0, 2.0]), ([3.0, 4.0], [1.0, 2.0]), ([], None)], "a array<double>, b array<double>")
    x, y = first_point("a", "b")
    assert [tuple(r) for r in df.select(x, y).collect()] == [(1.0, 2.0), (3.0, 4.0), (None, None)]


def test_keys(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    first, second = column(df, hash_key("x", "y", "z"))
    assert first != second and len(first) == 32
    clashing = spark.createDataFrame([("Pass", None), ("Pass", ""), ("Pass~x", "y"), ("Pass", "x~y"), (None, "-")], "x string, y string")
    assert len(set(column(clashing, hash_key("x", "y")))) == 5
    paths = spark.createDataFrame([("s3a://b/events/date=2018-05-06/9924.json",), ("x/9924.txt",)], "p string")
    assert column(paths, id_from_path("p")) == [9924, None]


def test_dates(spark):
    df = spark.createDataFrame([("2018-05-06",), (None,)], "d string").select(F.to_date("d").alias("d"))
    assert column(df, date_key("d")) == [20180506, None]
    ids = spark.createDataFrame([(20161231,), (20170101,), (20201231,), (20210101,), (None,)], "i int")
    assert column(ids, year_bucket("i", 2017, 2020)) == ["default", "2017", "2020", "default", "default"]


def test_short_name(spark):
    df = spark.createDataFrame([("Lionel Andrés Messi Cuccittini",), ("Jordi Alba",), (None,)], "n string")
    assert column(df, short_name("n")) == ["Lionel Cuccittini", None, None]


def test_metrics(spark):
    df = spark.createDataFrame([(3, 90, 0), (0, 0, 5)], "a int, m int, z int")
    assert column(df, per90("a", "m")) == [3.0, None]
    assert column(df, rate("a", "z", 100)) == [None, 0.0]
    assert column(df, padj("a", "m", F.lit(40.0), F.lit(60.0)))[0] == pytest.approx(4.5)
    assert column(df, match_result("a", "z")) == ["W", "L"]
    assert column(df.limit(1), match_result("z", F.lit(0))) == ["D"]


def test_safe_sum(spark):
    df = spark.createDataFrame([(1.5,), (None,), (1000.0,), (-1000.0,), (0.25,)], "d double")
    assert df.agg(safe_sum("d", "decimal(18,2)", 999)).first()[0] == Decimal("1.75")
    assert df.agg(safe_sum("d", "decimal(18,2)")).first()[0] == Decimal("1.75")
    large = spark.createDataFrame([(2e12,), (1.0,)], "d double")
    assert large.agg(safe_sum("d")).first()[0] == Decimal("2000000000001")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        large.agg(safe_sum("d", "decimal(6,2)")).collect()


def test_shape_operators(spark):
    df = spark.createDataFrame([(1, {"a": "x"}, [7.0])], "id int, s struct<a: string>, l array<double>")
    assert flatten(df, {"a": "s.a", "l0": ("l", 0), "l1": ("l", 1)}).collect() == [("x", 7.0, None)]
    wide = spark.createDataFrame([("12x", 1e9)], "a string, b double")
    assert typed(wide, {"a": "int", "b": "decimal(5,2)"}).collect() == [(None, None)]
    sides = role_rows(df, {"h": {"v": F.lit(1)}, "w": {"v": F.lit(2)}}, ["id"], role="r")
    assert sorted(sides.collect()) == [(1, "h", 1), (1, "w", 2)]
    mapping = spark.createDataFrame([("ESP", "Spain"), ("Espana", "Spain")], "synonym string, canonical string")
    given = spark.createDataFrame([("ESP",), ("Italy",), (None,)], "c string")
    assert column(standardise(given, "c", mapping, "?"), "c") == ["Spain", "Italy", "?"]
