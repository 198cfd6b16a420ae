from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from matchlytics.operators import (
    changed_starts,
    check_intervals,
    fallback_lookup,
    join_loss,
    latest,
    null_safe_lookup,
    scd2,
    scd2_day,
    scd2_merge,
    temporal_lookup,
    upsert,
    with_previous,
)

START, OPEN = date(2020, 1, 1), date(9999, 12, 31)
ARGS = dict(key="k", day="d", tracked=["v"], attrs=["a"], tie="n")


def day(n):
    return START + timedelta(days=n)


def observed(spark, rows):
    """Rows of (key, day number, value, tie)."""
    data = [(k, day(d), v, f"{v}{n}", n) for k, d, v, n in rows]
    return spark.createDataFrame(data, "k string, d date, v string, a string, n int")


def versions(df):
    return sorted((r.k, r.v, r.effective_from, r.effective_to, r.is_current) for r in df.collect())


def brute(rows):
    last = {}
    for k, d, v, n in rows:
        if (k, d) not in last or (n, v) > last[k, d]:
            last[k, d] = (n, v)
    out, by_key = [], {}
    for (k, d), (_, v) in sorted(last.items()):
        if k not in by_key or by_key[k][-1][1] != v:
            by_key.setdefault(k, []).append((d, v))
    for k, vs in by_key.items():
        for (d, v), nxt in zip(vs, vs[1:] + [None]):
            out.append((k, v, day(d), day(nxt[0] - 1) if nxt else OPEN, nxt is None))
    return sorted(out, key=lambda r: (r[0], r[1] or "", r[2]))


@pytest.mark.parametrize(
    "values, count", [("AABA", 3), ([None, "A"], 2), (["A", None], 2), (["A", None, None, "A"], 3), ("AAA", 1)]
)
def test_versions_by_change(spark, values, count):
    df = scd2(observed(spark, [("x", i, v, 0) for i, v in enumerate(values)]), **ARGS)
    assert df.count() == count
    assert df.where("is_current").count() == 1
    assert check_intervals(df, "k").count() == 0


def test_last_observation_of_a_day_counts_and_attrs_come_from_first(spark):
    df = scd2(observed(spark, [("x", 0, "A", 1), ("x", 0, "B", 2), ("x", 1, "B", 3), ("x", 2, "C", 1)]), **ARGS)
    assert [(r.v, r.a) for r in df.orderBy("effective_from").collect()] == [("B", "B2"), ("C", "C1")]


def test_merge_in_any_order_equals_rebuild(spark):
    rng = random.Random(7)
    rows = [(rng.choice("xyz"), rng.randrange(40), rng.choice("ABC"), i) for i in range(120)]
    loads = [rows[i::4] for i in range(4)]
    existing, history = scd2(observed(spark, loads[0]), **ARGS), loads[0]
    for load in loads[1:]:
        existing = scd2_merge(existing, observed(spark, history), observed(spark, load), **ARGS)
        history = history + load
    assert versions(existing) == versions(scd2(observed(spark, rows), **ARGS)) == sorted(brute(rows))
    again = scd2_merge(existing, observed(spark, history), observed(spark, loads[2]), **ARGS)
    assert versions(again) == versions(existing)


def test_late_observation_splits_a_version_and_is_found(spark):
    before_rows = [("x", 0, "A", 0), ("x", 4, "A", 0), ("x", 9, "C", 0), ("y", 0, "A", 0)]
    before = scd2(observed(spark, before_rows), **ARGS)
    late = observed(spark, [("x", 2, "B", 0)])
    after = scd2_merge(before, observed(spark, before_rows), late, **ARGS)
    assert [v[1:3] for v in sorted(versions(after), key=lambda v: v[2]) if v[0] == "x"] == [
        ("A", day(0)), ("B", day(2)), ("A", day(4)), ("C", day(9)),
    ]
    moved = sorted((r.k, r.effective_from, r.effective_to) for r in changed_starts(before, after, "k").collect())
    assert moved == [("x", day(2), day(3)), ("x", day(4), day(8))]


def test_overlaps_are_reported(spark):
    first, second = (scd2(observed(spark, [("x", d, v, 0)]), **ARGS) for d, v in ((0, "A"), (5, "B")))
    bad = check_intervals(first.unionByName(second), "k").collect()
    assert [(r.effective_from, r.next_from) for r in bad] == [(day(0), day(5))]
    backwards = spark.createDataFrame([("x", day(3), day(1))], "k string, effective_from date, effective_to date")
    assert check_intervals(backwards, "k").count() == 1


@pytest.mark.parametrize("period", [None, "year", "month"])
def test_temporal_lookup_against_brute_force(spark, period):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.4 else rng.choice("abc"), rng.randrange(900), rng.choice("AB"), i) for i in range(150)]
    dim = scd2(observed(spark, rows), **ARGS)
    facts = [(i, "hot" if rng.random() < 0.4 else rng.choice("abcd"), day(rng.randrange(-50, 1500))) for i in range(400)]
    facts += [(1000, None, day(5)), (1001, "a", None)]
    found = temporal_lookup(
        spark.createDataFrame(facts, "id int, k string, at date"), dim, ["k"], "at", ["v", "effective_from"], "dim_", period=period
    )
    assert found.columns == ["id", "k", "at", "dim_v", "dim_effective_from"]
    known = brute(rows)

    def expected(k, at):
        hits = [(v, f) for key, v, f, to, _ in known if key == k and at and f <= at <= to]
        return hits[0] if hits else (None, None)

    got = {r.id: (r.dim_v, r.dim_effective_from) for r in found.collect()}
    assert got == {i: expected(k, at) for i, k, at in facts}


@pytest.mark.parametrize("period", [None, "year"])
def test_temporal_lookup_overlapping_and_broken_intervals(spark, period):
    dim = spark.createDataFrame(
        [("x", day(0), OPEN, 1), ("x", day(5), OPEN, 2), ("x", day(9), day(8), 3), ("x", day(0), day(2000), 4)],
        "k string, effective_from date, effective_to date, sk int",
    )
    facts = spark.createDataFrame([("x", day(9)), ("x", day(3000))], "k string, at date")
    got = temporal_lookup(facts, dim, ["k"], "at", ["sk"], period=period)
    assert sorted((r["at"], r.sk) for r in got.collect()) == [
        (day(9), 1), (day(9), 2), (day(9), 4), (day(3000), 1), (day(3000), 2),
    ]


def test_temporal_lookup_keys_by_other_names_and_timestamps(spark):
    dim = scd2(observed(spark, [("x", 0, "A", 0), ("x", 5, "B", 0)]), **ARGS)
    facts = spark.createDataFrame([("x",)], "who string").withColumn("at", F.lit("2020-01-05 23:59:59").cast("timestamp"))
    assert temporal_lookup(facts, dim, {"who": "k"}, "at", {"value": "v"}, period="month").first().value == "A"


def test_null_safe_lookup(spark):
    dim = spark.createDataFrame([("Pass", None, 1), ("Pass", "Out", 2)], "t string, o string, sk int")
    facts = spark.createDataFrame([("Pass", None), ("Pass", "Out"), ("Shot", None)], "t string, o string")
    got = null_safe_lookup(facts, dim, ["t", "o"], ["sk"])
    assert sorted((r.t, r.o or "", r.sk) for r in got.collect()) == [("Pass", "", 1), ("Pass", "Out", 2), ("Shot", "", None)]


def test_fallback_lookup_rules(spark):
    ref = spark.createDataFrame(
        [("Full A B", 1959), ("Full B", 1980), ("Old Man", 1960), ("New Man", 2010), ("Too New", 2011), ("Twice", 1990), ("Twice", 1991)],
        "name string, year int",
    )
    people = spark.createDataFrame(
        [("Full A B", None), ("Full X B", None), ("Old Man", None), ("New Man", None), ("Too New", None), ("Twice", None),
         ("Old Man", 1975), ("Nobody", None)],
        "name string, year int",
    )
    short = F.concat_ws(" ", F.get(F.split("name", " "), F.lit(0)), F.element_at(F.split("name", " "), -1))
    got = fallback_lookup(people, ref, ["name", F.when(F.size(F.split("name", " ")) > 2, short)], "name", "year", "year", (1960, 2010))
    # Known under the full name but with an invalid year: the short name is not tried.
    assert sorted(got.collect(), key=str) == sorted(
        [("Full A B", None), ("Full X B", 1980), ("Old Man", 1960), ("New Man", 2010), ("Too New", None), ("Twice", 1990),
         ("Old Man", 1975), ("Nobody", None)],
        key=str,
    )


def test_latest_previous_upsert(spark):
    df = observed(spark, [("x", 0, "A", 0), ("x", 1, "B", 0), ("x", 2, "A", 0), ("x", 3, "A", 1), ("y", 0, "C", 0)])
    assert {(r.k, r.v, r.n) for r in latest(df, "k", ["d"]).collect()} == {("x", "A", 1), ("y", "C", 0)}
    assert {tuple(r) for r in with_previous(df, "k", ["d"], "v").collect()} == {("x", "A", "B"), ("y", "C", None)}
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "id int, v string")
    once = upsert(old, new, ["id"])
    assert sorted(once.collect()) == sorted(upsert(once, new, ["id"]).collect()) == [(1, "a"), (2, "c"), (3, "d")]


def test_join_loss_with_null_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1,), (1,)], "id int")
    assert join_loss(df, {"d": (dim, {"k": "id"})}).collect() == [("d", 4, 2, 3, 2)]


@pytest.mark.parametrize("seed", range(6))
def test_a_day_replaced_equals_a_rebuild(spark, seed):
    """Days come, change and go in any order; only the day itself and what follows it are observed."""
    rng = random.Random(seed)
    days: dict[int, list] = {}
    existing = scd2(observed(spark, []), **ARGS)
    for _ in range(8):
        at = rng.randrange(1, 9)
        before = days.get(at, [])
        days[at] = [(k, at, rng.choice(["a", "b", None]), rng.randrange(4)) for k in rng.sample("xyz", rng.randrange(4))]
        touched = observed(spark, before + days[at]).select("k")
        after = observed(spark, [r for d, own in days.items() if d > at for r in own])
        found = scd2_day(existing, str(day(at)), touched, observed(spark, days[at]), after, **ARGS)
        want = scd2(observed(spark, [r for own in days.values() for r in own]), **ARGS)
        rows = found.select(*want.columns).collect()
        assert sorted(map(str, rows)) == sorted(map(str, want.collect()))
        existing = spark.createDataFrame(rows, want.schema)
