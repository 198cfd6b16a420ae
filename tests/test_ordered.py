from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from matchlytics.operators import in_order, league_position, next_value, previous_value, recent, row_index, running_total, top_k

P, O = ["k"], ["t", "id"]
BUCKETS = {"none": lambda: None, "fine": lambda: F.col("t"), "coarse": lambda: F.floor(F.col("t") / 7), "one": lambda: F.lit(0)}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    keys = ["hot"] * 60 + [None] * 20 + list("abcdefgh") * 10
    return [
        (rng.choice(keys), rng.choice([None, *range(60)]), i, rng.choice([None, 1, 2, 3, 5, 8]), rng.choice("xyz"))
        for i in range(500)
    ]


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "k string, t int, id int, v int, w string")


@pytest.fixture(scope="module")
def groups(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
        out.setdefault(r[0], []).append(r)
    return out


@pytest.mark.parametrize("bucket", BUCKETS)
def test_neighbours(df, groups, bucket):
    b = BUCKETS[bucket]()
    nxt = {r.id: (r.nv, r.nw) for r in next_value(df, P, O, {"nv": "v", "nw": "w"}, b).collect()}
    prv = {r.id: r.pw for r in previous_value(df, P, O, {"pw": "w"}, b).collect()}
    assert nxt == {r[2]: (s[3], s[4]) if s else (None, None) for g in groups.values() for r, s in zip(g, g[1:] + [None])}
    assert prv == {r[2]: s[4] if s else None for g in groups.values() for r, s in zip(g, [None] + g[:-1])}


@pytest.mark.parametrize("bucket", BUCKETS)
def test_running_total_and_index(df, groups, bucket):
    b = BUCKETS[bucket]()
    total = running_total(df, P, O, F.coalesce("v", F.lit(0)), "s", b)
    assert total.columns == [*df.columns, "s"]
    got = {r.id: r.s for r in total.collect()}
    place = {r.id: r.n for r in row_index(df, P, O, "n", b).collect()}
    for g in groups.values():
        s = 0
        for n, r in enumerate(g, start=1):
            s += r[3] or 0
            assert (got[r[2]], place[r[2]]) == (s, n)


@pytest.mark.parametrize("bucket", BUCKETS)
def test_all_of_an_order_at_once(df, groups, bucket):
    """Null neighbours, null values and empty sums among them."""
    got = in_order(df, P, O, {"nv": "v", "nw": "w"}, {"pv": "v"}, {"n": F.lit(1), "s": F.col("v")}, BUCKETS[bucket]())
    assert got.columns == [*df.columns, "nv", "nw", "pv", "n", "s"]
    found = {r.id: (r.nv, r.nw, r.pv, r.n, r.s or 0) for r in got.collect()}
    assert len(found) == 500
    for g in groups.values():
        total = 0
        for n, (b, r, a) in enumerate(zip([None] + g[:-1], g, g[1:] + [None]), start=1):
            total += r[3] or 0
            assert found[r[2]] == (a and a[3], a and a[4], b and b[3], n, total)


def test_all_of_an_order_at_once_sorts_once(df):
    text = in_order(df, P, O, {"nv": "v"}, {"pv": "v"}, {"n": F.lit(1)}, F.col("t"))._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 3 and text.count("Window [") == 2


@pytest.mark.parametrize("bucket", BUCKETS)
@pytest.mark.parametrize("block", [5, 8, 10_000])
def test_recent(df, groups, bucket, block):
    out = recent(df, P, O, 5, {"n": F.count("*"), "s": F.sum(F.coalesce("v", F.lit(0)))}, BUCKETS[bucket](), block)
    got = {r.id: (r.n, r.s) for r in out.collect()}
    assert len(got) == 500
    for g in groups.values():
        for i, r in enumerate(g):
            part = g[max(0, i - 4) : i + 1]
            assert got[r[2]] == (len(part), sum(x[3] or 0 for x in part))


@pytest.mark.parametrize("bucket", ["none", "fine", "coarse", "one"])
def test_league_position(df, rows, bucket):
    b = {"none": None, "fine": F.col("v"), "coarse": F.floor(F.col("v") / 3), "one": F.lit(0)}[bucket]
    got = {r.id: (r["rank"], r.percentile) for r in league_position(df, P, "v", b).collect()}
    for k in {r[0] for r in rows}:
        peers = [r for r in rows if r[0] == k]
        for r in peers:
            above = sum(1 for s in peers if (s[3] or 0) > (r[3] or 0))
            share = above / (len(peers) - 1) if len(peers) > 1 else 0.0
            assert got[r[2]] == (above + 1, pytest.approx(share))


def test_single_row_group(spark):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    for bucket in (None, F.col("v")):
        assert league_position(df, ["k"], "v", bucket).collect() == [("a", 1, 1, 0.0)]


@pytest.mark.parametrize("bucket", [None, 10])
def test_league_position_with_nine_in_ten_tied(spark, bucket):
    """Ties are one row in the windows: what is sorted has as many rows as distinct values."""
    rng = random.Random(5)
    rows = [("a" if i % 3 else "b", 50 if rng.random() < 0.9 else rng.choice([None, *range(100)]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v int, id int")
    got = league_position(df, ["k"], "v", None if bucket is None else F.floor(F.col("v") / bucket))
    found = {r.id: (r["rank"], r.percentile) for r in got.collect()}
    for k in "ab":
        peers = sorted([-1 if v is None else v for g, v, _ in rows if g == k], reverse=True)
        first = {v: i for i, v in reversed(list(enumerate(peers)))}
        for g, v, i in rows:
            if g == k:
                above = first[-1 if v is None else v]
                assert found[i] == (above + 1, pytest.approx(above / (len(peers) - 1)))
    plan = str(got._jdf.queryExecution().optimizedPlan())
    assert plan.index("Window [") < plan.rindex("Aggregate [")


def test_top_k(df, groups):
    got = top_k(df, P, [F.col("v").desc_nulls_last(), "id"], 3)
    for k, g in groups.items():
        want = [r[2] for r in sorted(g, key=lambda r: (-(r[3] or 0), r[2]))[:3]]
        assert [r.id for r in got.where(F.col("k").eqNullSafe(k)).orderBy("position").collect()] == want
