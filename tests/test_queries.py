"""Every registered query against its SQL, and the shape of its plan."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries as registered
from checks import ORACLES, QUERIES
from matchlytics.operators import cond_counts, null_safe_lookup, only_date, opponent_total, role_rows, scd2, temporal_lookup, top_k
from tools.compare import compare, database

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def queries():
    """Those of this library's core; the training-data ones have tests of their own."""
    return QUERIES


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES) and len(QUERIES) > 80
    assert set(QUERIES) <= set(registered()) and set(oracle_sql()) <= set(registered())


def test_entry(spark):
    assert entry(spark).columns == ["week", "side", "possession_pct", "ppda"] and entry(spark).count() > 0


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, con, name):
    assert compare(spark, con, FOLDER, name) is None


@pytest.mark.parametrize("name", list(queries()))
def test_plan_stays_in_the_jvm_and_joins_by_key(spark, name):
    text = plan(queries()[name](spark, FOLDER))
    for word in ("NestedLoop", "Cartesian", "Python", "BatchEval"):
        assert word not in text


def exchanges(df) -> int:
    return len(re.findall(r"Exchange (?:hash|range)partitioning", plan(df)))


def test_day_filter_and_columns_reach_the_scan(spark):
    rows = spark.read.parquet(f"{FOLDER}/events.parquet")
    text = plan(only_date(rows, "ts", "2024-01-15").select("user_id"))
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in text


def test_versions_shuffle_once_to_combine_and_once_for_both_windows(spark):
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
    versions = scd2(orders, "o_custkey", "o_orderdate", ["o_orderpriority"], tie="o_orderkey")
    assert exchanges(versions) == 2 and plan(versions).count("Window [") == 2
    assert "partial_max" in plan(versions)


def test_lookups_without_broadcast_are_merge_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
        versions = scd2(orders, "o_custkey", "o_orderdate", ["o_orderpriority"])
        for period in (None, "year"):
            text = plan(temporal_lookup(orders.select("o_custkey", "o_orderdate"), versions, ["o_custkey"], "o_orderdate", ["o_orderpriority"], "v_", period=period))
            assert "SortMergeJoin" in text and "NestedLoop" not in text
        dim = orders.select("o_orderstatus").distinct().withColumn("sk", F.col("o_orderstatus"))
        assert "SortMergeJoin" in plan(null_safe_lookup(orders, dim, ["o_orderstatus"], ["sk"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["q09_null_safe_lookup", "q22_event_fact", "q54_standard_values", "q63_event_fact", "q64_player_match_stats"])
def test_no_job_runs_while_a_plan_is_built(spark, monkeypatch, name):
    """Reading a table's schema aside."""

    def runs(self, *args, **options):
        raise AssertionError("a job runs while the plan is built")

    for action in ("first", "head", "take", "collect", "count", "isEmpty", "toLocalIterator", "toPandas"):
        monkeypatch.setattr(type(spark.range(1)), action, runs)
    assert queries()[name](spark, FOLDER).columns


def test_previous_event_and_position_come_out_of_one_sort(spark):
    seen = queries()["q24b_previous_event_and_position"](spark, FOLDER)
    assert plan(seen).count("FileScan") == 2 and exchanges(seen) == 4


@pytest.mark.parametrize("name", ["q27_rollup", "q30_cube"])
def test_levels_multiply_groups_and_not_rows(spark, name):
    text = plan(queries()[name](spark, FOLDER))
    below = text[text.index("Expand") :]
    assert text.count("FileScan") == 1 and "HashAggregate" in below and "partial_sum" in below


def test_top_k_is_cut_before_the_shuffle(spark):
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
    text = plan(top_k(orders, ["o_custkey"], [F.col("o_totalprice").desc()], 3))
    assert text.count("WindowGroupLimit") == 2


def test_roles_need_one_scan_and_no_shuffle(spark):
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    text = plan(role_rows(lines, {"part": {"id": "l_partkey"}, "supplier": {"id": "l_suppkey"}}, role="role"))
    assert text.count("FileScan") == 1 and "Exchange" not in text


def test_opponent_total_has_no_self_join(spark):
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    own = cond_counts(lines, ["l_orderkey", "l_linestatus"], {"n": F.col("l_returnflag") == "R"})
    text = plan(opponent_total(own, ["l_orderkey"], ["n"]))
    assert "Join" not in text and text.count("FileScan") == 1 and ("partial_count_if" in text.lower() or "partial_count" in text)
