"""Constraint checks and join-loss diagnosis."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from matchlytics.functions import null_outside
from matchlytics.operators import check_fk, check_rules, check_unique, join_loss, null_profile, split_rejects, tag_rejects


@query("""
    SELECT 'lines' AS lookup, count(*) AS rows, count(*) FILTER (lost) AS unmatched_rows, count(*) AS keys,
           count(*) FILTER (lost) AS unmatched_keys
    FROM (SELECT NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) AS lost FROM orders)
    UNION ALL
    SELECT 'rich customers', count(*), count(*) FILTER (lost), count(DISTINCT o_custkey), count(DISTINCT o_custkey) FILTER (lost)
    FROM (SELECT o_custkey, NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 5000) AS lost FROM orders)""")
def q36_join_loss(t):
    rich = t.customer.where(F.col("c_acctbal") > 5000)
    return join_loss(
        t.orders, {"lines": (t.lineitem, {"o_orderkey": "l_orderkey"}), "rich customers": (rich, {"o_custkey": "c_custkey"})}
    )


@query("""
    WITH d AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1)
    SELECT n AS rows, count(*) AS keys FROM d GROUP BY n""")
def q41_unique_keys(t):
    return check_unique(t.lineitem, ["l_orderkey", "l_linenumber"]).groupBy("rows").agg(F.count("*").alias("keys"))


@query("""
    WITH l AS (SELECT l_orderkey AS o, CASE WHEN l_returnflag <> 'N' THEN l_partkey END AS p, l_suppkey AS s FROM lineitem),
    a AS (SELECT o, NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = o AND o_orderstatus <> 'P') AS lost FROM l),
    b AS (SELECT p, NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = p AND p_size > 25) AS lost FROM l WHERE p IS NOT NULL),
    c AS (SELECT s, NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = s) AS lost FROM l)
    SELECT 'orders' AS reference, count(*) AS rows, count(*) FILTER (lost) AS unmatched_rows,
           count(DISTINCT o) FILTER (lost) AS unmatched_keys FROM a
    UNION ALL SELECT 'part', count(*), count(*) FILTER (lost), count(DISTINCT p) FILTER (lost) FROM b
    UNION ALL SELECT 'supplier', count(*), count(*) FILTER (lost), count(DISTINCT s) FILTER (lost) FROM c""")
def q42_foreign_keys(t):
    lines = t.lineitem.select(
        "l_orderkey", "l_suppkey", F.when(F.col("l_returnflag") != "N", F.col("l_partkey")).alias("l_partkey")
    )
    return check_fk(
        lines,
        {
            "orders": (t.orders.where(F.col("o_orderstatus") != "P"), {"l_orderkey": "o_orderkey"}),
            "part": (t.part.where(F.col("p_size") > 25), {"l_partkey": "p_partkey"}),
            "supplier": (t.supplier, {"l_suppkey": "s_suppkey"}),
        },
    )


@query("""
    WITH l AS (SELECT nullif(l_returnflag, 'N') AS flag, CASE WHEN l_discount BETWEEN 0.03 AND 0.08 THEN l_discount END AS discount,
                      l_orderkey AS key FROM lineitem)
    SELECT 'flag' AS "column", count(*) AS rows, count(*) FILTER (flag IS NULL) AS nulls FROM l
    UNION ALL SELECT 'discount', count(*), count(*) FILTER (discount IS NULL) FROM l
    UNION ALL SELECT 'key', count(*), count(*) FILTER (key IS NULL) FROM l""")
def q43_null_profile(t):
    return null_profile(
        t.lineitem.select(
            F.nullif("l_returnflag", F.lit("N")).alias("flag"),
            null_outside("l_discount", 0.03, 0.08).alias("discount"),
            F.col("l_orderkey").alias("key"),
        )
    )


@query("""
    SELECT 'price_positive' AS rule, count(*) AS rows, count(*) FILTER (NOT l_extendedprice > 0) AS violations FROM lineitem
    UNION ALL SELECT 'discount_small', count(*), count(*) FILTER (NOT l_discount BETWEEN 0 AND 0.08) FROM lineitem
    UNION ALL SELECT 'known_flag', count(*), count(*) FILTER (NOT l_returnflag IN ('A', 'R')) FROM lineitem
    UNION ALL SELECT 'short_status', count(*), count(*) FILTER (NOT length(l_linestatus) <= 10) FROM lineitem""")
def q44_check_rules(t):
    return check_rules(
        t.lineitem,
        {
            "price_positive": F.col("l_extendedprice") > 0,
            "discount_small": F.col("l_discount").between(0, 0.08),
            "known_flag": F.col("l_returnflag").isin("A", "R"),
            "short_status": F.length("l_linestatus") <= 10,
        },
    )



@query("""
    SELECT nullif(concat_ws(',', CASE WHEN l_returnflag = 'N' THEN 'flag' END, CASE WHEN NOT l_quantity <= 40 THEN 'quantity' END), '')
             AS reject_reason, count(*) AS rows
    FROM lineitem GROUP BY 1""")
def q44b_reject_routing(t):
    rules = {"flag": F.nullif("l_returnflag", F.lit("N")).isNotNull(), "quantity": F.col("l_quantity") <= 40}
    return tag_rejects(t.lineitem, rules).groupBy("reject_reason").agg(F.count("*").alias("rows"))


@query("""
    SELECT l_returnflag <> 'N' AND l_quantity <= 40 AS accepted, count(*) AS rows, CAST(sum(l_orderkey) AS BIGINT) AS sum_key
    FROM lineitem GROUP BY 1""")
def q44c_accepted_and_rejected(t):
    rules = {"flag": F.nullif("l_returnflag", F.lit("N")).isNotNull(), "quantity": F.col("l_quantity") <= 40}
    parts = split_rejects(t.lineitem, rules)
    sides = [
        side.agg(F.lit(ok).alias("accepted"), F.count("*").alias("rows"), F.sum("l_orderkey").alias("sum_key"))
        for ok, side in zip((True, False), parts)
    ]
    return sides[0].unionByName(sides[1])
