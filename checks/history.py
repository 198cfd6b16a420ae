"""Versions, temporal lookups, merging."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query, text, total
from matchlytics.functions import hash_key
from matchlytics.operators import (
    check_intervals,
    fallback_lookup,
    latest,
    not_loaded,
    scd2,
    scd2_merge,
    temporal_lookup,
    upsert,
    with_previous,
)

VERSIONS = dict(key="o_custkey", day="o_orderdate", tracked=["o_orderpriority"], attrs=["o_orderstatus"], tie="o_orderkey")

VERSIONS_SQL = """
    d AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, o_orderpriority, o_orderstatus FROM orders
          QUALIFY row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) = 1),
    c AS (SELECT *, lag(o_orderpriority) OVER w AS before, row_number() OVER w AS n FROM d
          WINDOW w AS (PARTITION BY o_custkey ORDER BY day)),
    v AS (SELECT o_custkey, o_orderpriority, o_orderstatus, day AS effective_from,
                 coalesce(lead(day) OVER (PARTITION BY o_custkey ORDER BY day) - 1, DATE '9999-12-31') AS effective_to
          FROM c WHERE n = 1 OR o_orderpriority IS DISTINCT FROM before)"""
VERSION_COLUMNS_SQL = """
    SELECT md5(concat_ws('~', coalesce(length(CAST(o_custkey AS VARCHAR)) || ':' || CAST(o_custkey AS VARCHAR), '-'), coalesce(length(CAST(strftime(effective_from, '%Y-%m-%d') AS VARCHAR)) || ':' || CAST(strftime(effective_from, '%Y-%m-%d') AS VARCHAR), '-'))) AS version_sk, o_custkey, o_orderpriority,
           o_orderstatus, strftime(effective_from, '%Y-%m-%d') AS effective_from,
           strftime(effective_to, '%Y-%m-%d') AS effective_to, effective_to = DATE '9999-12-31' AS is_current FROM v"""


def last_order(t):
    return t.orders.agg(F.max(F.to_date("o_orderdate"))).scalar()


def _shown(versions):
    keyed = versions.select(hash_key("o_custkey", "effective_from").alias("version_sk"), "*")
    return keyed.withColumns({c: text(c) for c in ("effective_from", "effective_to")})


@query(f"WITH {VERSIONS_SQL} {VERSION_COLUMNS_SQL}")
def q14_versions(t):
    return _shown(scd2(t.orders, **VERSIONS))


@query(f"WITH {VERSIONS_SQL} {VERSION_COLUMNS_SQL}")
def q14b_versions_merged(t):
    """Loading in two parts, the later one first, gives the versions of a single load."""
    split = F.lit("1998-06-01").cast("timestamp_ntz")
    late, early = t.orders.where(F.col("o_orderdate") >= split), t.orders.where(F.col("o_orderdate") < split)
    return _shown(scd2_merge(scd2(late, **VERSIONS), late, early, **VERSIONS))


@query(f"""
    WITH {VERSIONS_SQL},
    l AS (SELECT o_custkey, l_shipdate, l_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    SELECT v.o_orderpriority AS priority, v.o_orderstatus AS status, count(*) AS lines,
           CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
    FROM l LEFT JOIN v ON l.o_custkey = v.o_custkey AND CAST(l_shipdate AS DATE) BETWEEN effective_from AND effective_to
    GROUP BY ALL""")
def q15_temporal_lookup(t):
    orders = t.orders.select("o_orderkey", "o_custkey")
    lines = t.lineitem.select("l_orderkey", "l_shipdate", "l_quantity").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    found = temporal_lookup(
        lines,
        scd2(t.orders, **VERSIONS),
        ["o_custkey"],
        "l_shipdate",
        {"priority": "o_orderpriority", "status": "o_orderstatus"},
        period="year",
        horizon=last_order(t),
    )
    return found.groupBy("priority", "status").agg(F.count("*").alias("lines"), total("l_quantity").alias("quantity"))


@query(f"""
    WITH {VERSIONS_SQL},
    l AS (SELECT o_custkey, o_orderdate, l_shipdate, l_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    SELECT a.o_orderpriority AS order_priority, b.o_orderpriority AS ship_priority, count(*) AS lines
    FROM l LEFT JOIN v a ON l.o_custkey = a.o_custkey AND CAST(o_orderdate AS DATE) BETWEEN a.effective_from AND a.effective_to
           LEFT JOIN v b ON l.o_custkey = b.o_custkey AND CAST(l_shipdate AS DATE) BETWEEN b.effective_from AND b.effective_to
    GROUP BY ALL""")
def q16_two_roles_of_a_dimension(t):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    lines = t.lineitem.select("l_orderkey", "l_shipdate").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    dim = scd2(t.orders, **VERSIONS).withColumnRenamed("o_orderpriority", "priority")
    for role, day in (("order_", "o_orderdate"), ("ship_", "l_shipdate")):
        lines = temporal_lookup(lines, dim, ["o_custkey"], day, ["priority"], prefix=role, period="year", horizon=last_order(t))
    return lines.groupBy("order_priority", "ship_priority").agg(F.count("*").alias("lines"))


@query("""
    WITH r AS (SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN c_name ELSE regexp_extract(c_name, '([0-9]+)') END AS name,
                      c_nationkey AS year FROM customer WHERE c_mktsegment <> 'FURNITURE'),
         f AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 99 END AS year, a.name IS NOT NULL AS by_name, a.year AS y1, b.year AS y2
               FROM customer LEFT JOIN r a ON c_name = a.name LEFT JOIN r b ON regexp_extract(c_name, '([0-9]+)') = b.name)
    SELECT c_custkey, CAST(coalesce(year, CASE WHEN CASE WHEN by_name THEN y1 ELSE y2 END BETWEEN 5 AND 20
                                               THEN CASE WHEN by_name THEN y1 ELSE y2 END END) AS INTEGER) AS year
    FROM f""")
def q35_fallback_lookup(t):
    digits = F.regexp_extract("c_name", "([0-9]+)", 1)
    ref = t.customer.where(F.col("c_mktsegment") != "FURNITURE").select(
        F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_name")).otherwise(digits).alias("name"),
        F.col("c_nationkey").alias("known_year"),
    )
    people = t.customer.select("c_custkey", "c_name", F.when(F.col("c_acctbal") < 0, 99).alias("year"))
    return fallback_lookup(people, ref, ["c_name", digits], "name", "known_year", "year", (5, 20)).select("c_custkey", "year")


@query("""
    WITH u AS (SELECT o_orderstatus, o_totalprice AS price FROM orders WHERE o_orderstatus <> 'F'
               UNION ALL SELECT o_orderstatus, o_totalprice + 1 FROM orders WHERE o_orderstatus = 'F')
    SELECT o_orderstatus, count(*) AS orders, CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM u GROUP BY o_orderstatus""")
def q39_upsert(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    stored = rows.where(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    changed = rows.where(F.col("o_orderstatus") == "F").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    new = rows.where(F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")).where(F.col("o_orderstatus") != "F")
    return upsert(stored, changed.unionByName(new), ["o_orderkey"]).groupBy("o_orderstatus").agg(
        F.count("*").alias("orders"), total("o_totalprice").alias("total")
    )


@query("""
    SELECT o_orderpriority, count(*) AS orders FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) GROUP BY o_orderpriority""")
def q39b_not_yet_loaded(t):
    loaded = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return not_loaded(t.orders, loaded, ["o_orderkey"]).groupBy("o_orderpriority").agg(F.count("*").alias("orders"))


@query(f"""
    WITH {VERSIONS_SQL},
    runs AS (SELECT *, o_orderdate >= TIMESTAMP '1998-06-01' AS run FROM orders),
    d2 AS (SELECT run, o_custkey, CAST(o_orderdate AS DATE) AS day, o_orderpriority FROM runs
           QUALIFY row_number() OVER (PARTITION BY run, o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) = 1),
    c2 AS (SELECT *, lag(o_orderpriority) OVER w AS before, row_number() OVER w AS n FROM d2
           WINDOW w AS (PARTITION BY run, o_custkey ORDER BY day)),
    v2 AS (SELECT o_custkey, day AS effective_from,
                  coalesce(lead(day) OVER (PARTITION BY run, o_custkey ORDER BY day) - 1, DATE '9999-12-31') AS effective_to
           FROM c2 WHERE n = 1 OR o_orderpriority IS DISTINCT FROM before),
    o2 AS (SELECT o_custkey, effective_from, effective_to,
                  lead(effective_from) OVER (PARTITION BY o_custkey ORDER BY effective_from, effective_to) AS next_from FROM v2),
    o1 AS (SELECT o_custkey, effective_from, effective_to,
                  lead(effective_from) OVER (PARTITION BY o_custkey ORDER BY effective_from, effective_to) AS next_from FROM v)
    SELECT 'appended' AS load, count(*) AS overlaps FROM o2 WHERE next_from <= effective_to
    UNION ALL SELECT 'merged', count(*) FROM o1 WHERE next_from <= effective_to""")
def q45_interval_integrity(t):
    """Versions computed run by run and appended overlap; merged ones do not."""
    split = F.lit("1998-06-01").cast("timestamp_ntz")
    late, early = t.orders.where(F.col("o_orderdate") >= split), t.orders.where(F.col("o_orderdate") < split)
    first = scd2(early, **VERSIONS)
    loads = {
        "appended": first.unionByName(scd2(late, **VERSIONS)),
        "merged": scd2_merge(first, early, late, **VERSIONS),
    }
    counts = [
        check_intervals(v, "o_custkey").agg(F.lit(name).alias("load"), F.count("*").alias("overlaps"))
        for name, v in loads.items()
    ]
    return counts[0].unionByName(counts[1])


@query("""
    SELECT o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderkey, o_orderpriority, o_orderstatus
    FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def q55_latest_row(t):
    rows = t.orders.select("o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority", "o_orderstatus")
    newest = latest(rows, "o_custkey", ["o_orderdate", "o_orderkey"])
    return newest.select("o_custkey", text("o_orderdate").alias("day"), "o_orderkey", "o_orderpriority", "o_orderstatus")


@query("""
    WITH c AS (SELECT o_custkey, o_orderdate, o_orderkey, o_orderpriority, lag(o_orderpriority) OVER w AS before FROM orders
               WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
         s AS (SELECT * FROM c WHERE o_orderpriority IS DISTINCT FROM before)
    SELECT o_custkey, o_orderpriority, before AS previous_o_orderpriority FROM s
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def q55b_previous_value(t):
    return with_previous(t.orders, "o_custkey", ["o_orderdate", "o_orderkey"], "o_orderpriority")
