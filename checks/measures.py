"""Facts, match measures and the reports over them."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.history import VERSIONS, VERSIONS_SQL, last_order
from checks.registry import query, text, total
from checks.scalars import ZONE_SQL, xy
from checks.windows import week
from matchlytics.functions import date_key, hash_key, padj, per90, pitch_zone, rate
from matchlytics.operators import (
    cond_counts,
    correlation,
    cube_levels,
    flatten,
    grid,
    histogram,
    intervals_played,
    null_safe_lookup,
    opponent_total,
    pivot_table,
    rollup_levels,
    scd2,
    temporal_lookup,
)
from matchlytics.plans.stats import possession

MINUTES_SQL = """
    m AS (SELECT strftime(ts, '%Y-%m-%d') AS day, user_id, event_type, value, CAST(hour(ts) * 60 + minute(ts) AS BIGINT) AS minute FROM events),
    ends AS (SELECT day, max(minute) AS end_min FROM m GROUP BY day),
    span AS (SELECT day, user_id, min(minute) FILTER (event_type = 'signup') AS entry_min,
                    min(minute) FILTER (event_type = 'error') AS exit_min FROM m GROUP BY ALL),
    played AS (SELECT day, user_id, CAST(greatest(0, coalesce(exit_min, end_min) - entry_min) AS INTEGER) AS minutes_played
               FROM span JOIN ends USING (day) WHERE entry_min IS NOT NULL)"""
COUNTS_SQL = """
    counted AS (SELECT strftime(ts, '%Y-%m-%d') AS day, user_id, count(*) FILTER (event_type = 'click') AS clicks,
                       count(*) FILTER (event_type = 'click' AND value >= 20) AS accurate_clicks,
                       count(*) FILTER (event_type = 'purchase') AS purchases, count(*) FILTER (event_type = 'error') AS errors,
                       CAST(sum(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,6)) ELSE 0 END) AS DOUBLE) AS spent
                FROM events GROUP BY ALL)"""


def _timed(t):
    return t.events.select(
        text("ts").alias("day"), "user_id", "event_type", (F.hour("ts") * 60 + F.minute("ts")).cast("bigint").alias("minute")
    )


def _minutes(t):
    rows = _timed(t)
    kind = F.col("event_type")
    return intervals_played(
        rows.where(kind == "signup").withColumnRenamed("minute", "entry_min"),
        rows.where(kind == "error").withColumnRenamed("minute", "exit_min"),
        rows.groupBy("day").agg(F.max("minute").alias("end_min")),
        ["day"],
        ["user_id"],
    )


def _counts(t):
    kind, value = F.col("event_type"), F.col("value")
    return cond_counts(
        t.events.select(text("ts").alias("day"), "user_id", "event_type", "value"),
        ["day", "user_id"],
        {
            "clicks": kind == "click",
            "accurate_clicks": (kind == "click") & (value >= 20),
            "purchases": kind == "purchase",
            "errors": kind == "error",
        },
        {"spent": (F.when(kind == "purchase", value), "decimal(18,6)")},
    ).withColumn("spent", F.col("spent").cast("double"))


@query(f"WITH {MINUTES_SQL} SELECT day, user_id, minutes_played FROM played")
def q17_minutes_played(t):
    return _minutes(t)


@query(f"WITH {MINUTES_SQL}, {COUNTS_SQL} SELECT * FROM counted JOIN played USING (day, user_id)")
def q18_counts_with_minutes(t):
    return _counts(t).join(_minutes(t), ["day", "user_id"])


@query(f"WITH {COUNTS_SQL} SELECT * FROM counted")
def q19_conditional_counts(t):
    return _counts(t)


@query(f"""
    WITH {COUNTS_SQL}
    SELECT substr(day, 1, 7) AS season, user_id, count(*) AS matches_played, CAST(sum(clicks) AS BIGINT) AS clicks,
           CAST(sum(purchases) AS BIGINT) AS purchases, CAST(sum(errors) AS BIGINT) AS errors,
           CAST(sum(CAST(spent AS DECIMAL(18,2))) AS DOUBLE) AS spent
    FROM counted GROUP BY ALL""")
def q20_season_totals(t):
    return _counts(t).groupBy(F.substring("day", 1, 7).alias("season"), "user_id").agg(
        F.count("*").alias("matches_played"),
        *[F.sum(c).alias(c) for c in ("clicks", "purchases", "errors")],
        total("spent").alias("spent"),
    )


@query("""
    WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, arg_min(event_type, event_id) AS first_type,
                      count(*) FILTER (event_type = 'error' AND value > 100) AS red, count(*) FILTER (event_type = 'error') AS cards
               FROM events GROUP BY ALL)
    SELECT user_id, count(*) FILTER (first_type = 'signup') AS starts, CAST(sum(cards) AS BIGINT) AS cards,
           CAST(sum(red) AS BIGINT) AS red_cards FROM d GROUP BY user_id""")
def q20b_starts_and_cards(t):
    error = F.col("event_type") == "error"
    days = cond_counts(
        t.events.select("user_id", text("ts").alias("day"), "event_id", "event_type", "value"),
        ["user_id", "day"],
        {"cards": error, "red": error & (F.col("value") > 100)},
        first=F.min(F.struct("event_id", "event_type")),
    )
    return days.groupBy("user_id").agg(
        F.count_if(F.col("first.event_type") == "signup").alias("starts"),
        F.sum("cards").alias("cards"),
        F.sum("red").alias("red_cards"),
    )


TEAM_SQL = """
    g AS (SELECT strftime(date_trunc('week', l_shipdate), '%Y-%m-%d') AS week, l_linestatus AS side,
                 count(*) FILTER (l_returnflag = 'R') AS passes, count(*) FILTER (l_returnflag = 'A') AS actions,
                 count(*) FILTER (l_returnflag = 'R' AND l_quantity * 2.4::DOUBLE >= 40) AS passes_high,
                 count(*) FILTER (l_returnflag = 'A' AND l_quantity * 2.4::DOUBLE >= 40) AS actions_high,
                 sum(CASE WHEN abs(l_quantity) > 45 THEN 0 ELSE CAST(l_quantity AS DECIMAL(18,2)) END) AS ball_time
          FROM lineitem GROUP BY ALL),
    s AS (SELECT *, CAST(sum(passes) OVER w AS BIGINT) - passes AS passes_opponent, CAST(sum(passes_high) OVER w AS BIGINT) - passes_high
                    AS passes_high_opponent, sum(ball_time) OVER w AS ball_time_match FROM g WINDOW w AS (PARTITION BY week)),
    m AS (SELECT *, CASE WHEN ball_time_match > 0 THEN CAST(ball_time AS DOUBLE) / CAST(ball_time_match AS DOUBLE) * 100 ELSE 50 END
                    AS share FROM s)"""


def _teams(t):
    flag, high = F.col("l_returnflag"), xy()[0] >= 40
    own = cond_counts(
        t.lineitem.select(week(), F.col("l_linestatus").alias("side"), "l_returnflag", "l_quantity"),
        ["week", "side"],
        {
            "passes": flag == "R",
            "actions": flag == "A",
            "passes_high": (flag == "R") & high,
            "actions_high": (flag == "A") & high,
        },
        {"ball_time": ("l_quantity", "decimal(18,2)", 45)},
    )
    both = opponent_total(own, ["week"], ["passes", "passes_high", "ball_time"])
    return both.withColumn("share", possession("ball_time", "ball_time_match"))


@query(f"""
    WITH {TEAM_SQL}
    SELECT week, side, round(share, 4) AS possession_pct, round(passes_opponent / nullif(actions, 0), 4) AS ppda FROM m""")
def q21_team_match_stats(t):
    return _teams(t).select(
        "week", "side", F.round("share", 4).alias("possession_pct"), F.round(rate("passes_opponent", "actions"), 4).alias("ppda")
    )


@query(f"""
    WITH {TEAM_SQL}
    SELECT week, side, passes_high_opponent, round(passes_high_opponent / nullif(actions_high, 0), 4) AS ppda_high FROM m""")
def q21b_pressing_in_zone(t):
    return _teams(t).select(
        "week", "side", "passes_high_opponent", F.round(rate("passes_high_opponent", "actions_high"), 4).alias("ppda_high")
    )


@query(f"""
    WITH {VERSIONS_SQL},
    f AS (SELECT o_custkey, o_orderdate, l_returnflag, l_linestatus, l_extendedprice,
                 l_quantity * 2.4::DOUBLE AS x, l_discount * 800::DOUBLE AS y
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    k AS (SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem)
    SELECT CAST(strftime(f.o_orderdate, '%Y%m') AS INTEGER) AS month_id, CAST({ZONE_SQL} AS INTEGER) AS location_id,
           md5(concat_ws('~', coalesce(length(CAST(k.l_returnflag AS VARCHAR)) || ':' || CAST(k.l_returnflag AS VARCHAR), '-'), coalesce(length(CAST(k.l_linestatus AS VARCHAR)) || ':' || CAST(k.l_linestatus AS VARCHAR), '-'))) AS type_sk, v.o_orderpriority AS priority,
           count(*) AS events, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price
    FROM f LEFT JOIN v ON f.o_custkey = v.o_custkey AND CAST(f.o_orderdate AS DATE) BETWEEN v.effective_from AND v.effective_to
           LEFT JOIN k ON f.l_returnflag = k.l_returnflag AND f.l_linestatus IS NOT DISTINCT FROM k.l_linestatus
    GROUP BY ALL""")
def q22_event_fact(t):
    """Flatten, zone, match join, temporal and null-safe lookups, then a summary of the fact."""
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    flat = flatten(
        t.lineitem,
        {
            "o_orderkey": "l_orderkey",
            "flag": "l_returnflag",
            "status": "l_linestatus",
            "price": "l_extendedprice",
            "location_id": pitch_zone(*xy()),
        },
    )
    types = t.lineitem.select(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status")).distinct()
    facts = temporal_lookup(
        flat.join(orders, "o_orderkey"),
        scd2(t.orders, **VERSIONS),
        ["o_custkey"],
        "o_orderdate",
        {"priority": "o_orderpriority"},
        period="year",
        horizon=last_order(t),
    )
    facts = null_safe_lookup(
        facts, types.withColumn("type_sk", hash_key("flag", "status")), ["flag", "status"], ["type_sk"]
    )
    month = F.floor(date_key("o_orderdate") / 100).cast("int").alias("month_id")
    return facts.groupBy(month, "location_id", "type_sk", "priority").agg(
        F.count("*").alias("events"), total("price").alias("price")
    )


@query(f"""
    WITH {MINUTES_SQL}, {COUNTS_SQL},
    p AS (SELECT user_id, CAST(sum(clicks) AS BIGINT) AS clicks, CAST(sum(accurate_clicks) AS BIGINT) AS accurate,
                 CAST(sum(purchases) AS BIGINT) AS goals, CAST(sum(errors) AS BIGINT) AS errors, sum(CAST(spent AS DECIMAL(18,2))) AS spent,
                 CAST(sum(minutes_played) AS BIGINT) AS minutes FROM counted JOIN played USING (day, user_id) GROUP BY user_id)
    SELECT user_id, round(goals - CAST(spent AS DOUBLE) / 50, 4) AS g_minus_xg,
           round(CAST(goals AS DOUBLE) / nullif(minutes, 0) * 90, 4) AS goals_90,
           round(CAST(accurate AS DOUBLE) / nullif(clicks, 0) * 100, 4) AS accuracy_pct,
           round(CAST(errors AS DOUBLE) / nullif(goals, 0) * 100, 4) AS error_pct
    FROM p""")
def q25_player_ratios(t):
    days = _counts(t).join(_minutes(t), ["day", "user_id"])
    players = days.groupBy("user_id").agg(
        *[F.sum(c).alias(c) for c in ("clicks", "accurate_clicks", "purchases", "errors")],
        total("spent").alias("spent"),
        F.sum("minutes_played").alias("minutes"),
    )
    return players.select(
        "user_id",
        F.round(F.col("purchases") - F.col("spent") / 50, 4).alias("g_minus_xg"),
        F.round(per90("purchases", "minutes"), 4).alias("goals_90"),
        F.round(rate("accurate_clicks", "clicks", 100), 4).alias("accuracy_pct"),
        F.round(rate("errors", "purchases", 100), 4).alias("error_pct"),
    )


@query(f"""
    WITH {TEAM_SQL}
    SELECT week, side, round(CAST(actions AS DOUBLE) / nullif(CAST(ball_time AS DOUBLE), 0) * 90 * ((100 - share) / nullif(share, 0)), 4)
             AS padj_actions_90
    FROM m""")
def q26_possession_adjusted(t):
    adjusted = padj("actions", F.col("ball_time").cast("double"), "share", 100 - F.col("share"))
    return _teams(t).select("week", "side", F.round(adjusted, 4).alias("padj_actions_90"))


def _order_measures():
    return {"orders": ("count", F.lit(1)), "total": ("sum", F.col("o_totalprice").cast("decimal(18,2)"))}


@query("""
    SELECT CAST(3 - grouping(year(o_orderdate)) - grouping(month(o_orderdate)) - grouping(o_orderstatus) AS INTEGER) AS level,
           CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, o_orderstatus,
           count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders GROUP BY ROLLUP (year(o_orderdate), month(o_orderdate), o_orderstatus)""")
def q27_rollup(t):
    rows = t.orders.select(
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), "o_orderstatus", "o_totalprice"
    )
    levels = rollup_levels(rows, ["year", "month", "o_orderstatus"], _order_measures())
    return levels.withColumn("total", F.col("total").cast("double"))


@query("""
    SELECT n_name, o_orderpriority, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'
    GROUP BY ALL""")
def q28_slice_and_dice(t):
    day = F.col("o_orderdate")
    year = t.orders.where((day >= F.lit("1997-01-01").cast("timestamp_ntz")) & (day < F.lit("1998-01-01").cast("timestamp_ntz")))
    per_customer = cond_counts(
        year, ["o_custkey", "o_orderpriority"], sums={"total": ("o_totalprice", "decimal(18,2)")}, orders=F.count("*")
    )
    buyers = t.customer.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    return (
        per_customer.join(buyers, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name", "o_orderpriority")
        .agg(F.sum("orders").alias("orders"), F.sum("total").cast("double").alias("total"))
    )


@query("""
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) FILTER (o_orderstatus = 'F') AS F,
           count(*) FILTER (o_orderstatus = 'O') AS O, count(*) FILTER (o_orderstatus = 'P') AS P
    FROM orders GROUP BY 1""")
def q29_pivot(t):
    rows = t.orders.select(F.year("o_orderdate").alias("year"), "o_orderstatus")
    return pivot_table(rows, ["year"], "o_orderstatus", ["F", "O", "P"], F.count(F.lit(1)), empty=0)


@query("""
    SELECT o_orderpriority, o_orderstatus, grouping(o_orderpriority, o_orderstatus) AS grouping_id, count(*) AS orders,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders GROUP BY CUBE (o_orderpriority, o_orderstatus)""")
def q30_cube(t):
    return cube_levels(t.orders, ["o_orderpriority", "o_orderstatus"], _order_measures()).withColumn("total", F.col("total").cast("double"))


@query("""
    SELECT l_returnflag, CAST(floor(l_quantity * 2.4::DOUBLE / 10) AS BIGINT) AS cell_x,
           CAST(floor(l_discount * 800::DOUBLE / 10) AS BIGINT) AS cell_y, count(*) AS rows
    FROM lineitem GROUP BY ALL""")
def q31_density_grid(t):
    return grid(t.lineitem, *xy(), 10, 10, ["l_returnflag"])


@query("""
    WITH u AS (SELECT user_id, count(*) FILTER (event_type = 'purchase') * 100.0::DOUBLE / count(*) AS pct FROM events GROUP BY user_id)
    SELECT CAST(floor(pct / 5) AS BIGINT) AS bin, floor(pct / 5) * 5 AS bin_from, count(*) AS rows FROM u GROUP BY ALL""")
def q32_histogram(t):
    users = cond_counts(t.events, ["user_id"], {"bought": F.col("event_type") == "purchase"}, events=F.count("*"))
    return histogram(users, F.col("bought") * 100.0 / F.col("events"), 5)


@query("""
    SELECT p_brand, count(*) AS lines FROM lineitem JOIN part ON l_partkey = p_partkey
    GROUP BY p_brand ORDER BY lines DESC, p_brand LIMIT 10""")
def q32b_top_ten(t):
    per_part = t.lineitem.groupBy("l_partkey").agg(F.count("*").alias("n"))
    brands = per_part.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand").agg(F.sum("n").alias("lines"))
    return brands.orderBy(F.col("lines").desc(), "p_brand").limit(10)


@query("""
    SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 6) AS correlation FROM lineitem GROUP BY l_returnflag""")
def q33_correlation(t):
    pairs = correlation(t.lineitem, "l_quantity", "l_extendedprice", ["l_returnflag"])
    return pairs.withColumn("correlation", F.round("correlation", 6))


@query("""
    SELECT s.n_name AS supplier_nation, c.n_name AS customer_nation, count(*) AS lines,
           count(*) FILTER (l_returnflag = 'R') AS returned, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
         JOIN nation s ON s_nationkey = s.n_nationkey JOIN nation c ON c_nationkey = c.n_nationkey
    GROUP BY ALL""")
def q48_head_to_head(t):
    nation = t.nation.select("n_nationkey", "n_name")
    buyers = t.orders.select("o_orderkey", "o_custkey").join(
        t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")
    )
    lines = t.lineitem.select("l_orderkey", "l_suppkey", "l_returnflag", "l_extendedprice")
    pairs = cond_counts(
        lines.join(buyers, F.col("l_orderkey") == F.col("o_orderkey")).join(
            t.supplier, F.col("l_suppkey") == F.col("s_suppkey")
        ),
        ["s_nationkey", "c_nationkey"],
        {"returned": F.col("l_returnflag") == "R"},
        lines=F.count("*"),
        total=total("l_extendedprice"),
    )
    return (
        pairs.join(nation.toDF("s_nationkey", "supplier_nation"), "s_nationkey")
        .join(nation.toDF("c_nationkey", "customer_nation"), "c_nationkey")
        .select("supplier_nation", "customer_nation", "lines", "returned", "total")
    )


@query(f"""
    WITH p AS (SELECT *, l_quantity * 2.4::DOUBLE AS x, l_discount * 800::DOUBLE AS y FROM lineitem WHERE l_returnflag = 'R')
    SELECT l_orderkey, l_partkey, l_suppkey, round(x, 4) AS x, round(y, 4) AS y, CAST({ZONE_SQL} AS INTEGER) AS zone, l_linestatus AS outcome
    FROM p""")
def q50_located_rows(t):
    x, y = xy()
    return t.lineitem.where(F.col("l_returnflag") == "R").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        F.round(x, 4).alias("x"),
        F.round(y, 4).alias("y"),
        pitch_zone(*xy()).alias("zone"),
        F.col("l_linestatus").alias("outcome"),
    )


@query("""
    WITH c AS (SELECT p_type, l_returnflag, count(*) AS lines FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)
    SELECT p_type, l_returnflag, lines, round(CAST(lines AS DOUBLE) / sum(lines) OVER (PARTITION BY p_type) * 100, 4) AS share_pct FROM c""")
def q52_usage_share(t):
    per_part = t.lineitem.groupBy("l_partkey", "l_returnflag").agg(F.count("*").alias("n"))
    usage = (
        per_part.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("p_type", "l_returnflag")
        .agg(F.sum("n").alias("lines"))
    )
    shares = opponent_total(usage, ["p_type"], ["lines"])
    return shares.select("p_type", "l_returnflag", "lines", F.round(rate("lines", "lines_match", 100), 4).alias("share_pct"))


@query("""
    SELECT o_orderpriority, count(*) AS shots, count(*) FILTER (l_returnflag = 'R') AS goals,
           CAST(sum(CAST(l_discount AS DECIMAL(18,6))) AS DOUBLE) AS xg,
           round(count(*) FILTER (l_returnflag = 'R') * 100.0::DOUBLE / count(*), 4) AS conversion_pct
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderpriority""")
def q53_effect_by_pattern(t):
    per_order = cond_counts(
        t.lineitem,
        ["l_orderkey"],
        {"goals": F.col("l_returnflag") == "R"},
        {"xg": ("l_discount", "decimal(18,6)")},
        shots=F.count("*"),
    )
    sums = (
        per_order.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_orderpriority")
        .agg(F.sum("shots").alias("shots"), F.sum("goals").alias("goals"), F.sum("xg").cast("double").alias("xg"))
    )
    return sums.withColumn("conversion_pct", F.round(rate("goals", "shots", 100), 4))
