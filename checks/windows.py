"""Neighbouring rows, form, ranking, running totals."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query, text, total
from matchlytics.functions import match_result
from matchlytics.operators import (
    cond_counts,
    in_order,
    league_position,
    next_value,
    opponent_total,
    previous_value,
    recent,
    running_total,
    top_k,
)


def day():
    return F.to_date("ts")


def week():
    """A week of shipments is a match, its two line statuses are the sides, returns are goals."""
    return text(F.date_trunc("week", "l_shipdate")).alias("week")


SIDES_SQL = """
    g AS (SELECT strftime(date_trunc('week', l_shipdate), '%Y-%m-%d') AS week, l_linestatus AS side,
                 count(*) FILTER (l_returnflag = 'R') AS goals, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
          FROM lineitem GROUP BY ALL),
    s AS (SELECT *, CAST(sum(goals) OVER (PARTITION BY week) AS BIGINT) - goals AS conceded FROM g),
    r AS (SELECT *, CASE WHEN goals > conceded THEN 'W' WHEN goals < conceded THEN 'L' ELSE 'D' END AS result FROM s)"""


def sides(t):
    """Goals, goals conceded and result of both sides of each week."""
    scored = cond_counts(
        t.lineitem.select(week(), F.col("l_linestatus").alias("side"), "l_returnflag", "l_quantity"),
        ["week", "side"],
        {"goals": F.col("l_returnflag") == "R"},
        quantity=total("l_quantity"),
    )
    both = opponent_total(scored, ["week"], ["goals"]).withColumnRenamed("goals_opponent", "conceded").drop("goals_match")
    return both.withColumn("result", match_result("goals", "conceded"))


@query(f"""
    WITH {SIDES_SQL} SELECT side, result, count(*) AS weeks, CAST(sum(goals) AS BIGINT) AS goals FROM r GROUP BY ALL""")
def q23_results(t):
    return sides(t).groupBy("side", "result").agg(F.count("*").alias("weeks"), F.sum("goals").alias("goals"))


@query("""
    WITH n AS (SELECT user_id, event_type, lead(event_type) OVER w AS next_type, lead(value) OVER w AS next_value
               FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    SELECT user_id, count(*) AS assists, CAST(sum(CAST(next_value AS DECIMAL(18,2))) AS DOUBLE) AS xa
    FROM n WHERE event_type = 'view' AND next_type = 'purchase' GROUP BY user_id""")
def q24_next_event(t):
    following = next_value(
        t.events.select("user_id", "ts", "event_id", "event_type", "value"),
        ["user_id"],
        ["ts", "event_id"],
        {"next_type": "event_type", "next_value": "value"},
        bucket=day(),
    )
    assists = following.where((F.col("event_type") == "view") & (F.col("next_type") == "purchase"))
    return assists.groupBy("user_id").agg(F.count("*").alias("assists"), total("next_value").alias("xa"))


@query("""
    WITH p AS (SELECT user_id, event_type, lag(event_type) OVER w AS before, row_number() OVER w AS n
               FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    SELECT event_type, before, count(*) AS events, CAST(sum(n) AS BIGINT) AS positions FROM p GROUP BY ALL""")
def q24b_previous_event_and_position(t):
    rows = t.events.select("user_id", "ts", "event_id", "event_type")
    placed = in_order(rows, ["user_id"], ["ts", "event_id"], previous={"before": "event_type"}, totals={"n": F.lit(1)}, bucket=day())
    return placed.groupBy("event_type", "before").agg(F.count("*").alias("events"), F.sum("n").alias("positions"))


@query("""
    WITH c AS (SELECT c_mktsegment, o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
               FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
    SELECT c_mktsegment, o_custkey, total, rank() OVER w AS rank, round(percent_rank() OVER w, 6) AS percentile
    FROM c WINDOW w AS (PARTITION BY c_mktsegment ORDER BY total DESC)""")
def q33b_league_position(t):
    totals = t.orders.groupBy("o_custkey").agg(total("o_totalprice").alias("total"))
    placed = league_position(
        totals.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("c_mktsegment", "o_custkey", "total"),
        ["c_mktsegment"],
        "total",
        bucket=F.floor(F.col("total") / 100_000),
    )
    return placed.withColumns({"rank": F.col("rank").cast("bigint"), "percentile": F.round("percentile", 6)})


@query(f"""
    WITH {SIDES_SQL}
    SELECT week, side, result, count(*) FILTER (result = 'W') OVER w AS wins, CAST(sum(goals) OVER w AS BIGINT) AS recent_goals
    FROM r WINDOW w AS (PARTITION BY side ORDER BY week ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""")
def q34_recent_form(t):
    form = recent(
        sides(t), ["side"], ["week"], 5, {"wins": F.count_if(F.col("result") == "W"), "recent_goals": F.sum("goals")}
    )
    return form.select("week", "side", "result", "wins", "recent_goals")


@query(f"""
    WITH {SIDES_SQL}
    SELECT side, count(*) AS weeks, count(*) FILTER (result = 'W') AS wins, round(avg(goals), 4) AS avg_goals,
           round(avg(quantity), 4) AS avg_quantity FROM r GROUP BY side""")
def q34b_side_averages(t):
    return sides(t).groupBy("side").agg(
        F.count("*").alias("weeks"),
        F.count_if(F.col("result") == "W").alias("wins"),
        F.round(F.avg("goals"), 4).alias("avg_goals"),
        F.round(F.avg("quantity"), 4).alias("avg_quantity"),
    )


@query("""
    WITH n AS (SELECT user_id, count(*) FILTER (event_type = 'purchase') OVER w AS bought,
                      CAST(sum(CAST(value AS DECIMAL(18,2))) OVER w AS DOUBLE) AS spent
               FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
    SELECT user_id, count(*) AS events, CAST(sum(bought) AS BIGINT) AS bought, max(spent) AS most_spent FROM n GROUP BY user_id""")
def q34c_last_ten_events(t):
    window = recent(
        t.events.select("user_id", "ts", "event_id", "event_type", F.col("value").cast("decimal(18,2)").alias("value")),
        ["user_id"],
        ["ts", "event_id"],
        10,
        {"bought": F.count_if(F.col("event_type") == "purchase"), "spent": F.sum("value")},
        bucket=day(),
    )
    return window.groupBy("user_id").agg(
        F.count("*").alias("events"), F.sum("bought").alias("bought"), F.max("spent").cast("double").alias("most_spent")
    )


@query("""
    WITH w AS (SELECT user_id, strftime(date_trunc('week', ts), '%Y-%m-%d') AS week,
                      CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value FROM events GROUP BY ALL),
         p AS (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY week) AS previous FROM w)
    SELECT user_id, week, value, previous, round(value - previous, 2) AS change FROM p""")
def q46_progress(t):
    weeks = t.events.groupBy("user_id", text(F.date_trunc("week", "ts")).alias("week")).agg(total("value").alias("value"))
    earlier = previous_value(weeks, ["user_id"], ["week"], {"previous": "value"})
    return earlier.select(
        "user_id", "week", "value", "previous", F.round(F.col("value") - F.col("previous"), 2).alias("change")
    )


@query("""
    WITH s AS (SELECT user_id, event_id, CAST(value AS DECIMAL(18,2)) AS v, sum(CAST(value AS DECIMAL(18,2))) OVER
                 (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total FROM events),
         m AS (SELECT * FROM (VALUES (250), (1000)) AS x(threshold))
    SELECT user_id, CAST(threshold AS INTEGER) AS threshold, event_id, CAST(total AS DOUBLE) AS total
    FROM s, m WHERE total >= threshold AND total - v < threshold""")
def q47_milestones(t):
    v = F.col("value").cast("decimal(18,2)")
    totals = running_total(
        t.events.select("user_id", "ts", "event_id", v.alias("v")), ["user_id"], ["ts", "event_id"], "v", "total", bucket=day()
    )
    reached = totals.withColumn("threshold", F.explode(F.array(F.lit(250), F.lit(1000))))
    crossed = (F.col("total") >= F.col("threshold")) & (F.col("total") - F.col("v") < F.col("threshold"))
    return reached.where(crossed).select("user_id", "threshold", "event_id", F.col("total").cast("double").alias("total"))


@query("""
    WITH c AS (SELECT c_mktsegment, o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
               FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
    SELECT c_mktsegment, o_custkey, total, CAST(row_number() OVER (PARTITION BY c_mktsegment ORDER BY total DESC, o_custkey) AS INTEGER)
             AS position
    FROM c QUALIFY position <= 3""")
def q49_top_per_group(t):
    totals = t.orders.groupBy("o_custkey").agg(total("o_totalprice").alias("total"))
    members = totals.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("c_mktsegment", "o_custkey", "total")
    return top_k(members, ["c_mktsegment"], [F.col("total").desc(), "o_custkey"], 3)


@query("""
    WITH n AS (SELECT strftime(ts, '%Y-%m-%d') AS day, event_type,
                      lead(event_type) OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS next_type FROM events)
    SELECT day, event_type, next_type, count(*) AS pairs FROM n WHERE next_type IS NOT NULL GROUP BY ALL""")
def q51_consecutive_pairs(t):
    rows = t.events.select("user_id", text("ts").alias("day"), "ts", "event_id", "event_type")
    following = next_value(
        rows, ["user_id", "day"], ["ts", "event_id"], {"next_type": "event_type"}, bucket=F.hour("ts")
    )
    return following.where(F.col("next_type").isNotNull()).groupBy("day", "event_type", "next_type").agg(
        F.count("*").alias("pairs")
    )
