"""Projections, cleaning, classification, zones, small dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query, text, total
from matchlytics.functions import (
    classify_like,
    clock_seconds,
    coalesce_leaf,
    date_key,
    first_point,
    id_from_path,
    in_rect,
    null_outside,
    pitch_zone,
    short_name,
    year_bucket,
)
from matchlytics.operators import (
    cond_counts,
    distinct_by_key,
    flatten,
    null_safe_lookup,
    only_configured,
    only_date,
    role_rows,
    standardise,
    typed,
)
from matchlytics.functions import hash_key
from matchlytics.plans.dimensions import date_dim, event_type_dim, zone_dim



def xy():
    """Stand-in for pitch coordinates: 2.4..120 and 0..80."""
    return F.col("l_quantity") * 2.4, F.col("l_discount") * 800


ZONE_SQL = """CASE WHEN x >= 102 AND y >= 18 AND y <= 62 THEN 19
      ELSE 3 * (CASE WHEN x < 20 THEN 0 WHEN x < 40 THEN 1 WHEN x < 60 THEN 2 WHEN x < 80 THEN 3 WHEN x < 100 THEN 4 ELSE 5 END)
         + (CASE WHEN y < 26.6 THEN 1 WHEN y < 53.3 THEN 2 ELSE 3 END) END"""


@query("""
    SELECT event_type, count(*) AS rows, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k,
           CAST(max(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS max_k
    FROM events GROUP BY event_type""")
def q01_nested_fields(t):
    parsed = t.events.withColumn("p", F.from_json("props", "k bigint"))
    flat = flatten(parsed, {"event_type": "event_type", "k": "p.k"})
    return flat.groupBy("event_type").agg(F.count("*").alias("rows"), F.sum("k").alias("sum_k"), F.max("k").alias("max_k"))


@query("""
    SELECT c_mktsegment, count(*) AS documents, CAST(sum(c_custkey) AS BIGINT) AS sum_id, max(c_custkey) AS max_id
    FROM customer GROUP BY c_mktsegment""")
def q01b_key_from_file_name(t):
    named = t.customer.withColumn("path", F.concat(F.lit("lineups/date=2018-05-06/"), "c_custkey", F.lit(".json")))
    keyed = named.select("c_mktsegment", id_from_path("path").alias("id"))
    return keyed.groupBy("c_mktsegment").agg(
        F.count("id").alias("documents"), F.sum("id").alias("sum_id"), F.max("id").alias("max_id")
    )


@query("""
    WITH e AS (
      SELECT event_type,
             CASE event_type WHEN 'click' THEN CASE WHEN value < 50 THEN 'Incomplete' END
                             WHEN 'purchase' THEN CASE WHEN value > 100 THEN 'Goal' ELSE 'Saved' END END AS outcome,
             CASE event_type WHEN 'click' THEN value WHEN 'purchase' THEN value + 1 WHEN 'view' THEN value + 2 END AS x,
             CASE event_type WHEN 'click' THEN value + 10 WHEN 'purchase' THEN value + 20 END AS y
      FROM events)
    SELECT event_type, outcome, count(*) AS rows, CAST(sum(CAST(x AS DECIMAL(18,2))) AS DOUBLE) AS sum_x,
           CAST(sum(CAST(y AS DECIMAL(18,2))) AS DOUBLE) AS sum_y
    FROM e GROUP BY event_type, outcome""")
def q02_coalesced_leaf_and_point(t):
    def of(kind, *fields):
        return F.when(F.col("event_type") == kind, F.struct(*fields)).alias(
            {"click": "pass", "purchase": "shot", "view": "carry"}[kind]
        )

    v = F.col("value")
    nested = t.events.select(
        "event_type",
        of(
            "click",
            F.array(v, v + 10).alias("end_location"),
            F.struct(F.when(v < 50, "Incomplete").alias("name")).alias("outcome"),
        ),
        of(
            "purchase",
            F.array(v + 1, v + 20).alias("end_location"),
            F.struct(F.when(v > 100, "Goal").otherwise("Saved").alias("name")).alias("outcome"),
        ),
        of("view", F.array(v + 2).alias("end_location")),
    )
    x, y = first_point("pass.end_location", "shot.end_location", "carry.end_location")
    flat = flatten(nested, {"event_type": "event_type", "outcome": coalesce_leaf(nested, "outcome.name"), "x": x, "y": y})
    return flat.groupBy("event_type", "outcome").agg(
        F.count("*").alias("rows"), total("x").alias("sum_x"), total("y").alias("sum_y")
    )


@query("""
    SELECT l_returnflag, CAST(sum(CAST(l_extendedprice AS DECIMAL(10,2))) AS DOUBLE) AS price,
           CAST(sum(CAST(l_discount AS DECIMAL(5,2))) AS DOUBLE) AS discount,
           CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS quantity,
           count(*) - count(TRY_CAST(l_extendedprice AS DECIMAL(6,2))) AS too_large
    FROM lineitem GROUP BY l_returnflag""")
def q03_typed_columns(t):
    rows = t.lineitem.select("l_returnflag", "l_extendedprice", "l_discount", "l_quantity", F.col("l_extendedprice").alias("narrow"))
    cast = typed(
        rows,
        {"l_extendedprice": "decimal(10,2)", "l_discount": "decimal(5,2)", "l_quantity": "int", "narrow": "decimal(6,2)"},
    )
    return cast.groupBy("l_returnflag").agg(
        F.sum("l_extendedprice").cast("double").alias("price"),
        F.sum("l_discount").cast("double").alias("discount"),
        F.sum("l_quantity").alias("quantity"),
        F.count_if(F.col("narrow").isNull()).alias("too_large"),
    )


@query("""
    WITH e AS (
      SELECT event_type, hour(ts) * 3600 + minute(ts) * 60 + CAST(millisecond(ts) AS DECIMAL(18,3)) / 1000 AS s,
             CASE WHEN value BETWEEN 0.5 AND 300 THEN value END AS v FROM events)
    SELECT event_type, count(*) FILTER (s <= 18000) AS clocked,
           round(CAST(sum(CAST(s AS DECIMAL(18,3))) FILTER (s <= 18000) AS DOUBLE), 3) AS seconds,
           count(v) AS valued, CAST(sum(CAST(v AS DECIMAL(18,2))) AS DOUBLE) AS value
    FROM e GROUP BY event_type""")
def q04_clock_and_valid_range(t):
    cleaned = t.events.select(
        "event_type",
        clock_seconds(F.date_format("ts", "HH:mm:ss.SSS")).alias("s"),
        null_outside("value", 0.5, 300).alias("v"),
    )
    return cleaned.groupBy("event_type").agg(
        F.count("s").alias("clocked"),
        F.round(F.sum("s").cast("double"), 3).alias("seconds"),
        F.count("v").alias("valued"),
        total("v").alias("value"),
    )


@query(f"""
    WITH p AS (SELECT l_quantity * 2.4::DOUBLE AS x, l_discount * 800::DOUBLE AS y FROM lineitem),
         z AS (SELECT CAST({ZONE_SQL} AS INTEGER) AS zone, x >= 102 AND y BETWEEN 18 AND 62 AS in_box FROM p)
    SELECT zone, count(*) AS rows, count(*) FILTER (in_box) AS in_box FROM z GROUP BY zone""")
def q05_pitch_zones(t):
    return cond_counts(
        t.lineitem.select(pitch_zone(*xy()).alias("zone"), in_rect(*xy()).alias("box")),
        ["zone"],
        {"in_box": F.col("box")},
        rows=F.count("*"),
    )


@query("""
    WITH e AS (SELECT event_type, CASE WHEN value >= 100 THEN 'High' WHEN value < 1 THEN 'Low' END AS outcome FROM events)
    SELECT DISTINCT md5(concat_ws('~', coalesce(length(CAST(event_type AS VARCHAR)) || ':' || CAST(event_type AS VARCHAR), '-'), coalesce(length(CAST(outcome AS VARCHAR)) || ':' || CAST(outcome AS VARCHAR), '-'))) AS event_type_sk,
           CASE WHEN event_type IN ('click', 'view') THEN 'Browse' WHEN event_type IN ('purchase', 'signup') THEN 'Deal'
                ELSE 'Other' END AS event_category,
           event_type, outcome
    FROM e""")
def q06_event_type_dimension(t):
    outcome = F.when(F.col("value") >= 100, "High").when(F.col("value") < 1, "Low")
    categories = ((("click", "view"), "Browse"), (("purchase", "signup"), "Deal"))
    return event_type_dim(t.events, "event_type", outcome, categories)


@query("""
    SELECT CASE WHEN p_name LIKE 'red%' OR p_name LIKE 'hot%' THEN 'warm' WHEN p_name LIKE '%bolt%' THEN 'bolt'
                WHEN p_name LIKE '%ring' THEN 'ring' ELSE 'Unknown' END AS name_group,
           count(*) AS parts, CAST(sum(p_size) AS BIGINT) AS size
    FROM part GROUP BY 1""")
def q07_pattern_ladder(t):
    groups = ((("red%", "hot%"), "warm"), (("%bolt%",), "bolt"), (("%ring",), "ring"))
    return (
        t.part.groupBy(classify_like("p_name", groups).alias("name_group"))
        .agg(F.count("*").alias("parts"), F.sum("p_size").alias("size"))
    )


@query("""
    SELECT c_mktsegment, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""")
def q08_inner_lookup(t):
    # Totals per customer go into the join, so a customer with many orders is one row.
    per_customer = cond_counts(t.orders, ["o_custkey"], sums={"total": ("o_totalprice", "decimal(18,2)")}, orders=F.count("*"))
    joined = per_customer.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("c_mktsegment").agg(
        F.sum("orders").alias("orders"), F.sum("total").cast("double").alias("total")
    )


@query("""
    WITH f AS (SELECT nullif(l_returnflag, 'N') AS flag, l_linestatus AS status FROM lineitem),
         d AS (SELECT DISTINCT flag, status, md5(concat_ws('~', coalesce(length(CAST(flag AS VARCHAR)) || ':' || CAST(flag AS VARCHAR), '-'), coalesce(length(CAST(status AS VARCHAR)) || ':' || CAST(status AS VARCHAR), '-'))) AS pair_sk FROM f)
    SELECT d.pair_sk, f.flag, f.status, count(*) AS rows
    FROM f LEFT JOIN d ON f.flag IS NOT DISTINCT FROM d.flag AND f.status = d.status
    GROUP BY ALL""")
def q09_null_safe_lookup(t):
    facts = t.lineitem.select(F.nullif("l_returnflag", F.lit("N")).alias("flag"), F.col("l_linestatus").alias("status"))
    dim = facts.distinct().withColumn("pair_sk", hash_key("flag", "status"))
    return null_safe_lookup(facts, dim, ["flag", "status"], ["pair_sk"]).groupBy("pair_sk", "flag", "status").agg(
        F.count("*").alias("rows")
    )


@query("""
    WITH r AS (SELECT 'part' AS role, l_partkey AS id, l_quantity AS q, l_returnflag FROM lineitem
               UNION ALL SELECT 'supplier', l_suppkey, l_quantity, l_returnflag FROM lineitem)
    SELECT role, l_returnflag, count(*) AS rows, min(id) AS min_id, max(id) AS max_id, CAST(sum(id) AS BIGINT) AS sum_id
    FROM r GROUP BY role, l_returnflag""")
def q10_roles_as_rows(t):
    roles = {"part": {"id": "l_partkey"}, "supplier": {"id": "l_suppkey"}}
    return (
        role_rows(t.lineitem, roles, ["l_returnflag"], role="role")
        .groupBy("role", "l_returnflag")
        .agg(
            F.count("*").alias("rows"), F.min("id").alias("min_id"), F.max("id").alias("max_id"), F.sum("id").alias("sum_id")
        )
    )


@query("SELECT p_brand, min(p_type) AS p_type FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand")
def q11_distinct_by_key(t):
    return distinct_by_key(t.part, "p_brand", "p_type")


@query("""
    SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_id, strftime(o_orderdate, '%Y-%m-%d') AS date_value,
           CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
           CAST(day(o_orderdate) AS INTEGER) AS day, dayofweek(o_orderdate) IN (0, 6) AS is_weekend, count(*) AS orders
    FROM orders GROUP BY ALL""")
def q12_date_dimension(t):
    per_day = t.orders.groupBy(F.to_date("o_orderdate").alias("date_value")).agg(F.count("*").alias("orders"))
    days = per_day.join(date_dim(t.orders, "o_orderdate"), "date_value", "left")
    return days.withColumn("date_value", text("date_value"))


@query(f"""
    WITH zones AS (
      SELECT CAST(z AS INTEGER) AS location_id, z IN (16, 19) AS is_box,
             CASE WHEN z = 19 THEN 'Penalty Box' ELSE
               'Zone ' || z || ' (' || list_value('Defensive', 'Middle', 'Attacking')[CAST(floor((z - 1) / 6) AS INTEGER) + 1]
               || ' ' || list_value('Left', 'Center', 'Right')[CAST((z - 1) % 3 AS INTEGER) + 1] || ' '
               || list_value('0-20', '20-40', '40-60', '60-80', '80-100', '100-120')[CAST(floor((z - 1) / 3) AS INTEGER) + 1] || ')'
             END AS field_zone
      FROM generate_series(1, 19) AS g(z)),
    p AS (SELECT l_quantity * 2.4::DOUBLE AS x, l_discount * 800::DOUBLE AS y FROM lineitem),
    c AS (SELECT CAST({ZONE_SQL} AS INTEGER) AS location_id, count(*) AS n FROM p GROUP BY 1)
    SELECT location_id, field_zone, is_box, coalesce(n, 0) AS rows FROM zones LEFT JOIN c USING (location_id)""")
def q13_zone_dimension(t):
    rows = t.lineitem.groupBy(pitch_zone(*xy()).alias("location_id")).agg(F.count("*").alias("rows"))
    zones = zone_dim(t.spark).drop("legacy_name")
    return zones.join(rows, "location_id", "left").fillna(0, ["rows"])


@query("""
    WITH n AS (SELECT p_name || ' ' || p_brand AS name, p_name AS two FROM part)
    SELECT string_split(name, ' ')[1] || ' ' || string_split(name, ' ')[-1] AS short_name, count(*) AS parts,
           CAST(0 AS BIGINT) AS short_of_two_words
    FROM n GROUP BY 1""")
def q35b_short_names(t):
    names = t.part.select(short_name(F.concat_ws(" ", "p_name", "p_brand")).alias("short_name"), short_name("p_name").alias("two"))
    return names.groupBy("short_name").agg(F.count("*").alias("parts"), F.count("two").alias("short_of_two_words"))


@query("""
    SELECT c_mktsegment, count(*) AS customers, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
    FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey
                                        WHERE r_name = 'ASIA') GROUP BY c_mktsegment""")
def q37_configured_rows(t):
    config = t.nation.join(t.region.where(F.col("r_name") == "ASIA"), F.col("n_regionkey") == F.col("r_regionkey"))
    configured = only_configured(t.customer, config.withColumnRenamed("n_nationkey", "c_nationkey"), ["c_nationkey"])
    return configured.groupBy("c_mktsegment").agg(F.count("*").alias("customers"), total("c_acctbal").alias("balance"))


@query("""
    SELECT event_type, count(*) AS events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value
    FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15' GROUP BY event_type""")
def q38_run_date(t):
    day = only_date(t.events, "ts", "2024-01-15")
    return day.groupBy("event_type").agg(F.count("*").alias("events"), total("value").alias("value"))


@query("""
    SELECT CASE WHEN year(l_shipdate) BETWEEN 1996 AND 1999 THEN CAST(year(l_shipdate) AS VARCHAR) ELSE 'default' END AS bucket,
           count(*) AS rows, min(CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER)) AS first_day,
           max(CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER)) AS last_day
    FROM lineitem GROUP BY 1""")
def q40_storage_ranges(t):
    days = t.lineitem.select(date_key("l_shipdate").alias("d"))
    return days.groupBy(year_bucket("d", 1996, 1999).alias("bucket")).agg(
        F.count("*").alias("rows"), F.min("d").alias("first_day"), F.max("d").alias("last_day")
    )


@query("""
    SELECT coalesce(CASE nullif(o_orderpriority, '3-MEDIUM') WHEN '1-URGENT' THEN 'high' WHEN '2-HIGH' THEN 'high'
                         WHEN '5-LOW' THEN 'low' ELSE nullif(o_orderpriority, '3-MEDIUM') END, 'none') AS priority,
           count(*) AS orders
    FROM orders GROUP BY 1""")
def q54_standard_values(t):
    known = t.orders.select(F.col("o_orderpriority").alias("synonym")).distinct()
    rank = F.substring("synonym", 1, 1)
    mapping = known.withColumn("canonical", F.when(rank.isin("1", "2"), "high").when(rank == "5", "low"))
    given = t.orders.select(F.nullif("o_orderpriority", F.lit("3-MEDIUM")).alias("priority"))
    return (
        standardise(given, "priority", mapping.where("canonical is not null"), default="none")
        .groupBy("priority")
        .agg(F.count("*").alias("orders"))
    )
