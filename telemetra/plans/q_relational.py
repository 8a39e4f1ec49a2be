"""Registered queries: relational macros, aggregations, joins, set operations, generators."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetra.functions import columns as C
from telemetra.operators import quality as Q
from telemetra.operators import relational as R
from telemetra.operators import scd
from telemetra.plans import fixtures as fx
from telemetra.plans.catalog import query
from telemetra.plans.models import Warehouse
from telemetra.plans.oracle import sql
from telemetra.sources.tables import read_table

LI_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus"]


@query("dedup_row_number", f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, {', '.join(LI_ORDER[1:])}) AS rn FROM lineitem) WHERE rn = 1""")
def dedup_row_number(spark, sf):
    """Keep the latest-shipped line per (orderkey, linenumber); full tiebreak."""
    li = read_table(spark, sf, "lineitem")
    order = [F.col("l_shipdate").desc()] + [F.col(c).asc() for c in LI_ORDER[1:]]
    return R.deduplicate(li, ["l_orderkey", "l_linenumber"], order)


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query("pivot_counts", "SELECT user_id, " + ", ".join(
    f"CAST(sum(CASE WHEN event_type = '{v}' THEN 1 ELSE 0 END) AS BIGINT) AS n_{v}" for v in EVENT_TYPES)
    + ", max(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END) AS max_purchase_value"
    + " FROM events GROUP BY user_id")
def pivot_counts(spark, sf):
    """Events per user pivoted by type (values read from the data), plus a max-pivot."""
    e = read_table(spark, sf, "events")
    values = sorted(R.column_values_list(e, "event_type"))
    counts = R.pivot(e, ["user_id"], "event_type", values, prefix="n_")
    mx = R.pivot(e, ["user_id"], "event_type", ["purchase"], agg="max", prefix="max_", suffix="_value",
                 then_value=F.col("value"), else_value=0.0)
    return counts.join(mx, "user_id")


@query("unpivot_melt", """
SELECT c_custkey, 'c_nationkey' AS field_name, CAST(c_nationkey AS VARCHAR) AS value FROM customer
UNION ALL SELECT c_custkey, 'c_acctbal', CAST(c_acctbal AS VARCHAR) FROM customer
UNION ALL SELECT c_custkey, 'c_mktsegment', CAST(c_mktsegment AS VARCHAR) FROM customer
UNION ALL SELECT c_custkey, 'is_rich', CAST(c_acctbal > 5000 AS VARCHAR) FROM customer""")
def unpivot_melt(spark, sf):
    """Customer columns to (field_name, value) rows, one Expand over one scan."""
    c = read_table(spark, sf, "customer").withColumn("is_rich", F.col("c_acctbal") > 5000)
    return R.unpivot(c, cast_to="string", exclude=["c_custkey"], remove=["c_name"])


@query("union_relations", f"""
SELECT 'customer' AS {R.SOURCE_COLUMN}, c_custkey AS id, c_name AS name, c_nationkey AS nation_id,
  c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer
UNION ALL
SELECT 'supplier', s_suppkey, s_name, s_nationkey, CAST(NULL AS VARCHAR), s_acctbal FROM supplier""")
def union_relations(spark, sf):
    """Column-superset union of customers and suppliers with a source label."""
    c = read_table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                                 F.col("c_nationkey").alias("nation_id"),
                                                 F.col("c_mktsegment").alias("segment"))
    s = read_table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                                                 F.col("s_nationkey").alias("nation_id"),
                                                 F.col("s_acctbal").alias("balance"))
    return R.union_relations({"customer": c, "supplier": s})


_CUST_B = "SELECT c_custkey, c_name, c_nationkey, round(c_acctbal, 0) AS c_acctbal, c_mktsegment FROM customer"


@query("except_both_ways", f"""
SELECT *, 'a_minus_b' AS which_diff FROM (SELECT * FROM customer EXCEPT SELECT * FROM ({_CUST_B}))
UNION ALL
SELECT *, 'b_minus_a' FROM (SELECT * FROM ({_CUST_B}) EXCEPT SELECT * FROM customer)""")
def except_both_ways(spark, sf):
    """Symmetric difference of customer and a rounded copy, labelled by side."""
    a = read_table(spark, sf, "customer")
    b = a.withColumn("c_acctbal", F.round("c_acctbal", 0))
    return R.except_both_ways(a, b)


@query("generate_series", """
SELECT CAST(range AS BIGINT) AS generated_number, count(o_orderkey) AS orders
FROM range(1, (SELECT max(o_custkey) FROM orders) + 1) LEFT JOIN orders ON o_custkey = range GROUP BY 1""")
def generate_series(spark, sf):
    """1..(largest customer number), as a distributed range, with each number's orders (gaps filled)."""
    o = read_table(spark, sf, "orders")
    counts = o.groupBy(F.col("o_custkey").alias("generated_number")).agg(F.count("o_orderkey").alias("orders"))
    n = o.agg(F.max("o_custkey")).first()[0] or 0
    return (R.generate_series(spark, n).join(counts, "generated_number", "left")
            .select("generated_number", F.coalesce("orders", F.lit(0)).cast("bigint").alias("orders")))


@query("date_spine", """
SELECT CAST(range AS DATE) AS date_day, count(event_id) AS events FROM range(
  (SELECT CAST(min(CAST(ts AS DATE)) - 2 AS TIMESTAMP) FROM events),
  (SELECT CAST(max(CAST(ts AS DATE)) + 3 AS TIMESTAMP) FROM events), INTERVAL 1 DAY)
LEFT JOIN events ON CAST(ts AS DATE) = CAST(range AS DATE) GROUP BY 1""")
def date_spine(spark, sf):
    """Daily spine from two days before the first event day to two after the last, with each day's events
    (gaps filled with 0)."""
    day = F.to_date("ts")
    e = read_table(spark, sf, "events")
    b = e.agg(F.date_sub(F.min(day), 2).alias("lo"), F.date_add(F.max(day), 3).alias("hi")).first()
    counts = e.groupBy(day.alias("date_day")).agg(F.count("event_id").alias("events"))
    return (R.date_spine(spark, "day", b["lo"], b["hi"]).join(counts, "date_day", "left")
            .select("date_day", F.coalesce("events", F.lit(0)).cast("bigint").alias("events")))


@query("column_values_topn", """
SELECT o_orderpriority AS value, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, value LIMIT 3""")
def column_values_topn(spark, sf):
    """Top-3 order priorities by frequency (value breaks ties)."""
    return R.column_values(read_table(spark, sf, "orders"), "o_orderpriority", max_records=3)


@query("scalar_subquery", """
SELECT (SELECT avg(o_totalprice) FROM orders) AS avg_price,
  (SELECT count(*) FROM orders WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders)) AS n_above""")
def scalar_subquery(spark, sf):
    """Orders above the average price: the average is a one-row frame cross-joined in."""
    o = read_table(spark, sf, "orders")
    avg = R.single_value(o.agg(F.avg("o_totalprice").alias("a")), default=0.0).withColumnRenamed("value", "avg_price")
    return (o.select("o_totalprice").crossJoin(F.broadcast(avg))
            .groupBy("avg_price").agg(F.count_if(F.col("o_totalprice") > F.col("avg_price")).alias("n_above")))


@query("histogram_width_bucket", """
SELECT bucket, count(*) AS n FROM (
  SELECT CASE WHEN l_extendedprice < 0.0 THEN 0 WHEN l_extendedprice >= 50000.0 THEN 11
    ELSE CAST(floor(CAST(10 AS DOUBLE) * (l_extendedprice - 0.0::DOUBLE) / (50000.0::DOUBLE - 0.0::DOUBLE)) AS BIGINT) + 1
  END AS bucket FROM lineitem) GROUP BY bucket""")
def histogram_width_bucket(spark, sf):
    """Equi-width histogram of extended price (10 buckets over [0, 50000), outliers 0 / 11)."""
    li = read_table(spark, sf, "lineitem")
    return (li.select(C.width_bucket("l_extendedprice", 0.0, 50000.0, 10).alias("bucket"))
            .groupBy("bucket").agg(F.count(F.lit(1)).alias("n")))


@query("ratio_safe_math", """
SELECT user_id, day, n_error, n_purchase,
  coalesce(nullif(n_click, 0), 0) + coalesce(n_view, 0) AS engaged,
  coalesce(n, 0) - coalesce(n_error, 0) AS non_error,
  CASE WHEN n_purchase = 0 THEN NULL ELSE CAST(n_error AS DOUBLE) / n_purchase END AS error_per_purchase
FROM (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n,
  count_if(event_type = 'error') AS n_error, count_if(event_type = 'purchase') AS n_purchase,
  count_if(event_type = 'click') AS n_click, count_if(event_type = 'view') AS n_view
  FROM events GROUP BY 1, 2)""")
def ratio_safe_math(spark, sf):
    """Per user-day ratios with NULL-as-0 add/subtract and divide-by-zero -> NULL."""
    e = read_table(spark, sf, "events")
    d = e.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "error").alias("n_error"),
        F.count_if(F.col("event_type") == "purchase").alias("n_purchase"),
        F.count_if(F.col("event_type") == "click").alias("n_click"),
        F.count_if(F.col("event_type") == "view").alias("n_view"))
    return d.select("user_id", "day", "n_error", "n_purchase",
                    C.safe_add(F.nullif(F.col("n_click"), F.lit(0)), "n_view").alias("engaged"),
                    C.safe_subtract("n", "n_error").alias("non_error"),
                    C.safe_divide(F.col("n_error"), F.col("n_purchase")).alias("error_per_purchase"))


@query("select_star_except", "SELECT " + ", ".join(
    f"{c} AS li_{c}" for c in ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                               "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate"]) + " FROM lineitem")
def select_star_except(spark, sf):
    """All lineitem columns but tax and discount (case-insensitive), renamed with a prefix."""
    return R.star(read_table(spark, sf, "lineitem"), except_=["l_tax", "L_DISCOUNT"], prefix="li_")


_BLANKED = ("SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE o_orderpriority END AS priority, "
            "CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE o_orderstatus END AS status, o_totalprice FROM orders")


@query("nullcheck_table", f"SELECT o_orderkey, nullif(priority, '') AS priority, nullif(status, '') AS status, "
                          f"o_totalprice FROM ({_BLANKED})")
def nullcheck_table(spark, sf):
    """'' -> NULL in every text column of orders with blanked values."""
    o = read_table(spark, sf, "orders")
    k = F.col("o_orderkey")
    blanked = o.select("o_orderkey", F.when(k % 9 == 0, "").otherwise(F.col("o_orderpriority")).alias("priority"),
                       F.when(k % 4 == 0, "").otherwise(F.col("o_orderstatus")).alias("status"), "o_totalprice")
    return R.nullcheck_table(blanked)


@query("agg_distinct_values", "SELECT DISTINCT event_type FROM events")
def agg_distinct_values(spark, sf):
    return read_table(spark, sf, "events").select("event_type").distinct()


@query("agg_count_distinct", "SELECT event_type, count(DISTINCT user_id) AS n_users FROM events GROUP BY 1")
def agg_count_distinct(spark, sf):
    return read_table(spark, sf, "events").groupBy("event_type").agg(F.count_distinct("user_id").alias("n_users"))


@query("agg_having_dups", "SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem "
                          "GROUP BY 1, 2 HAVING count(*) > 1")
def agg_having_dups(spark, sf):
    """Duplicate (orderkey, linenumber) keys (group by ... having count > 1)."""
    return Q.unique_combination(read_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("agg_batch_observations", sql("""
SELECT * FROM
 (SELECT 100.0 * CAST(count_if(len(error_codes) > 0) AS DOUBLE) / count(*) AS pct_readings_with_error_codes,
         count(*) AS total_sensor_readings FROM readings) r,
 (SELECT count(*) AS maintenance_tickets, count(DISTINCT robot_id) AS robots_with_a_failure,
         count_if(closed_ts IS NULL) AS open_tickets_at_window_end FROM tickets) t,
 (SELECT count(*) AS total_tasks FROM tasks) k""", "readings", "tickets", "tasks"))
def agg_batch_observations(spark, sf):
    """Soft observations of a batch: error-code share, tickets, failing robots, totals."""
    r = fx.readings(spark, sf).agg(
        (F.lit(100.0) * F.count_if(F.size("error_codes") > 0).cast("double") / F.count(F.lit(1)))
        .alias("pct_readings_with_error_codes"), F.count(F.lit(1)).alias("total_sensor_readings"))
    t = fx.maintenance_tickets(spark, sf).agg(
        F.count(F.lit(1)).alias("maintenance_tickets"), F.count_distinct("robot_id").alias("robots_with_a_failure"),
        F.count_if(F.col("closed_ts").isNull()).alias("open_tickets_at_window_end"))
    k = fx.tasks(spark, sf).agg(F.count(F.lit(1)).alias("total_tasks"))
    return r.crossJoin(t).crossJoin(k)


@query("agg_error_code_counts", sql("SELECT code, count(*) AS n FROM (SELECT unnest(error_codes) AS code FROM readings) "
                                    "GROUP BY code", "readings"))
def agg_error_code_counts(spark, sf):
    """Count of each error code across readings (explode the array column)."""
    return (fx.readings(spark, sf).select(F.explode("error_codes").alias("code"))
            .groupBy("code").agg(F.count(F.lit(1)).alias("n")))


@query("limit_any_non_null", "SELECT count(*) AS n FROM (SELECT 1 FROM events WHERE value IS NOT NULL LIMIT 1)")
def limit_any_non_null(spark, sf):
    """Existence probe: stops after the first non-null value."""
    e = read_table(spark, sf, "events")
    return e.filter(F.col("value").isNotNull()).limit(1).agg(F.count(F.lit(1)).alias("n"))


@query("join_cross_scalar", sql("SELECT * FROM (SELECT count(*) AS fact_row_count FROM fct_sensor_reading) "
                                "CROSS JOIN (SELECT count(*) AS obt_row_count FROM obt)", "fct_sensor_reading", "obt"))
def join_cross_scalar(spark, sf):
    """Cross join of two one-row aggregates (fact and OBT row counts)."""
    w = Warehouse(spark, sf)
    return (w.fct_sensor_reading.agg(F.count(F.lit(1)).alias("fact_row_count"))
            .crossJoin(w.obt.agg(F.count(F.lit(1)).alias("obt_row_count"))))


_EV_B = "SELECT * FROM events WHERE event_type <> 'signup' AND value > 10"


@query("join_full_outer_counts", f"""
SELECT a.event_type AS event_type_a, b.event_type AS event_type_b, count_a, count_b, abs(count_a - count_b) AS diff_count
FROM (SELECT event_type, count(*) AS count_a FROM events GROUP BY 1) a
FULL JOIN (SELECT event_type, count(*) AS count_b FROM ({_EV_B}) GROUP BY 1) b ON a.event_type = b.event_type""")
def join_full_outer_counts(spark, sf):
    """Full outer join of per-type counts of two event sets."""
    e = read_table(spark, sf, "events")
    b = e.filter((F.col("event_type") != "signup") & (F.col("value") > 10))
    return Q.equal_rowcount(e, b, ["event_type"])


@query("join_anti_orphans", """
SELECT e.user_id AS from_field FROM events e
WHERE e.user_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey > 50 AND c.c_custkey = e.user_id)""")
def join_anti_orphans(spark, sf):
    """Events whose user has no customer row among those with key > 50 (left anti join)."""
    return Q.relationships(read_table(spark, sf, "events"), "user_id", read_table(spark, sf, "customer"),
                           "c_custkey", to_condition=F.col("c_custkey") > 50)


_SHIFTED = ("SELECT robot_id, valid_from, CASE WHEN is_current THEN valid_to ELSE valid_to + INTERVAL 1 DAY END "
            "AS valid_to FROM dim_robot")


@query("join_self_overlap", sql(f"""
SELECT a.robot_id, a.valid_from AS a_valid_from, a.valid_to AS a_valid_to, b.valid_from AS b_valid_from,
  b.valid_to AS b_valid_to
FROM ({_SHIFTED}) a JOIN ({_SHIFTED}) b ON a.robot_id = b.robot_id AND a.valid_from < b.valid_to
  AND b.valid_from < a.valid_to AND a.valid_from <> b.valid_from""", "dim_robot"))
def join_self_overlap(spark, sf):
    """Theta self-join finding overlapping versions (upper bounds pushed +1 day on purpose)."""
    d = Warehouse(spark, sf).dim_robot
    shifted = d.select("robot_id", "valid_from", F.when(F.col("is_current"), F.col("valid_to"))
                       .otherwise(F.timestamp_add("DAY", F.lit(1), F.col("valid_to"))).alias("valid_to"))
    return scd.overlapping_versions(shifted, "robot_id")
