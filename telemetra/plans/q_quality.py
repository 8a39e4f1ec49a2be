"""Registered queries: data-quality assertions. Each returns the violating rows for a predicate
chosen to really fail on the fixtures; ``dq_report`` summarises all of them in one table."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetra.operators import quality as Q
from telemetra.operators import scd
from telemetra.plans import fixtures as fx
from telemetra.plans import staging as stg
from telemetra.plans.catalog import query
from telemetra.plans.models import Warehouse
from telemetra.plans.oracle import sql
from telemetra.sources.tables import read_table

NOW = "2024-01-30 00:00:00"
FUTURE_CUTOFF = "2024-01-20 00:00:00"

# name -> (spark builder, oracle body, oracle CTE names, failure measure column or None)
DQ: dict[str, tuple] = {}


def dq(name: str, body: str, *ctes: str, measure: str | None = None):
    def deco(fn):
        DQ[name] = (fn, body, ctes, measure)
        query(name, sql(body, *ctes))(fn)
        return fn
    return deco


def _ev(spark, sf):
    return read_table(spark, sf, "events")


@dq("dq_not_null", "SELECT event_id, nullif(event_type, 'error') AS event_kind FROM events "
                   "WHERE nullif(event_type, 'error') IS NULL")
def dq_not_null(spark, sf):
    e = _ev(spark, sf).select("event_id", F.nullif(F.col("event_type"), F.lit("error")).alias("event_kind"))
    return Q.not_null(e, "event_kind")


@dq("dq_unique", "SELECT o_custkey AS unique_field, count(*) AS n_records FROM orders WHERE o_custkey IS NOT NULL "
                 "GROUP BY 1 HAVING count(*) > 1")
def dq_unique(spark, sf):
    return Q.unique(read_table(spark, sf, "orders"), "o_custkey")


@dq("dq_unique_combination", "SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem "
                             "GROUP BY 1, 2 HAVING count(*) > 1")
def dq_unique_combination(spark, sf):
    return Q.unique_combination(read_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


_KINDS = ["click", "view", "purchase"]


@dq("dq_accepted_values", "SELECT event_type AS value_field, count(*) AS n_records FROM events GROUP BY 1 "
                          "HAVING event_type NOT IN ('click', 'view', 'purchase')")
def dq_accepted_values(spark, sf):
    return Q.accepted_values(_ev(spark, sf), "event_type", _KINDS)


@dq("dq_not_accepted_values", "SELECT DISTINCT event_type AS value_field FROM events "
                              "WHERE event_type IN ('error', 'signup')")
def dq_not_accepted_values(spark, sf):
    return Q.not_accepted_values(_ev(spark, sf), "event_type", ["error", "signup"])


@dq("dq_accepted_range", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem "
                         "WHERE NOT (l_quantity >= 1) OR NOT (l_quantity <= 40)")
def dq_accepted_range(spark, sf):
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return Q.accepted_range(li, "l_quantity", 1, 40)


@dq("dq_relationships", "SELECT l.l_orderkey AS from_field FROM lineitem l WHERE l.l_orderkey IS NOT NULL AND NOT EXISTS "
                        "(SELECT 1 FROM orders o WHERE o.o_orderstatus = 'F' AND o.o_orderkey = l.l_orderkey)")
def dq_relationships(spark, sf):
    """Lines whose order is not among the finished orders."""
    fin = read_table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")
    return Q.relationships(read_table(spark, sf, "lineitem"), "l_orderkey", fin, "o_orderkey")


@dq("dq_relationships_where", "SELECT e.user_id AS from_field FROM events e WHERE e.event_type = 'error' AND "
                              "e.user_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey > 50 "
                              "AND c.c_custkey = e.user_id)")
def dq_relationships_where(spark, sf):
    return Q.relationships(_ev(spark, sf), "user_id", read_table(spark, sf, "customer"), "c_custkey",
                           from_condition=F.col("event_type") == "error", to_condition=F.col("c_custkey") > 50)


@dq("dq_at_least_one", "SELECT user_id, count(CASE WHEN event_type = 'purchase' AND value > 100 THEN value END) "
                       "AS filler_column FROM events GROUP BY user_id HAVING filler_column = 0")
def dq_at_least_one(spark, sf):
    c = F.when((F.col("event_type") == "purchase") & (F.col("value") > 100), F.col("value"))
    return Q.at_least_one(_ev(spark, sf), c, ["user_id"])


@dq("dq_not_constant", "SELECT event_type, count(DISTINCT 1) AS filler_column FROM events GROUP BY 1 "
                       "HAVING count(DISTINCT 1) = 1")
def dq_not_constant(spark, sf):
    return Q.not_constant(_ev(spark, sf), F.lit(1), ["event_type"])


_CARD = """
(SELECT l_orderkey AS value_field, count(*) AS n_records FROM lineitem GROUP BY 1
 EXCEPT SELECT o_orderkey, count(*) FROM orders GROUP BY 1)
UNION ALL
(SELECT o_orderkey AS value_field, count(*) AS n_records FROM orders GROUP BY 1
 EXCEPT SELECT l_orderkey, count(*) FROM lineitem GROUP BY 1)"""


@dq("dq_cardinality_equality", f"SELECT * FROM ({_CARD})")
def dq_cardinality_equality(spark, sf):
    return Q.cardinality_equality(read_table(spark, sf, "lineitem"), "l_orderkey",
                                  read_table(spark, sf, "orders"), "o_orderkey")


_RC = """
SELECT a.event_type AS event_type_a, b.event_type AS event_type_b, {ca}, {cb}{extra}
FROM (SELECT event_type, count(*) AS {na} FROM events GROUP BY 1) a
FULL JOIN (SELECT event_type, count(*) AS {nb} FROM events WHERE value > 10 GROUP BY 1) b
ON a.event_type = b.event_type"""


@dq("dq_equal_rowcount", _RC.format(ca="count_a", cb="count_b", na="count_a", nb="count_b",
                                    extra=", abs(count_a - count_b) AS diff_count"), measure="diff_count")
def dq_equal_rowcount(spark, sf):
    e = _ev(spark, sf)
    return Q.equal_rowcount(e, e.filter(F.col("value") > 10), ["event_type"])


@dq("dq_fewer_rows_than", _RC.format(
    ca="count_our_model", cb="count_comparison_model", na="count_our_model", nb="count_comparison_model",
    extra=", CASE WHEN count_our_model > count_comparison_model THEN count_our_model - count_comparison_model "
          "WHEN count_our_model = count_comparison_model THEN 1 ELSE 0 END AS row_count_delta"),
    measure="row_count_delta")
def dq_fewer_rows_than(spark, sf):
    e = _ev(spark, sf)
    return Q.fewer_rows_than(e, e.filter(F.col("value") > 10), ["event_type"])


_TRUNC = "SELECT c_custkey, c_name, c_nationkey, trunc(c_acctbal) AS c_acctbal, c_mktsegment FROM customer"


def _eq_sql(a: str, b: str) -> str:
    return (f"SELECT *, 'a_minus_b' AS which_diff FROM ({a} EXCEPT {b}) UNION ALL "
            f"SELECT *, 'b_minus_a' FROM ({b} EXCEPT {a})")


@dq("dq_equality", _eq_sql("SELECT * FROM customer", _TRUNC), measure=Q.EQUALITY_MEASURE)
def dq_equality(spark, sf):
    a = read_table(spark, sf, "customer")
    return Q.equality(a, a.withColumn("c_acctbal", F.col("c_acctbal").cast("bigint").cast("double")))


_R0 = "SELECT c_custkey, c_name, c_nationkey, round(c_acctbal, 0) AS c_acctbal, c_mktsegment FROM ({})"


@dq("dq_equality_precision", _eq_sql(_R0.format("SELECT * FROM customer"), _R0.format(_TRUNC)), measure=Q.EQUALITY_MEASURE)
def dq_equality_precision(spark, sf):
    """Equality after rounding numeric columns to 0 decimals on both sides."""
    a = read_table(spark, sf, "customer")
    b = a.withColumn("c_acctbal", F.col("c_acctbal").cast("bigint").cast("double"))
    return Q.equality(a, b, precision=0)


@dq("dq_expression_is_true", "SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM lineitem "
                             "WHERE NOT (l_discount < l_tax)")
def dq_expression_is_true(spark, sf):
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    return Q.expression_is_true(li, "l_discount < l_tax")


_SHIFTED = ("SELECT robot_id, valid_from, CASE WHEN is_current THEN valid_to ELSE valid_to + INTERVAL 1 DAY END "
            "AS valid_to FROM dim_robot")


@dq("dq_mutually_exclusive_ranges", f"""
SELECT * FROM (
  SELECT robot_id AS partition_by_col, valid_from AS lower_bound, valid_to AS upper_bound,
    lead(valid_from) OVER (PARTITION BY robot_id ORDER BY valid_from, valid_to) AS next_lower_bound,
    row_number() OVER (PARTITION BY robot_id ORDER BY valid_from DESC, valid_to DESC) = 1 AS is_last_record
  FROM ({_SHIFTED}))
WHERE NOT (coalesce(lower_bound < upper_bound, false)
           AND coalesce(upper_bound <= next_lower_bound, is_last_record, false))""", "dim_robot")
def dq_mutually_exclusive_ranges(spark, sf):
    d = Warehouse(spark, sf).dim_robot
    shifted = d.select("robot_id", "valid_from", F.when(F.col("is_current"), F.col("valid_to"))
                       .otherwise(F.timestamp_add("DAY", F.lit(1), F.col("valid_to"))).alias("valid_to"))
    chunk = F.date_trunc("day", "valid_from")
    return Q.mutually_exclusive_ranges(shifted, "valid_from", "valid_to", partition_by="robot_id", chunk=chunk)


@dq("dq_not_empty_string", "SELECT event_id, CASE WHEN event_id % 7 = 0 THEN '  ' ELSE event_type END AS kind "
                           "FROM events WHERE trim(CASE WHEN event_id % 7 = 0 THEN '  ' ELSE event_type END) = ''")
def dq_not_empty_string(spark, sf):
    e = _ev(spark, sf).select("event_id", F.when(F.col("event_id") % 7 == 0, F.lit("  "))
                              .otherwise(F.col("event_type")).alias("kind"))
    return Q.not_empty_string(e, "kind")


@dq("dq_not_null_proportion", "SELECT * FROM (SELECT event_type, CAST(sum(CASE WHEN value > 20 THEN 1 ELSE 0 END) "
                              "AS DOUBLE) / count(*) AS not_null_proportion FROM events GROUP BY 1) "
                              "WHERE not_null_proportion < 0.68 OR not_null_proportion > 1.0")
def dq_not_null_proportion(spark, sf):
    c = F.when(F.col("value") > 20, F.col("value"))
    return Q.not_null_proportion(_ev(spark, sf), c, at_least=0.68, group_by=["event_type"])


@dq("dq_recency", f"""
SELECT * FROM (SELECT user_id, max(ts) AS most_recent, TIMESTAMP '{NOW}' - INTERVAL 1 DAY AS threshold
               FROM events GROUP BY 1)
WHERE most_recent < threshold""")
def dq_recency(spark, sf):
    return Q.recency(_ev(spark, sf), "ts", "day", 1, NOW, group_by=["user_id"])


@dq("dq_sequential_values", """
SELECT * FROM (SELECT user_id, day, lag(day) OVER (PARTITION BY user_id ORDER BY day) AS previous_day
               FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events))
WHERE NOT (CAST(day AS TIMESTAMP) = CAST(previous_day AS TIMESTAMP) + INTERVAL 1 DAY)""")
def dq_sequential_values(spark, sf):
    days = _ev(spark, sf).select("user_id", F.to_date("ts").alias("day")).distinct()
    return Q.sequential_values(days, "day", 1, "day", group_by=["user_id"])


@query("dq_sequential_values_global", """
SELECT * FROM (SELECT o_custkey, lag(o_custkey) OVER (ORDER BY o_custkey) AS previous_o_custkey
               FROM (SELECT DISTINCT o_custkey FROM orders))
WHERE NOT (o_custkey = previous_o_custkey + 1)""")
def dq_sequential_values_global(spark, sf):
    """Gaps in the customer numbers that ordered: one sequence over the whole table, in value ranges."""
    return Q.sequential_values(read_table(spark, sf, "orders").select("o_custkey").distinct(), "o_custkey")


@dq("dq_no_future_ts", f"SELECT reading_id, reading_ts FROM fct_sensor_reading "
                       f"WHERE reading_ts > TIMESTAMP '{FUTURE_CUTOFF}'", "fct_sensor_reading")
def dq_no_future_ts(spark, sf):
    """Readings after a given 'now' (a parameter, not the wall clock)."""
    f = Warehouse(spark, sf).fct_sensor_reading.select("reading_id", "reading_ts")
    return Q.no_future_timestamps(f, "reading_ts", FUTURE_CUTOFF)


_DIRTY = ("SELECT nullif(trim(CASE WHEN CAST(reading_id AS BIGINT) % 89 = 0 THEN ' null ' ELSE reading_id END), '') "
          "AS reading_id, nullif(trim(CASE WHEN CAST(reading_id AS BIGINT) % 97 = 0 THEN 'N/A' ELSE robot_id END), '') "
          "AS robot_id FROM readings")


@dq("dq_cleaning_complete", f"SELECT * FROM ({_DIRTY}) WHERE upper(trim(robot_id)) IN "
                            "('NULL', 'N/A', 'NA', 'NAN', 'NONE', '-', '#N/A') OR upper(trim(reading_id)) IN "
                            "('NULL', 'N/A', 'NA', 'NAN', 'NONE', '-', '#N/A')", "readings")
def dq_cleaning_complete(spark, sf):
    """Ids that still hold a null word after staging (dirt written in-query)."""
    return Q.cleaning_incomplete(_dirty_ids(spark, sf), ["robot_id", "reading_id"])


def _dirty_ids(spark, sf):
    r = fx.readings(spark, sf)
    rid = F.col("reading_id").cast("bigint")
    dirty = r.withColumns({
        "reading_id": F.when(rid % 89 == 0, F.lit(" null ")).otherwise(F.col("reading_id")),
        "robot_id": F.when(rid % 97 == 0, F.lit("N/A")).otherwise(F.col("robot_id"))})
    return stg.stg_sensor_readings(dirty).select("reading_id", "robot_id")


_TASK_FLAGS = ["is_missing_task_id", "is_missing_robot_id", "is_invalid_task_type", "is_invalid_status",
               "is_task_lifecycle_invalid"]


@dq("dq_flags_not_null", "SELECT task_id FROM stg_tasks WHERE " + " OR ".join(f"{f} IS NULL" for f in _TASK_FLAGS),
    "stg_tasks")
def dq_flags_not_null(spark, sf):
    return Q.flags_not_null(Warehouse(spark, sf).stg_tasks, _TASK_FLAGS).select("task_id")


@dq("dq_scd2_no_overlap", """
SELECT a.robot_id, a.valid_from AS a_valid_from, a.valid_to AS a_valid_to, b.valid_from AS b_valid_from,
  b.valid_to AS b_valid_to
FROM dim_robot a JOIN dim_robot b ON a.robot_id = b.robot_id AND a.valid_from < b.valid_to
  AND b.valid_from < a.valid_to AND a.valid_from <> b.valid_from""", "dim_robot")
def dq_scd2_no_overlap(spark, sf):
    return scd.overlapping_versions(Warehouse(spark, sf).dim_robot, "robot_id")


@dq("dq_obt_reconciles", "SELECT * FROM (SELECT count(*) AS fact_row_count FROM fct_sensor_reading) "
                         "CROSS JOIN (SELECT count(*) AS obt_row_count FROM obt) "
                         "WHERE fact_row_count <> obt_row_count", "fct_sensor_reading", "obt")
def dq_obt_reconciles(spark, sf):
    """Fact and one-big-table row counts differ (duplicate version keys fan the OBT out)."""
    w = Warehouse(spark, sf)
    obt = w.obt
    return Q.rowcounts_differ(w.fct_sensor_reading, obt)


@dq("dq_positive_measure", "SELECT event_timestamp, motortemp FROM stg_telemetry WHERE motortemp < 0", "stg_telemetry")
def dq_positive_measure(spark, sf):
    return Q.negative_values(Warehouse(spark, sf).stg_telemetry, "motortemp", keep=["event_timestamp"])


@dq("dq_task_order", "SELECT task_id FROM stg_tasks WHERE list_filter([assigned_ts, started_ts, completed_ts], "
                     "lambda x: x IS NOT NULL) <> list_sort(list_filter([assigned_ts, started_ts, completed_ts], "
                     "lambda x: x IS NOT NULL))", "stg_tasks")
def dq_task_order(spark, sf):
    t = Warehouse(spark, sf).stg_tasks
    return Q.timestamps_out_of_order(t, ["assigned_ts", "started_ts", "completed_ts"]).select("task_id")


_LC = ["reported_ts", "diagnosed_ts", "repaired_ts", "closed_ts"]
_LC_ARR = "[" + ", ".join(_LC) + "]"


@dq("dq_lifecycle_trailing_nulls", f"""
SELECT ticket_id FROM tickets WHERE
  reported_ts IS NULL
  OR (diagnosed_ts IS NULL AND (repaired_ts IS NOT NULL OR closed_ts IS NOT NULL))
  OR (repaired_ts IS NULL AND closed_ts IS NOT NULL)
  OR list_filter({_LC_ARR}, lambda x: x IS NOT NULL) <> list_sort(list_filter({_LC_ARR}, lambda x: x IS NOT NULL))""",
    "tickets")
def dq_lifecycle_trailing_nulls(spark, sf):
    return Q.lifecycle_violations(fx.maintenance_tickets(spark, sf), _LC).select("ticket_id")


@dq("dq_noop_changes", "SELECT change_id, old_value, new_value FROM stg_changes WHERE old_value IS NOT DISTINCT FROM new_value",
    "stg_changes")
def dq_noop_changes(spark, sf):
    ch = Warehouse(spark, sf).stg_changes.select("change_id", "old_value", "new_value")
    return Q.values_equal(ch, "old_value", "new_value")


@dq("dq_status_domain", "SELECT reading_id, operational_status FROM readings WHERE coalesce(operational_status "
                        "NOT IN ('ACTIVE', 'IDLE', 'CHARGING', 'MAINTENANCE'), true)", "readings")
def dq_status_domain(spark, sf):
    r = fx.readings(spark, sf).select("reading_id", "operational_status")
    return Q.outside_domain(r, "operational_status", ["ACTIVE", "IDLE", "CHARGING", "MAINTENANCE"])


@dq("dq_assert_equal_columns", "SELECT event_id, round(value, 0) AS actual, floor(value) AS expected FROM events "
                               "WHERE round(value, 0) <> floor(value)")
def dq_assert_equal_columns(spark, sf):
    e = _ev(spark, sf).select("event_id", F.round("value", 0).alias("actual"),
                              F.floor("value").cast("double").alias("expected"))
    return Q.unequal(e, "actual", "expected")


# ---- gates --------------------------------------------------------------------------------------

# Ranges of the delivery gate (fixed values): label -> (leaf, low, high, high excluded).
RANGES = {
    "battery.soc_pct in [0,100]": ("battery.soc_pct", 0.0, 100.0, False),
    "motor.load_pct in [0,100]": ("motor.load_pct", 0.0, 100.0, False),
    "motor.rpm >= 0": ("motor.rpm", 0.0, None, False),
    "battery.charge_cycles >= 0": ("battery.charge_cycles", 0.0, None, False),
    "battery.health_pct in [0,100]": ("battery.health_pct", 0.0, 100.0, False),
    "navigation.heading_deg in [0,360)": ("navigation.heading_deg", 0.0, 360.0, True),
    "environment.humidity_pct in [0,100]": ("environment.humidity_pct", 0.0, 100.0, False),
    "navigation.speed_mps >= 0": ("navigation.speed_mps", 0.0, None, False),
    "wheels.odometer_m >= 0": ("wheels.odometer_m", 0.0, None, False),
    "power_draw_watts >= 0": ("power_draw_watts", 0.0, None, False),
}
_K = "CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE)"
# How often each rule of the contract is broken, from the channels' definitions over events.
_BAD = {
    "battery.soc_pct in [0,100]": "value > 105 OR value < 5",
    "motor.load_pct in [0,100]": "value < 0 OR value > 500",
    "motor.rpm >= 0": f"{_K} < 0",
    "battery.charge_cycles >= 0": f"{_K} * 3 < 2",
    "battery.health_pct in [0,100]": f"{_K} < 4 OR {_K} > 404",
    "navigation.heading_deg in [0,360)": f"{_K} < 0 OR {_K} >= 90",
    "environment.humidity_pct in [0,100]": "value - 1.0::DOUBLE < 0 OR value - 1.0::DOUBLE > 100",
    "navigation.speed_mps >= 0": "value / 40.0::DOUBLE - 0.25::DOUBLE < 0",
    "wheels.odometer_m >= 0": "event_id % 53 = 0 AND value > 0",
    "power_draw_watts >= 0": "value * 3.0::DOUBLE + 50.0::DOUBLE < 0",
    "error_codes is an array": "false",
}
_RANGE_SQL = ("SELECT \"check\", CASE WHEN bad_rows = 0 THEN 'PASS' ELSE 'FAIL' END AS status, bad_rows FROM ("
              + " UNION ALL ".join(f"SELECT '{label}' AS \"check\", CAST(count_if({bad}) AS BIGINT) AS bad_rows FROM events"
                                   for label, bad in _BAD.items()) + ")")


@query("dq_range_gate", _RANGE_SQL)
def dq_range_gate(spark, sf):
    """The gate's ten ranges, and that error codes are always an array, in one pass over the readings."""
    return Q.range_gate(fx.nested_readings(spark, sf), RANGES, arrays={"error_codes is an array": "error_codes"})


_PK = {"robots": ("stg_robots", "robot_id"), "zones": ("stg_zones", "zone_id"), "robot_models": ("stg_models", "model_id"),
       "robot_attribute_changes": ("stg_changes", "change_id"), "sensor_readings": ("readings", "reading_id"),
       "tasks": ("tasks", "task_id"), "maintenance_tickets": ("tickets", "ticket_id")}
_FK = {("robots", "model_id"): ("robot_models", "model_id"), ("robots", "home_zone_id"): ("zones", "zone_id"),
       ("robot_attribute_changes", "robot_id"): ("robots", "robot_id"),
       ("sensor_readings", "robot_id"): ("robots", "robot_id"), ("tasks", "robot_id"): ("robots", "robot_id"),
       ("maintenance_tickets", "robot_id"): ("robots", "robot_id")}


def _pkfk_sql() -> str:
    parts = []
    for name, (v, pk) in _PK.items():
        parts.append(f"SELECT '{name}.{pk} not null (PK)' AS \"check\", count(*) - count({pk}) AS bad_rows FROM {v}")
        parts.append(f"SELECT '{name}.{pk} unique (PK)', count({pk}) - count(DISTINCT {pk}) FROM {v}")
    for (child, col), (parent, pcol) in _FK.items():
        cv, pv = _PK[child][0], _PK[parent][0]
        parts.append(f"SELECT '{child}.{col} -> {parent}.{pcol} (FK)', count(*) FROM {cv} c WHERE NOT EXISTS "
                     f"(SELECT 1 FROM {pv} p WHERE p.{pcol} = c.{col})")
    return ("SELECT \"check\", CASE WHEN bad_rows = 0 THEN 'PASS' ELSE 'FAIL' END AS status, "
            "CAST(bad_rows AS BIGINT) AS bad_rows FROM (" + " UNION ALL ".join(parts) + ")")


@query("dq_pk_fk_gate", sql(_pkfk_sql(), "stg_robots", "stg_zones", "stg_models", "stg_changes", "readings",
                            "tasks", "tickets"))
def dq_pk_fk_gate(spark, sf):
    """Primary keys not null + unique and foreign keys resolvable, as one report."""
    w = Warehouse(spark, sf)
    frames = {"robots": w.stg_robots, "zones": w.stg_zones, "robot_models": w.stg_models,
              "robot_attribute_changes": w.stg_changes, "sensor_readings": fx.readings(spark, sf),
              "tasks": fx.tasks(spark, sf), "maintenance_tickets": fx.maintenance_tickets(spark, sf)}
    return Q.pk_fk_gate({n: (frames[n], pk) for n, (_, pk) in _PK.items()}, _FK)


# ---- report -------------------------------------------------------------------------------------

def _report_sql() -> str:
    ctes: list[str] = []
    parts = []
    for name, (_, body, names, measure) in DQ.items():
        ctes += [n for n in names if n not in ctes]
        m = "count(*)" if measure is None else measure if isinstance(measure, Q.Total) else f"coalesce(sum(coalesce({measure}, 0)), 0)"
        parts.append(f"SELECT '{name}' AS test, CAST({m} AS BIGINT) AS failures FROM ({body})")
    body = ("SELECT test, failures, CASE WHEN failures <> 0 THEN 'ERROR' ELSE 'PASS' END AS status FROM ("
            + "\nUNION ALL\n".join(parts) + ")")
    return sql(body, *ctes)


def _compiled(spark, sf) -> dict[str, Q.Rows | Q.Groups]:
    """The assertions that need no plan of their own: rules for rows and for groups, to be counted together."""
    w, col, one = Warehouse(spark, sf), F.col, F.count(F.lit(1))
    events, lines, orders = _ev(spark, sf), read_table(spark, sf, "lineitem"), read_table(spark, sf, "orders")
    tasks, value, kind = w.stg_tasks, col("value"), ("event_type",)
    over = {"ours": one, "theirs": F.count_if(value > 10)}
    both = lambda c: (c["theirs"] > 0) & c["event_type"].isNotNull()
    dear = F.when((col("event_type") == "purchase") & (value > 100), value)
    return {
        "dq_not_null": Q.Rows(events, F.nullif(col("event_type"), F.lit("error")).isNull()),
        "dq_not_empty_string": Q.Rows(events, F.trim(F.when(col("event_id") % 7 == 0, F.lit("  ")).otherwise(col("event_type"))) == ""),
        "dq_assert_equal_columns": Q.Rows(events, F.round("value", 0) != F.floor("value").cast("double")),
        "dq_accepted_range": Q.Rows(lines, Q.out_of_range("l_quantity", 1, 40)),
        "dq_expression_is_true": Q.Rows(lines, ~(col("l_discount") < col("l_tax"))),
        "dq_no_future_ts": Q.Rows(w.fct_sensor_reading, col("reading_ts") > F.lit(FUTURE_CUTOFF).cast("timestamp_ntz")),
        "dq_cleaning_complete": Q.Rows(_dirty_ids(spark, sf), Q.holds_null_word(["robot_id", "reading_id"])),
        "dq_status_domain": Q.Rows(fx.readings(spark, sf), Q.is_outside("operational_status", ["ACTIVE", "IDLE", "CHARGING", "MAINTENANCE"])),
        "dq_flags_not_null": Q.Rows(tasks, Q.any_null(_TASK_FLAGS)),
        "dq_task_order": Q.Rows(tasks, Q.out_of_order(["assigned_ts", "started_ts", "completed_ts"])),
        "dq_positive_measure": Q.Rows(w.stg_telemetry, col("motortemp") < 0),
        "dq_lifecycle_trailing_nulls": Q.Rows(fx.maintenance_tickets(spark, sf), Q.lifecycle_broken(_LC)),
        "dq_noop_changes": Q.Rows(w.stg_changes, col("old_value").eqNullSafe(col("new_value"))),
        "dq_unique": Q.Groups(orders, ("o_custkey",), {"n": one}, lambda c: c["o_custkey"].isNotNull() & (c["n"] > 1)),
        "dq_unique_combination": Q.Groups(lines, ("l_orderkey", "l_linenumber"), {"n": one}, lambda c: c["n"] > 1),
        "dq_accepted_values": Q.Groups(events, kind, {}, lambda c: ~c["event_type"].isin(*_KINDS)),
        "dq_not_accepted_values": Q.Groups(events, kind, {}, lambda c: c["event_type"].isin("error", "signup")),
        "dq_not_constant": Q.Groups(events, kind, {"lo": F.min(F.lit(1)), "hi": F.max(F.lit(1))}, lambda c: c["lo"] == c["hi"]),
        "dq_not_null_proportion": Q.Groups(events, kind, {"some": F.count_if(value > 20), "all": one}, lambda c: c["some"] / c["all"] < 0.68),
        "dq_equal_rowcount": Q.Groups(events, kind, over, both, lambda c: F.abs(c["ours"] - c["theirs"])),
        "dq_fewer_rows_than": Q.Groups(events, kind, over, both, lambda c: F.when(c["ours"] > c["theirs"], c["ours"] - c["theirs"]).otherwise(
            (c["ours"] == c["theirs"]).cast("int"))),
        "dq_at_least_one": Q.Groups(events, ("user_id",), {"n": F.count(dear)}, lambda c: c["n"] == 0),
        "dq_recency": Q.Groups(events, ("user_id",), {"last": F.max("ts")},
                               lambda c: c["last"] < F.timestamp_add("DAY", F.lit(-1), F.lit(NOW).cast("timestamp_ntz"))),
    }


@query("dq_report", _report_sql())
def dq_report(spark, sf):
    """One row per assertion: failure count and status (error when non-zero). The robot versions and the fact are
    built once, as tables; rules for rows and groups are counted in shared passes, the others have a plan each."""
    with Warehouse.built(spark, sf, "dim_robot", "fct_sensor_reading"):
        compiled = _compiled(spark, sf)
        return Q.report({name: compiled.get(name) or (fn(spark, sf), measure) for name, (fn, _, _, measure) in DQ.items()})
