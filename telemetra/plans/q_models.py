"""Registered queries: the warehouse models, lake job, joins and marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetra.functions import columns as C
from telemetra.operators import quality as Q
from telemetra.operators import scd
from telemetra.operators import windows as W
from telemetra.plans import fixtures as fx
from telemetra.plans import lake, models
from telemetra.plans.catalog import query
from telemetra.plans.models import Warehouse
from telemetra.plans.oracle import date_key, sk, sql
from telemetra.sources.tables import read_table

# ---- lake path --------------------------------------------------------------------------------

FLAT_COLS = ("reading_id, robot_id, reading_ts, reading_date, battery_voltage_v, battery_soc_pct, battery_temp_c, "
             "motor_temp_c, motor_rpm, motor_load_pct, vibration_g, odometer_m, zone_id, floor_condition, "
             "operational_status, power_draw_watts")


@query("scan_nested_flatten", sql(f"SELECT {FLAT_COLS} FROM flat", "flat"))
def scan_nested_flatten(spark, sf):
    """Nested readings -> 16 flat typed columns."""
    return lake.flatten_readings(fx.nested_readings_landed(spark, sf))


@query("quality_flags", sql("SELECT reading_id, robot_id, is_missing_robot_id, is_missing_reading_id, is_bad_soc, "
                            "is_bad_motor_temp, is_bad_vibration, is_bad_odometer FROM flagged", "flagged"))
def quality_flags(spark, sf):
    f = lake.quality_flags(lake.flatten_readings(fx.nested_readings(spark, sf)))
    return f.select("reading_id", "robot_id", "is_missing_robot_id", "is_missing_reading_id", "is_bad_soc",
                    "is_bad_motor_temp", "is_bad_vibration", "is_bad_odometer")


@query("quality_null_out", sql("SELECT reading_id, battery_soc_pct_clean, motor_temp_c_clean, vibration_g_clean, "
                               "odometer_m_clean FROM cleaned_values", "cleaned_values"))
def quality_null_out(spark, sf):
    c = lake.null_out(lake.quality_flags(lake.flatten_readings(fx.nested_readings(spark, sf))))
    return c.select("reading_id", "battery_soc_pct_clean", "motor_temp_c_clean", "vibration_g_clean",
                    "odometer_m_clean")


_SUMMARY = sql("""
SELECT count(*) AS total_rows,
  CAST(sum(CAST(is_missing_robot_id AS INTEGER)) AS BIGINT) AS missing_robot_id_rows,
  CAST(sum(CAST(is_missing_reading_id AS INTEGER)) AS BIGINT) AS missing_reading_id_rows,
  CAST(sum(CAST(is_bad_soc AS INTEGER)) AS BIGINT) AS bad_soc_rows,
  CAST(sum(CAST(is_bad_motor_temp AS INTEGER)) AS BIGINT) AS bad_motor_temp_rows,
  CAST(sum(CAST(is_bad_vibration AS INTEGER)) AS BIGINT) AS bad_vibration_rows,
  CAST(sum(CAST(is_bad_odometer AS INTEGER)) AS BIGINT) AS bad_odometer_rows
FROM flagged""", "flagged")


@query("agg_quality_summary", _SUMMARY)
def agg_quality_summary(spark, sf):
    """One-row global count of each quality flag."""
    return lake.quality_summary(lake.quality_flags(lake.flatten_readings(fx.nested_readings(spark, sf))))


_RDQ = """
SELECT robot_id, reading_date, count(*) AS reading_count, avg(battery_voltage_v) AS avg_battery_voltage_v,
  avg(battery_soc_pct_clean) AS avg_battery_soc_pct, min(battery_soc_pct_clean) AS min_battery_soc_pct,
  avg(battery_temp_c) AS avg_battery_temp_c, avg(motor_temp_c_clean) AS avg_motor_temp_c,
  max(motor_temp_c_clean) AS max_motor_temp_c, avg(motor_rpm) AS avg_motor_rpm,
  avg(motor_load_pct) AS avg_motor_load_pct, avg(vibration_g_clean) AS avg_vibration_g,
  max(vibration_g_clean) AS max_vibration_g, max(odometer_m_clean) AS max_odometer_m,
  CAST(sum(CAST(is_bad_soc AS INTEGER)) AS BIGINT) AS bad_soc_count,
  CAST(sum(CAST(is_bad_motor_temp AS INTEGER)) AS BIGINT) AS bad_motor_temp_count,
  CAST(sum(CAST(is_bad_vibration AS INTEGER)) AS BIGINT) AS bad_vibration_count,
  CAST(sum(CAST(is_bad_odometer AS INTEGER)) AS BIGINT) AS bad_odometer_count
FROM cleaned_values WHERE robot_id IS NOT NULL AND reading_date IS NOT NULL
GROUP BY robot_id, reading_date"""


def _robot_daily_quality(spark, sf):
    return lake.robot_daily_quality(lake.null_out(lake.quality_flags(
        lake.flatten_readings(fx.nested_readings(spark, sf)))))


@query("agg_robot_daily_quality", sql(_RDQ, "cleaned_values"))
def agg_robot_daily_quality(spark, sf):
    """Robot-day aggregates over nulled-out values with four flag counts."""
    return _robot_daily_quality(spark, sf)


@query("sort_robot_day", sql(f"SELECT * FROM ({_RDQ}) ORDER BY robot_id, reading_date", "cleaned_values"))
def sort_robot_day(spark, sf):
    """The robot-day table ordered by robot, date (range-partitioned global sort)."""
    return _robot_daily_quality(spark, sf).orderBy("robot_id", "reading_date")


# ---- staging / dims ---------------------------------------------------------------------------------

@query("dim_zone", sql("SELECT * FROM dim_zone", "dim_zone"))
def dim_zone(spark, sf):
    return Warehouse(spark, sf).dim_zone


@query("dim_robot_model", sql("SELECT * FROM dim_robot_model", "dim_robot_model"))
def dim_robot_model(spark, sf):
    return Warehouse(spark, sf).dim_robot_model


@query("dim_robot_scd2", sql("SELECT * FROM dim_robot", "dim_robot"))
def dim_robot_scd2(spark, sf):
    """SCD2 robot versions: latest value per attribute, validity range, current flag, key."""
    return Warehouse(spark, sf).dim_robot


@query("win_running_max", sql("SELECT robot_sk, robot_id, zone_id, firmware_version, owner_team, valid_from "
                              "FROM dim_robot_rmax", "dim_robot_rmax"))
def win_running_max(spark, sf):
    """SCD2 with the warehouse's running-max attribute carry (lexicographic max so far)."""
    return Warehouse(spark, sf, scd_mode="running_max").dim_robot.select(
        "robot_sk", "robot_id", "zone_id", "firmware_version", "owner_team", "valid_from")


@query("win_forward_fill", sql("SELECT robot_id, valid_from, zone_id, firmware_version, owner_team "
                               "FROM dim_robot_filled", "dim_robot_filled"))
def win_forward_fill(spark, sf):
    """last_value(ignore nulls) carry of each attribute across versions."""
    return Warehouse(spark, sf).dim_robot.select("robot_id", "valid_from", "zone_id", "firmware_version",
                                                 "owner_team")


@query("win_lead_valid_to", sql("SELECT robot_id, valid_from, valid_to, is_current FROM dim_robot", "dim_robot"))
def win_lead_valid_to(spark, sf):
    """Next version start as valid_to (open end 9999-12-31) and current flag."""
    return Warehouse(spark, sf).dim_robot.select("robot_id", "valid_from", "valid_to", "is_current")


@query("union_all_versions", sql("SELECT robot_id, valid_from, _src AS source_rank, zone_id, firmware_version, "
                                 "owner_team FROM dim_robot_comb", "dim_robot_comb"))
def union_all_versions(spark, sf):
    """Start state rows + change event rows (before forward fill)."""
    w = Warehouse(spark, sf)
    base = w.stg_robots.select("robot_id", F.col("commissioned_date").cast("timestamp_ntz").alias("valid_from"),
                               F.lit(0).alias("source_rank"), F.col("home_zone_id").alias("zone_id"),
                               F.col("initial_firmware").alias("firmware_version"), "owner_team")
    ch = w.stg_changes.filter(F.col("changed_at").isNotNull()).join(w.stg_robots.select("robot_id"), "robot_id")
    ev = ch.select("robot_id", F.col("changed_at").alias("valid_from"), F.lit(1).alias("source_rank"),
                   F.when(F.col("attribute") == "ZONE", F.col("new_value")).alias("zone_id"),
                   F.when(F.col("attribute") == "FIRMWARE", F.col("new_value")).alias("firmware_version"),
                   F.when(F.col("attribute") == "TEAM", F.col("new_value")).alias("owner_team"))
    return base.unionByName(ev)


@query("join_inner_equi", sql("SELECT c.change_id, c.robot_id, r.serial_number, r.model_id, c.attribute, c.new_value "
                              "FROM stg_changes c JOIN stg_robots r ON c.robot_id = r.robot_id",
                              "stg_changes", "stg_robots"))
def join_inner_equi(spark, sf):
    """Change log joined to robots."""
    w = Warehouse(spark, sf)
    return w.stg_changes.join(w.stg_robots.select("robot_id", "serial_number", "model_id"), "robot_id").select(
        "change_id", "robot_id", "serial_number", "model_id", "attribute", "new_value")


_DATES = ("SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem "
          "UNION SELECT CAST(ts AS DATE) FROM events")


@query("dim_date", f"""
SELECT {date_key('d')} AS date_key, d AS date_day, CAST(year(d) AS INTEGER) AS year,
  CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, strftime(d, '%b') AS month_name,
  CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofweek(d) AS INTEGER) AS day_of_week, strftime(d, '%a') AS day_name,
  CAST(weekofyear(d) AS INTEGER) AS week_of_year, dayofweek(d) IN (0, 6) AS is_weekend
FROM ({_DATES})""")
def dim_date(spark, sf):
    """Calendar attributes for every date present in orders, lineitem and events (the fixed
    2000-day spine of the warehouse is ``models.dim_date``)."""
    days = (read_table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date_day"))
            .union(read_table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("date_day")))
            .union(read_table(spark, sf, "events").select(F.to_date("ts").alias("date_day")))
            .distinct())
    return models.calendar(days)


@query("surrogate_key", sql(f"SELECT change_id, {sk('robot_id', 'changed_at', 'attribute')} AS change_sk, "
                            f"{sk('old_value', 'new_value')} AS value_sk FROM stg_changes", "stg_changes"))
def surrogate_key(spark, sf):
    """md5 keys over several fields (text, timestamp, NULL placeholder)."""
    ch = Warehouse(spark, sf).stg_changes
    return ch.select("change_id", C.surrogate_key("robot_id", "changed_at", "attribute").alias("change_sk"),
                     C.surrogate_key("old_value", "new_value").alias("value_sk"))


# ---- facts ------------------------------------------------------------------------------------------

@query("fct_sensor_reading", sql("SELECT * FROM fct_sensor_reading", "fct_sensor_reading"))
def fct_sensor_reading(spark, sf):
    """Readings + point-in-time robot version key + zone key + date key + flags."""
    return Warehouse(spark, sf).fct_sensor_reading


@query("join_pit_scd2", sql("SELECT reading_id, robot_id, reading_ts, robot_sk FROM fct_sensor_reading",
                            "fct_sensor_reading"))
def join_pit_scd2(spark, sf):
    """Point-in-time left join of readings to robot versions."""
    return Warehouse(spark, sf).fct_sensor_reading.select("reading_id", "robot_id", "reading_ts", "robot_sk")


@query("join_left_equi", sql("SELECT reading_id, zone_id, zone_sk FROM fct_sensor_reading", "fct_sensor_reading"))
def join_left_equi(spark, sf):
    """Left join of readings to the (size-checked, broadcast) zone dimension."""
    return Warehouse(spark, sf).fct_sensor_reading.select("reading_id", "zone_id", "zone_sk")


@query("filter_not_null_keys", sql("SELECT reading_id, robot_id FROM (SELECT CASE WHEN CAST(reading_id AS BIGINT) % 89 = 0 THEN NULL "
                                   "ELSE reading_id END AS reading_id, CASE WHEN CAST(reading_id AS BIGINT) % 97 = 0 THEN NULL ELSE robot_id END "
                                   "AS robot_id FROM stg_readings) WHERE reading_id IS NOT NULL AND robot_id IS NOT NULL", "stg_readings"))
def filter_not_null_keys(spark, sf):
    """Readings with both ids, after some of either were taken away by key."""
    number, r = F.col("reading_id").cast("bigint"), Warehouse(spark, sf).stg_readings
    some = r.select(F.when(number % 89 != 0, F.col("reading_id")).alias("reading_id"), F.when(number % 97 != 0, F.col("robot_id")).alias("robot_id"))
    return some.filter(F.col("reading_id").isNotNull() & F.col("robot_id").isNotNull())


@query("agg_robot_daily", sql("SELECT * FROM fct_robot_daily", "fct_robot_daily"))
def agg_robot_daily(spark, sf):
    """Per robot-day counts, avg/min/max of 8 measures, status and flag counts."""
    return Warehouse(spark, sf).fct_robot_daily


@query("fct_robot_daily", sql("SELECT robot_daily_sk, robot_id, report_date, report_date_key, reading_count "
                              "FROM fct_robot_daily", "fct_robot_daily"))
def fct_robot_daily(spark, sf):
    """Periodic snapshot with its surrogate key."""
    return Warehouse(spark, sf).fct_robot_daily.select("robot_daily_sk", "robot_id", "report_date",
                                                       "report_date_key", "reading_count")


_FEAT_W = "OVER (PARTITION BY robot_id ORDER BY report_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
_FEATURES = sql(f"""
SELECT robot_id, report_date AS as_of_date, report_date_key AS as_of_date_key,
  avg(avg_motor_temp_c) {_FEAT_W} AS avg_motor_temp_7d, max(max_motor_temp_c) {_FEAT_W} AS max_motor_temp_7d,
  avg(avg_vibration_g) {_FEAT_W} AS avg_vibration_7d, max(max_vibration_g) {_FEAT_W} AS max_vibration_7d,
  avg(avg_battery_soc_pct) {_FEAT_W} AS avg_battery_soc_7d,
  CAST(sum(error_reading_count) {_FEAT_W} AS BIGINT) AS error_readings_7d,
  CAST(sum(suspicious_motor_temp_count) {_FEAT_W} AS BIGINT) AS suspicious_motor_temp_count_7d, reading_count
FROM fct_robot_daily""", "fct_robot_daily")


@query("mart_features_training", _FEATURES)
def mart_features_training(spark, sf):
    """Trailing 7-row features per robot-day over the daily snapshot."""
    return models.mart_features_training(Warehouse(spark, sf).fct_robot_daily)


@query("win_trailing_7", sql(f"""
SELECT robot_id, report_date,
  avg(avg_motor_temp_c) OVER w AS avg_motor_temp_7d, max(max_vibration_g) OVER w AS max_vibration_7d,
  CAST(sum(error_reading_count) OVER w AS BIGINT) AS error_readings_7d
FROM fct_robot_daily
WINDOW w AS (PARTITION BY robot_id ORDER BY report_date RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)""",
                             "fct_robot_daily"))
def win_trailing_7(spark, sf):
    """Calendar-day variant of the trailing window (rangeBetween over the day number)."""
    d = Warehouse(spark, sf).fct_robot_daily
    out = W.trailing(d, "robot_id", "report_date",
                     {"avg_motor_temp_7d": ("avg", "avg_motor_temp_c"), "max_vibration_7d": ("max", "max_vibration_g"),
                      "error_readings_7d": ("sum", "error_reading_count")}, rows=7, day_range="report_date")
    return out.select("robot_id", "report_date", "avg_motor_temp_7d", "max_vibration_7d", "error_readings_7d")


_OBT = sql("SELECT * FROM obt", "obt")


@query("obt_sensor_readings", _OBT)
def obt_sensor_readings(spark, sf):
    """One big table: fact + robot version + model + the version's zone."""
    w = Warehouse(spark, sf)
    return w.obt


_MAINT = sql(f"""
SELECT {sk('ticket_id')} AS maintenance_sk, ticket_id, robot_id, failure_type, severity, reported_ts, diagnosed_ts,
  parts_ordered_ts, repaired_ts, closed_ts, {date_key('reported_ts')} AS reported_date_key,
  {date_key('diagnosed_ts')} AS diagnosed_date_key, {date_key('repaired_ts')} AS repaired_date_key,
  {date_key('closed_ts')} AS closed_date_key, root_cause, cost_usd, downtime_hours,
  CAST(epoch_us(diagnosed_ts) - epoch_us(reported_ts) AS DOUBLE) / 3600e6 AS hours_to_diagnose,
  CAST(epoch_us(closed_ts) - epoch_us(reported_ts) AS DOUBLE) / 3600e6 AS hours_to_close,
  closed_ts IS NULL AS is_open
FROM tickets""", "tickets")


@query("fct_maintenance", _MAINT)
def fct_maintenance(spark, sf):
    """Accumulating snapshot of maintenance tickets (stage timestamps, date keys, durations)."""
    return models.fct_maintenance(fx.maintenance_tickets(spark, sf))


# ---- second warehouse: telemetry, health, labels ------------------------------------------------------

@query("stg_telemetry", sql("SELECT * FROM stg_telemetry", "stg_telemetry"))
def stg_telemetry(spark, sf):
    """Typed telemetry view: unix seconds -> timestamp, partition columns."""
    return Warehouse(spark, sf).stg_telemetry


@query("stg_epoch_ts", sql("SELECT robotid, timestamp, make_timestamp(timestamp * 1000000) AS event_timestamp "
                           "FROM telemetry", "telemetry"))
def stg_epoch_ts(spark, sf):
    t = fx.telemetry(spark, sf)
    return t.select("robotid", "timestamp", C.epoch_to_ts("timestamp").alias("event_timestamp"))


@query("agg_health_daily", sql("SELECT * FROM health_daily", "health_daily"))
def agg_health_daily(spark, sf):
    """avg/max/min daily health per robot on the telemetry stream table."""
    return Warehouse(spark, sf).health_daily


_TRAIN = sql("""
SELECT dh.robotid, dh.summary_date, dh.avg_motor_temp, dh.max_motor_temp, dh.avg_battery_voltage,
  dh.min_battery_voltage, dh.max_vibration,
  CASE WHEN f.failure_date IS NOT NULL THEN 1 ELSE 0 END AS will_fail_in_next_7_days
FROM health_daily dh
LEFT JOIN failures f ON dh.robotid = f.robot_id AND dh.summary_date >= f.failure_date - INTERVAL 7 DAY
  AND dh.summary_date < f.failure_date""", "health_daily", "failures")


@query("mart_training_dataset", _TRAIN)
def mart_training_dataset(spark, sf):
    """Daily health + 7-day look-ahead failure label (one row per matching failure, as the mart)."""
    return models.mart_training_dataset(Warehouse(spark, sf).health_daily, fx.failures(spark, sf), fan_out=True)


@query("join_lookahead_label", sql("""
SELECT dh.robotid, dh.summary_date,
  CASE WHEN EXISTS (SELECT 1 FROM failures f WHERE f.robot_id = dh.robotid
    AND dh.summary_date >= f.failure_date - INTERVAL 7 DAY AND dh.summary_date < f.failure_date) THEN 1 ELSE 0 END
  AS will_fail_in_next_7_days
FROM health_daily dh""", "health_daily", "failures"))
def join_lookahead_label(spark, sf):
    """De-fanned label: one row per robot-day, 1 when any failure lies in the next 7 days."""
    h = Warehouse(spark, sf).health_daily.select("robotid", "summary_date")
    f = fx.failures(spark, sf).select(F.col("robot_id").alias("robotid"), "failure_date")
    return scd.lookahead_label(h, f, "robotid", "summary_date", "failure_date", 7, fan_out=False,
                               label="will_fail_in_next_7_days")


# ---- lag / lead window operators ---------------------------------------------------------------------

@query("win_lag_sequential", """
SELECT user_id, day, lag(day) OVER w AS previous_day,
  CAST(date_diff('day', lag(day) OVER w, day) AS INTEGER) AS gap_days,
  coalesce(CAST(day AS TIMESTAMP) = CAST(lag(day) OVER w AS TIMESTAMP) + INTERVAL 1 DAY, true) AS is_sequential
FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events)
WINDOW w AS (PARTITION BY user_id ORDER BY day)""")
def win_lag_sequential(spark, sf):
    """Previous active day per user, the gap, and whether it is the next calendar day."""
    days = read_table(spark, sf, "events").select("user_id", F.to_date("ts").alias("day")).distinct()
    prev = W.previous_value("day", "user_id", "day")
    return days.select("user_id", "day", prev.alias("previous_day"),
                       F.datediff("day", prev).alias("gap_days"),
                       F.coalesce(F.col("day").cast("timestamp_ntz") ==
                                  F.timestamp_add("DAY", F.lit(1), prev.cast("timestamp_ntz")),
                                  F.lit(True)).alias("is_sequential"))


@query("win_lead_ranges", sql("""
SELECT robot_id, valid_from, valid_to,
  lead(valid_from) OVER (PARTITION BY robot_id ORDER BY valid_from, valid_to) AS next_valid_from,
  row_number() OVER (PARTITION BY robot_id ORDER BY valid_from DESC, valid_to DESC) = 1 AS is_last_record
FROM dim_robot""", "dim_robot"))
def win_lead_ranges(spark, sf):
    """Next range start and a last-record marker per robot (lead + row_number; per-day chunks
    when some robot's versions exceed the per-task bound)."""
    d = Warehouse(spark, sf).dim_robot.select("robot_id", "valid_from", "valid_to")
    chunk = F.date_trunc("day", "valid_from")
    r = Q.ranges_with_next(d, "valid_from", "valid_to", "robot_id", chunk)
    return r.select(F.col("partition_by_col").alias("robot_id"), F.col("lower_bound").alias("valid_from"),
                    F.col("upper_bound").alias("valid_to"), F.col("next_lower_bound").alias("next_valid_from"),
                    "is_last_record")
