"""DuckDB SQL mirrors of the fixture views and models (the correctness oracle).

``CTES`` holds named SQL fragments with their dependencies; ``sql(body, *names)`` emits a
``WITH`` clause holding the transitive closure of the named fragments, in dependency order.
Every query in ``plans/catalog.py`` with an exact oracle has its SQL built here.
"""

from __future__ import annotations

from telemetra.functions.columns import SURROGATE_NULL

SK_NULL = f"'{SURROGATE_NULL}'"


def sk(*cols: str) -> str:
    parts = [f"coalesce(CAST({c} AS VARCHAR), {SK_NULL})" for c in cols]
    return "md5(" + " || '-' || ".join(parts) + ")"


def date_key(c: str) -> str:
    return f"CAST(year({c}) * 10000 + month({c}) * 100 + day({c}) AS INTEGER)"


def _measures(k: str = "k", value: str = "value", eid: str = "event_id") -> dict[str, str]:
    return {
        "battery_voltage_v": f"44.0::DOUBLE + CAST({k} AS DOUBLE) / 10.0::DOUBLE",
        "battery_soc_pct": f"105.0::DOUBLE - {value}",
        "battery_temp_c": f"20.0::DOUBLE + {value} / 4.0::DOUBLE",
        "motor_temp_c": f"CAST({k} AS DOUBLE) * 1.8::DOUBLE - 25.0::DOUBLE",
        "motor_rpm": f"CAST({k} AS DOUBLE) * 30.0::DOUBLE",
        "motor_load_pct": f"{value} / 5.0::DOUBLE",
        "vibration_g": f"{value} / 20.0::DOUBLE - 0.5::DOUBLE",
        "odometer_m": f"CASE WHEN {eid} % 53 = 0 THEN -{value} ELSE CAST({eid} AS DOUBLE) * 2.5::DOUBLE END",
        "power_draw_watts": f"{value} * 3.0::DOUBLE + 50.0::DOUBLE",
    }


M = _measures()
_STATUS = ("CASE event_type WHEN 'click' THEN 'ACTIVE' WHEN 'view' THEN 'IDLE' WHEN 'purchase' THEN 'CHARGING' "
           "WHEN 'signup' THEN 'MAINTENANCE' ELSE upper(event_type) END")
_FLOOR = "CASE k % 4 WHEN 0 THEN 'DRY' WHEN 1 THEN 'WET' WHEN 2 THEN 'DUSTY' ELSE 'OILY' END"
_CODES = ("list_filter([CASE WHEN k % 10 = 0 THEN 'E_MOTOR_OVERHEAT' END, CASE WHEN k % 7 = 0 THEN 'E_LOW_BATTERY' END, "
          "CASE WHEN event_type = 'error' THEN 'E_NAV_FAULT' END], lambda x: x IS NOT NULL)")

CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, body: str, *deps: str) -> None:
    CTES[name] = (body, deps)


cte("ev", "SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
cte("readings", f"""
SELECT CAST(event_id AS VARCHAR) AS reading_id, CAST(user_id AS VARCHAR) AS robot_id, ts AS reading_ts,
  {', '.join(f'{v} AS {n}' for n, v in M.items())},
  CAST(k % 25 AS VARCHAR) AS zone_id, {_FLOOR} AS floor_condition, {_STATUS} AS operational_status,
  {_CODES} AS error_codes
FROM ev""", "ev")
cte("stg_readings", """
SELECT nullif(trim(reading_id), '') AS reading_id, nullif(trim(robot_id), '') AS robot_id,
  reading_ts, false AS is_reading_ts_parse_failed, battery_voltage_v,
  CASE WHEN battery_soc_pct >= 0 AND battery_soc_pct <= 100 THEN battery_soc_pct END AS battery_soc_pct,
  coalesce(battery_soc_pct < 0 OR battery_soc_pct > 100, false) AS is_battery_soc_invalid,
  battery_temp_c AS battery_temp_c_raw,
  coalesce(battery_temp_c > 60, false) AS is_battery_temp_suspicious,
  coalesce(motor_temp_c > 100, false) AS is_motor_temp_suspicious,
  motor_temp_c AS motor_temp_c_raw, motor_rpm, motor_load_pct, vibration_g,
  CASE WHEN odometer_m >= 0 THEN odometer_m END AS odometer_m,
  coalesce(odometer_m < 0, false) AS is_odometer_invalid,
  upper(trim(operational_status)) AS operational_status, upper(trim(floor_condition)) AS floor_condition,
  nullif(trim(zone_id), '') AS zone_id
FROM readings""", "readings")
cte("robots", """
SELECT CAST(c_custkey AS VARCHAR) AS robot_id, 'SN-' || CAST(c_custkey AS VARCHAR) AS serial_number,
  CAST(c_custkey % 50 AS VARCHAR) AS model_id, DATE '2023-12-15' + CAST(c_custkey % 30 AS INTEGER) AS commissioned_date,
  CAST(c_nationkey AS VARCHAR) AS home_zone_id, 'fw-1.' || CAST(c_custkey % 4 AS VARCHAR) AS initial_firmware,
  c_mktsegment AS owner_team
FROM customer""")
cte("stg_robots", """
SELECT nullif(trim(robot_id), '') AS robot_id, nullif(trim(serial_number), '') AS serial_number,
  nullif(trim(model_id), '') AS model_id, commissioned_date, nullif(trim(home_zone_id), '') AS home_zone_id,
  nullif(trim(initial_firmware), '') AS initial_firmware, nullif(trim(owner_team), '') AS owner_team
FROM robots""", "robots")
cte("changes", """
SELECT CAST(o_orderkey AS VARCHAR) AS change_id, CAST(o_custkey AS VARCHAR) AS robot_id,
  TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) * 17 AS BIGINT)) AS changed_at,
  CASE o_orderkey % 6 WHEN 0 THEN 'firmware' WHEN 1 THEN 'home_zone' WHEN 2 THEN 'owner_team'
    WHEN 3 THEN 'Firmware_Version' WHEN 4 THEN 'zone_id' ELSE ' team ' END AS attribute,
  CASE WHEN o_orderkey % 11 = 0 THEN nv ELSE 'unknown' END AS old_value, nv AS new_value
FROM (SELECT *, CASE o_orderkey % 3 WHEN 0 THEN 'fw-2.' || CAST(o_orderkey % 9 AS VARCHAR)
        WHEN 1 THEN CAST(o_orderkey % 25 AS VARCHAR) ELSE o_orderpriority END AS nv FROM orders) o""")
_CANON = ("CASE WHEN upper(trim(attribute)) IN ('FIRMWARE', 'INITIAL_FIRMWARE', 'FIRMWARE_VERSION') THEN 'FIRMWARE' "
          "WHEN upper(trim(attribute)) IN ('ZONE', 'HOME_ZONE_ID', 'HOME_ZONE', 'ZONE_ID') THEN 'ZONE' "
          "WHEN upper(trim(attribute)) IN ('TEAM', 'OWNER_TEAM') THEN 'TEAM' ELSE upper(trim(attribute)) END")
cte("stg_changes", f"""
SELECT nullif(trim(change_id), '') AS change_id, nullif(trim(robot_id), '') AS robot_id, changed_at,
  {_CANON} AS attribute, nullif(trim(old_value), '') AS old_value, nullif(trim(new_value), '') AS new_value,
  false AS is_changed_at_parse_failed
FROM changes""", "changes")
cte("zones_raw", """
SELECT CAST(n_nationkey AS VARCHAR) AS zone_id, n_name AS zone_name, r_name AS site,
  lower(['STORAGE', 'PICKING', 'PACKING', 'SHIPPING', 'RECEIVING', 'CHARGING', 'MAINTENANCE', 'STAGING'][n_nationkey % 8 + 1]) AS zone_type,
  CAST(CAST(n_nationkey AS DOUBLE) * 150.0::DOUBLE + 500.0::DOUBLE AS VARCHAR) AS floor_area_sqm,
  CAST(n_nationkey % 7 + 3 AS VARCHAR) AS max_robots,
  CASE n_nationkey % 5 WHEN 0 THEN 'yes' WHEN 1 THEN 'Y' WHEN 2 THEN ' false' WHEN 3 THEN '0' ELSE 'maybe' END AS has_charging
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""")
cte("stg_zones", """
SELECT nullif(trim(zone_id), '') AS zone_id, nullif(trim(zone_name), '') AS zone_name, nullif(trim(site), '') AS site,
  upper(trim(zone_type)) AS zone_type, TRY_CAST(floor_area_sqm AS DOUBLE) AS floor_area_sqm,
  CAST(round(TRY_CAST(max_robots AS DECIMAL(38, 9)), 0) AS BIGINT) AS max_robots,
  CASE WHEN lower(trim(has_charging)) IN ('true', '1', 'yes', 'y') THEN true
       WHEN lower(trim(has_charging)) IN ('false', '0', 'no', 'n') THEN false END AS has_charging
FROM zones_raw""", "zones_raw")
cte("stg_models", """
SELECT CAST(p_partkey AS VARCHAR) AS model_id, p_name AS model_name, p_brand AS manufacturer,
  CAST(p_size AS DOUBLE) * 10.0::DOUBLE AS max_payload_kg, p_retailprice AS battery_capacity_wh,
  CAST(p_size AS DOUBLE) * 4.0::DOUBLE + 100.0::DOUBLE AS weight_kg,
  CAST(p_partkey % 5 AS DOUBLE) * 0.5::DOUBLE + 1.0::DOUBLE AS max_speed_mps,
  p_retailprice / 10000.0::DOUBLE AS wear_rate, p_type AS sensor_suite
FROM part""")
cte("dim_zone", f"""
SELECT {sk('zone_id')} AS zone_sk, zone_id, zone_name, site, zone_type, floor_area_sqm, max_robots, has_charging
FROM stg_zones""", "stg_zones")
cte("dim_robot_model", f"""
SELECT {sk('model_id')} AS robot_model_sk, model_id, model_name, manufacturer, max_payload_kg, battery_capacity_wh,
  weight_kg, max_speed_mps, wear_rate, sensor_suite
FROM stg_models""", "stg_models")


def _scd_cte(name: str, mode: str) -> None:
    if mode == "latest":
        vals = {a: f"CASE WHEN c.attribute = '{a}' THEN c.new_value END" for a in ("ZONE", "FIRMWARE", "TEAM")}
    else:
        w = "OVER (PARTITION BY c.robot_id ORDER BY c.changed_at ASC NULLS LAST, c.change_id ASC NULLS LAST " \
            "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        vals = {a: f"max(CASE WHEN c.attribute = '{a}' THEN c.new_value END) {w}" for a in ("ZONE", "FIRMWARE", "TEAM")}
    order = "valid_from ASC NULLS LAST, _src ASC NULLS LAST, _cid ASC NULLS LAST"
    cte(name + "_comb", f"""
SELECT robot_id, serial_number, model_id, commissioned_date, home_zone_id AS zone_id,
  initial_firmware AS firmware_version, owner_team, CAST(commissioned_date AS TIMESTAMP) AS valid_from,
  0 AS _src, CAST(NULL AS VARCHAR) AS _cid
FROM stg_robots
UNION ALL
SELECT c.robot_id, r.serial_number, r.model_id, r.commissioned_date, {vals['ZONE']}, {vals['FIRMWARE']},
  {vals['TEAM']}, c.changed_at, 1, c.change_id
FROM stg_changes c JOIN stg_robots r ON c.robot_id = r.robot_id
WHERE c.changed_at IS NOT NULL""", "stg_robots", "stg_changes")
    cte(name + "_filled", f"""
SELECT robot_id, serial_number, model_id, commissioned_date,
  last_value(zone_id IGNORE NULLS) OVER wf AS zone_id,
  last_value(firmware_version IGNORE NULLS) OVER wf AS firmware_version,
  last_value(owner_team IGNORE NULLS) OVER wf AS owner_team,
  valid_from, lead(valid_from) OVER wo AS _next
FROM {name}_comb
WINDOW wf AS (PARTITION BY robot_id ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
       wo AS (PARTITION BY robot_id ORDER BY {order})""", name + "_comb")
    cte(name, f"""
SELECT {sk('robot_id', 'valid_from')} AS robot_sk, robot_id, serial_number, model_id, zone_id, firmware_version,
  owner_team, commissioned_date, valid_from, coalesce(_next, TIMESTAMP '9999-12-31 00:00:00') AS valid_to,
  _next IS NULL AS is_current
FROM {name}_filled""", name + "_filled")


_scd_cte("dim_robot", "latest")
_scd_cte("dim_robot_rmax", "running_max")

cte("fct_sensor_reading", f"""
SELECT {sk('r.reading_id')} AS sensor_reading_sk, r.reading_id, r.robot_id, d.robot_sk, z.zone_sk, r.reading_ts,
  {date_key('r.reading_ts')} AS reading_date_key, r.battery_voltage_v, r.battery_soc_pct,
  r.battery_temp_c_raw AS battery_temp_c, r.motor_temp_c_raw AS motor_temp_c, r.motor_rpm, r.motor_load_pct,
  r.vibration_g, r.odometer_m, r.operational_status, r.floor_condition, r.zone_id,
  r.is_reading_ts_parse_failed, r.is_battery_soc_invalid, r.is_battery_temp_suspicious,
  r.is_motor_temp_suspicious, r.is_odometer_invalid
FROM (SELECT * FROM stg_readings WHERE reading_id IS NOT NULL AND robot_id IS NOT NULL) r
LEFT JOIN dim_robot d ON r.robot_id = d.robot_id AND r.reading_ts >= d.valid_from AND r.reading_ts < d.valid_to
LEFT JOIN dim_zone z ON r.zone_id = z.zone_id""", "stg_readings", "dim_robot", "dim_zone")


def _cnt(cond: str) -> str:
    return f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


cte("fct_robot_daily_agg", f"""
SELECT robot_id, CAST(reading_ts AS DATE) AS report_date, count(*) AS reading_count,
  avg(battery_voltage_v) AS avg_battery_voltage_v, avg(battery_soc_pct) AS avg_battery_soc_pct,
  min(battery_soc_pct) AS min_battery_soc_pct, avg(battery_temp_c) AS avg_battery_temp_c,
  max(battery_temp_c) AS max_battery_temp_c, avg(motor_temp_c) AS avg_motor_temp_c,
  max(motor_temp_c) AS max_motor_temp_c, avg(motor_rpm) AS avg_motor_rpm, avg(motor_load_pct) AS avg_motor_load_pct,
  avg(vibration_g) AS avg_vibration_g, max(vibration_g) AS max_vibration_g, max(odometer_m) AS max_odometer_m,
  {_cnt("operational_status = 'ACTIVE'")} AS active_reading_count,
  {_cnt("operational_status = 'ERROR'")} AS error_reading_count,
  {_cnt("operational_status = 'MAINTENANCE'")} AS maintenance_reading_count,
  {_cnt("is_reading_ts_parse_failed")} AS timestamp_parse_failure_count,
  {_cnt("is_battery_soc_invalid")} AS invalid_soc_count,
  {_cnt("is_motor_temp_suspicious")} AS suspicious_motor_temp_count,
  {_cnt("is_odometer_invalid")} AS invalid_odometer_count
FROM fct_sensor_reading WHERE reading_ts IS NOT NULL
GROUP BY 1, 2""", "fct_sensor_reading")
cte("fct_robot_daily", f"""
SELECT {sk('robot_id', 'report_date')} AS robot_daily_sk, robot_id, report_date, {date_key('report_date')} AS report_date_key,
  * EXCLUDE (robot_id, report_date)
FROM fct_robot_daily_agg""", "fct_robot_daily_agg")

# nested lake path (the Spark job)
cte("flat", """
SELECT reading_id, robot_id, reading_ts, CAST(reading_ts AS DATE) AS reading_date,
  battery_voltage_v, battery_soc_pct, battery_temp_c, motor_temp_c, motor_rpm, motor_load_pct, vibration_g,
  odometer_m, zone_id, floor_condition, operational_status, power_draw_watts
FROM readings""", "readings")
cte("flagged", """
SELECT *,
  robot_id IS NULL OR trim(robot_id) = '' AS is_missing_robot_id,
  reading_id IS NULL OR trim(reading_id) = '' AS is_missing_reading_id,
  battery_soc_pct < 0 OR battery_soc_pct > 100 AS is_bad_soc,
  motor_temp_c < -20 OR motor_temp_c > 150 AS is_bad_motor_temp,
  vibration_g < 0 OR vibration_g > 20 AS is_bad_vibration,
  odometer_m < 0 AS is_bad_odometer
FROM flat""", "flat")
cte("cleaned_values", """
SELECT *,
  CASE WHEN is_bad_soc THEN NULL ELSE battery_soc_pct END AS battery_soc_pct_clean,
  CASE WHEN is_bad_motor_temp THEN NULL ELSE motor_temp_c END AS motor_temp_c_clean,
  CASE WHEN is_bad_vibration THEN NULL ELSE vibration_g END AS vibration_g_clean,
  CASE WHEN is_bad_odometer THEN NULL ELSE odometer_m END AS odometer_m_clean
FROM flagged""", "flagged")

cte("telemetry", f"""
SELECT CAST(user_id AS VARCHAR) AS robotid, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS timestamp,
  {M['motor_temp_c']} AS motortemp, {M['battery_voltage_v']} AS batteryvoltage, {M['vibration_g']} AS vibration,
  CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
  CAST(hour(ts) AS INTEGER) AS hour
FROM ev""", "ev")
cte("stg_telemetry", """
SELECT robotid, make_timestamp(timestamp * 1000000) AS event_timestamp, motortemp, batteryvoltage, vibration,
  year, month, day, hour
FROM telemetry""", "telemetry")
cte("health_daily", """
SELECT robotid, CAST(event_timestamp AS DATE) AS summary_date, count(*) AS event_count,
  avg(motortemp) AS avg_motor_temp, max(motortemp) AS max_motor_temp, avg(batteryvoltage) AS avg_battery_voltage,
  min(batteryvoltage) AS min_battery_voltage, max(vibration) AS max_vibration
FROM stg_telemetry GROUP BY 1, 2""", "stg_telemetry")
cte("failures", """
SELECT DISTINCT CAST(user_id AS VARCHAR) AS robot_id, CAST(ts AS DATE) AS failure_date
FROM events WHERE event_type = 'error' AND value > 100.0""")

cte("lifecycle", """
SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship, sum(l_quantity) AS qty,
  CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS n_returned
FROM lineitem GROUP BY l_orderkey""")
cte("tasks", """
SELECT CAST(o_orderkey AS VARCHAR) AS task_id, CAST(o_custkey AS VARCHAR) AS robot_id,
  ['PICK', 'PUT', 'MOVE', 'INSPECT', 'CHARGE', 'IDLE', 'dance'][o_orderkey % 7 + 1] AS task_type,
  CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN ' in_progress' ELSE 'paused' END AS status,
  substr(o_orderpriority, 1, 1) AS priority, o_orderdate AS assigned_ts, first_ship AS started_ts,
  CASE WHEN o_orderstatus <> 'O' THEN last_ship END AS completed_ts, qty * 3.0::DOUBLE AS distance_m,
  qty AS payload_kg, CAST(o_custkey % 25 AS VARCHAR) AS source_zone_id,
  CAST(o_orderkey % 25 AS VARCHAR) AS destination_zone_id, n_returned AS error_count
FROM orders LEFT JOIN lifecycle ON o_orderkey = l_orderkey""", "lifecycle")
cte("stg_tasks", """
SELECT nullif(trim(task_id), '') AS task_id, nullif(trim(robot_id), '') AS robot_id,
  upper(trim(task_type)) AS task_type, upper(trim(status)) AS status,
  CAST(round(TRY_CAST(priority AS DECIMAL(38, 9)), 0) AS BIGINT) AS priority,
  assigned_ts, started_ts, completed_ts, distance_m, payload_kg,
  nullif(trim(source_zone_id), '') AS source_zone_id, nullif(trim(destination_zone_id), '') AS destination_zone_id,
  CAST(error_count AS BIGINT) AS error_count,
  task_id IS NULL OR trim(task_id) = '' AS is_missing_task_id,
  robot_id IS NULL OR trim(robot_id) = '' AS is_missing_robot_id,
  coalesce(upper(trim(task_type)) NOT IN ('PICK', 'PUT', 'MOVE', 'INSPECT', 'CHARGE', 'IDLE'), false) AS is_invalid_task_type,
  coalesce(upper(trim(status)) NOT IN ('ASSIGNED', 'IN_PROGRESS', 'COMPLETED', 'FAILED', 'CANCELLED', 'TIMEOUT'), false) AS is_invalid_status,
  coalesce(assigned_ts IS NOT NULL AND started_ts IS NOT NULL AND started_ts < assigned_ts, false) AS is_task_lifecycle_invalid
FROM tasks""", "tasks")
cte("tickets", """
SELECT CAST(o_orderkey AS VARCHAR) AS ticket_id, CAST(o_custkey AS VARCHAR) AS robot_id,
  ['MOTOR', 'BATTERY', 'SENSOR', 'WHEEL', 'NAVIGATION', 'COMMS', 'SOFTWARE'][o_orderkey % 7 + 1] AS failure_type,
  ['CRITICAL', 'HIGH', 'MEDIUM', 'LOW'][o_orderkey % 4 + 1] AS severity,
  o_orderdate AS reported_ts, first_ship AS diagnosed_ts,
  CASE WHEN o_orderstatus <> 'P' THEN first_ship + INTERVAL 1 DAY END AS parts_ordered_ts,
  CASE WHEN o_orderstatus = 'F' THEN last_ship END AS repaired_ts,
  CASE WHEN o_orderstatus = 'F' THEN last_ship + INTERVAL 2 DAY END AS closed_ts,
  o_orderpriority AS root_cause, o_totalprice / 100.0::DOUBLE AS cost_usd, qty * 1.5::DOUBLE AS downtime_hours
FROM orders LEFT JOIN lifecycle ON o_orderkey = l_orderkey""", "lifecycle")


cte("obt", """
SELECT f.sensor_reading_sk, f.reading_id, f.robot_id, f.reading_ts, f.reading_date_key, r.serial_number, r.model_id,
  m.model_name, m.manufacturer, m.max_payload_kg, m.battery_capacity_wh, m.weight_kg, m.max_speed_mps, m.wear_rate,
  r.zone_id AS robot_scd_zone_id, z.zone_name, z.site, z.zone_type, z.has_charging, r.firmware_version, r.owner_team,
  f.battery_voltage_v, f.battery_soc_pct, f.battery_temp_c, f.motor_temp_c, f.motor_rpm, f.motor_load_pct,
  f.vibration_g, f.odometer_m, f.operational_status, f.floor_condition, f.is_reading_ts_parse_failed,
  f.is_battery_soc_invalid, f.is_battery_temp_suspicious, f.is_motor_temp_suspicious, f.is_odometer_invalid
FROM fct_sensor_reading f
LEFT JOIN dim_robot r ON f.robot_sk = r.robot_sk
LEFT JOIN dim_robot_model m ON r.model_id = m.model_id
LEFT JOIN dim_zone z ON r.zone_id = z.zone_id""", "fct_sensor_reading", "dim_robot", "dim_robot_model", "dim_zone")


def sql(body: str, *names: str) -> str:
    """``WITH <closure of names> <body>``."""
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in CTES[n][1]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    if not seen:
        return body.strip()
    parts = [f"{n} AS ({CTES[n][0].strip()})" for n in seen]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()
