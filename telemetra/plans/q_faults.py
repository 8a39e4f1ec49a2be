"""Registered queries: fault injection, dirt round trip, unit / spike repair."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetra.functions import columns as C
from telemetra.operators import faults as X
from telemetra.plans import fixtures as fx
from telemetra.plans import staging as stg
from telemetra.plans.catalog import query
from telemetra.plans.oracle import cte, sql
from telemetra.session import scratch_path
from telemetra.sources import ingest as I

HEXS = "'0123456789abcdef'"


def hd(h: str, p: int) -> str:
    return f"(instr({HEXS}, substr({h}, {p}, 1)) - 1)"


NULL_FIELDS = ["battery_voltage_v", "motor_temp_c", "motor_rpm"]
FAULT_COLS = ["reading_id", "robot_id", "reading_ts", "battery_voltage_v", "motor_temp_c", "motor_rpm"]


def _faults_sql() -> str:
    t = X.threshold
    nulls = ", ".join(f"CASE WHEN _null AND which = {i} THEN NULL ELSE {c} END AS {c}" for i, c in enumerate(NULL_FIELDS))
    cte("fault_f", f"""
SELECT *, substr(h, 1, 4) < '{t(0.02)}' AS _dup, substr(h, 5, 4) < '{t(0.01)}' AS _null,
  substr(h, 9, 4) < '{t(0.005)}' AS _late, {hd('h', 13)} % {len(NULL_FIELDS)} AS which,
  ({hd('h', 14)} * 16 + {hd('h', 15)}) % 48 + 1 AS hours
FROM (SELECT *, md5(reading_id || ':42') AS h FROM readings)""", "readings")
    cte("fault_g", f"""
SELECT reading_id, robot_id, CASE WHEN _late THEN reading_ts - to_hours(hours) ELSE reading_ts END AS reading_ts,
  {nulls}, _dup FROM fault_f""", "fault_f")
    return sql("SELECT * EXCLUDE (_dup) FROM fault_g UNION ALL SELECT * EXCLUDE (_dup) FROM fault_g WHERE _dup",
               "fault_g")


@query("inject_faults", _faults_sql())
def inject_faults(spark, sf):
    """~2% duplicated, ~1% with a nulled scalar, ~0.5% shifted 1..48 h late (hash-chosen rows)."""
    r = fx.readings(spark, sf).select(*FAULT_COLS)
    out, _ = X.inject_faults(r, "reading_id", "reading_ts", NULL_FIELDS, seed=42)
    return out


@query("inject_faults_manifest", f"""
SELECT count_if(substr(h, 1, 4) < '{X.threshold(0.02)}') AS duplicates_injected,
       count_if(substr(h, 5, 4) < '{X.threshold(0.01)}') AS nulled_scalars_injected,
       count_if(substr(h, 9, 4) < '{X.threshold(0.005)}') AS late_rows_injected
FROM (SELECT md5(CAST(event_id AS VARCHAR) || ':42') AS h FROM events)""")
def inject_faults_manifest(spark, sf):
    """Exact counts of each injected fault."""
    r = fx.readings(spark, sf).select(*FAULT_COLS)
    _, manifest = X.inject_faults(r, "reading_id", "reading_ts", NULL_FIELDS, seed=42)
    return manifest


# ---- dirt round trip ------------------------------------------------------------------------------

NUMERIC = list(stg.READING_MEASURES)
TEMPS = ["battery_temp_c", "motor_temp_c"]


def _text_landing(spark, sf):
    r = fx.readings(spark, sf).drop("error_codes", "power_draw_watts")
    return r.select(*[F.col(c).cast("string").alias(c) for c in r.columns])


def _dirty(spark, sf):
    return X.inject_dirt(_text_landing(spark, sf), "reading_id", NUMERIC, ["robot_id", "reading_id", "zone_id"],
                         ["operational_status", "floor_condition"], TEMPS, "reading_ts", "battery_soc_pct", seed=7)


def _dirt_sql() -> str:
    h = "h"
    kind = lambda k: f"(dirty AND {hd(h, 3 + k)} < 5)"
    vals = []
    for i, c in enumerate(NUMERIC):
        e = f"CASE WHEN {kind(0)} AND {hd(h, 13)} % {len(NUMERIC)} = {i} THEN NULL "
        if c == "battery_soc_pct":
            e += f"WHEN {kind(6)} THEN -abs({c}) "
        e += f"WHEN {kind(4)} AND {hd(h, 18)} % {len(NUMERIC)} = {i} THEN {c} * (5.0::DOUBLE + CAST({hd(h, 19)} AS DOUBLE)) "
        if c in TEMPS:
            e += f"WHEN {kind(3)} THEN {c} * 1.8::DOUBLE + 32.0::DOUBLE "
        e += f"ELSE {c} END AS {c}"
        vals.append(e)
    ts = (f"CASE WHEN {kind(5)} THEN (CASE WHEN {hd(h, 20)} % 5 = 1 THEN date_trunc('minute', reading_ts) "
          f"ELSE date_trunc('second', reading_ts) END) ELSE reading_ts END AS reading_ts")
    dirty = f"""
SELECT reading_id, robot_id, {ts}, {', '.join(vals)}, operational_status, floor_condition, zone_id
FROM (SELECT *, substr(h, 1, 2) < '{X.threshold(0.08, 2)}' AS dirty
      FROM (SELECT *, md5(reading_id || ':7') AS h FROM readings))"""
    body = f"""
SELECT reading_id, robot_id, reading_ts, false AS is_reading_ts_parse_failed, battery_voltage_v,
  CASE WHEN battery_soc_pct >= 0 AND battery_soc_pct <= 100 THEN battery_soc_pct END AS battery_soc_pct,
  coalesce(battery_soc_pct < 0 OR battery_soc_pct > 100, false) AS is_battery_soc_invalid,
  battery_temp_c AS battery_temp_c_raw, coalesce(battery_temp_c > 60, false) AS is_battery_temp_suspicious,
  coalesce(motor_temp_c > 100, false) AS is_motor_temp_suspicious, motor_temp_c AS motor_temp_c_raw,
  motor_rpm, motor_load_pct, vibration_g, CASE WHEN odometer_m >= 0 THEN odometer_m END AS odometer_m,
  coalesce(odometer_m < 0, false) AS is_odometer_invalid, operational_status, floor_condition, zone_id
FROM ({dirty})"""
    return sql(body, "readings")


@query("inject_dirt", _dirt_sql())
def inject_dirt(spark, sf):
    """Dirty raw-text landing (10 dirt kinds on ~8% of rows) read back through null-token
    handling and staging: ids, enums and layouts are undone; unit / spike errors remain."""
    landing = I.apply_null_tokens(_dirty(spark, sf), C.WIDE_NULL_TOKENS, exact=False)
    s = stg.stg_sensor_readings(landing, formats=C.TS_FORMATS_EXTENDED, epoch_digits=True)
    return s.drop("reading_ts_raw")


@query("inject_dirt_landing", None)
def inject_dirt_landing(spark, sf):
    """The dirty all-text landing itself (junk and near-duplicate columns included)."""
    return _dirty(spark, sf)


# ---- unit / spike repair ----------------------------------------------------------------------------

def _dirty_temp_sql() -> str:
    return (f"SELECT reading_id, robot_id, CASE WHEN substr(h2, 1, 2) < '0a' THEN motor_temp_c * 1.8::DOUBLE + 32.0::DOUBLE "
            f"WHEN substr(h2, 3, 2) < '06' THEN motor_temp_c * (5.0::DOUBLE + CAST({hd('h2', 5)} AS DOUBLE)) "
            f"ELSE motor_temp_c END AS motor_temp_dirty FROM (SELECT *, md5(reading_id || ':11') AS h2 FROM readings)")


@query("unit_repair_temp", sql(f"""
SELECT reading_id, robot_id, motor_temp_dirty, median, mad, is_outlier,
  CASE WHEN fahrenheit THEN 'FAHRENHEIT' WHEN is_outlier THEN 'SPIKE' END AS repair_kind,
  CASE WHEN fahrenheit THEN as_c WHEN is_outlier THEN NULL ELSE motor_temp_dirty END AS motor_temp_dirty_repaired
FROM (
  SELECT *, is_outlier AND abs(as_c - median) <= 3.5 * mad AS fahrenheit FROM (
    SELECT d.*, s.median, s.mad, coalesce(abs(motor_temp_dirty - s.median) > 3.5 * s.mad, false) AS is_outlier,
      (motor_temp_dirty - 32.0::DOUBLE) / 1.8::DOUBLE AS as_c
    FROM ({_dirty_temp_sql()}) d
    LEFT JOIN (
      SELECT m.robot_id, m.median, quantile_disc(abs(d2.motor_temp_dirty - m.median), 0.5) AS mad
      FROM (SELECT robot_id, quantile_disc(motor_temp_dirty, 0.5) AS median FROM ({_dirty_temp_sql()}) GROUP BY 1) m
      JOIN ({_dirty_temp_sql()}) d2 ON d2.robot_id = m.robot_id GROUP BY 1, 2) s
    ON d.robot_id = s.robot_id))""", "readings"))
def unit_repair_temp(spark, sf):
    """Motor temperatures with Fahrenheit writes and 5-20x spikes: per-robot median / MAD
    outlier test, Fahrenheit converted back, spikes nulled."""
    r = fx.readings(spark, sf)
    h2 = X.row_hash(["reading_id"], 11)
    dirty = r.select("reading_id", "robot_id", F.when(F.substring(h2, 1, 2) < "0a", F.col("motor_temp_c") * 1.8 + 32.0)
                     .when(F.substring(h2, 3, 2) < "06",
                           F.col("motor_temp_c") * (F.lit(5.0) + X.hex_digit(h2, 5).cast("double")))
                     .otherwise(F.col("motor_temp_c")).alias("motor_temp_dirty"))
    landed = scratch_path(spark, "dirty_temps")  # the dirt is worked out once, the repair reads it several times
    dirty.write.parquet(landed)
    out = X.robust_repair(spark.read.schema(dirty.schema).parquet(landed), "robot_id", "motor_temp_dirty")
    return out.select("reading_id", "robot_id", "motor_temp_dirty", "median", "mad", "is_outlier", "repair_kind",
                      "motor_temp_dirty_repaired")
