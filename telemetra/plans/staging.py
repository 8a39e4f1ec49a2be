"""Staging layer: raw (text or typed) landing -> cleaned, typed, flagged.

Each function accepts the landing either as all-text columns (CSV ingest) or already typed
(parquet); the type is checked when the plan is built, so typed input skips text parsing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from telemetra.functions import columns as C

READING_MEASURES = ("battery_voltage_v", "battery_soc_pct", "battery_temp_c", "motor_temp_c",
                    "motor_rpm", "motor_load_pct", "vibration_g", "odometer_m")
TASK_TYPES_VALID = ("PICK", "PUT", "MOVE", "INSPECT", "CHARGE", "IDLE")
TASK_STATUSES_VALID = ("ASSIGNED", "IN_PROGRESS", "COMPLETED", "FAILED", "CANCELLED", "TIMEOUT")


def _is_text(df: DataFrame, c: str) -> bool:
    """Whether column ``c`` is text; names resolve case-insensitively, as Spark resolves them
    (a CSV landing has upper-case cleaned headers)."""
    field = next(f for f in df.schema.fields if f.name.lower() == c.lower())
    return isinstance(field.dataType, StringType)


def _ts(df: DataFrame, c: str, formats=C.TS_FORMATS, epoch_digits: bool = True) -> Column:
    return C.parse_ts(c, formats, epoch_digits) if _is_text(df, c) else F.col(c).cast("timestamp_ntz")


def _dbl(df: DataFrame, c: str) -> Column:
    return C.safe_double(c) if _is_text(df, c) else F.col(c).cast("double")


# Names of the raw landing (fixed values) -> names of the measures.
LANDING_NAMES = {"voltage_v": "battery_voltage_v", "soc_pct": "battery_soc_pct", "rpm": "motor_rpm", "load_pct": "motor_load_pct"}


def landing_renamed(raw: DataFrame) -> DataFrame:
    """Readings under the landing's own header get the measures' names; others stay as they are."""
    return raw.withColumnsRenamed({c: LANDING_NAMES[c.lower()] for c in raw.columns if c.lower() in LANDING_NAMES})


def _load_columns(raw: DataFrame) -> list[Column]:
    """The load's own columns, where the landing has them."""
    return [F.col(c).alias(c.lower()) for c in raw.columns if c.lower() in ("_loaded_at", "_source_file")]


def _text_id(c: str) -> Column:
    return C.trim_nullif(F.col(c).cast("string"))


def stg_sensor_readings(raw: DataFrame, formats=C.TS_FORMATS_WITH_T, epoch_digits: bool = True) -> DataFrame:
    """Ids trimmed, multi-layout timestamp + parse flag, range null-out + flags, enums upper.
    ``formats=C.TS_FORMATS_EXTENDED, epoch_digits=True`` also reads the layouts the dirt
    generator writes but the warehouse does not parse."""
    raw = landing_renamed(raw)
    ts = _ts(raw, "reading_ts", formats, epoch_digits)
    soc = _dbl(raw, "battery_soc_pct")
    odo = _dbl(raw, "odometer_m")
    bt = _dbl(raw, "battery_temp_c")
    mt = _dbl(raw, "motor_temp_c")
    return raw.select(
        _text_id("reading_id").alias("reading_id"),
        _text_id("robot_id").alias("robot_id"),
        F.col("reading_ts").alias("reading_ts_raw"),
        ts.alias("reading_ts"),
        C.parse_failed("reading_ts", ts).alias("is_reading_ts_parse_failed"),
        _dbl(raw, "battery_voltage_v").alias("battery_voltage_v"),
        C.keep_between(soc, 0.0, 100.0).alias("battery_soc_pct"),
        C.outside_flag(soc, 0.0, 100.0).alias("is_battery_soc_invalid"),
        bt.alias("battery_temp_c_raw"),
        C.above_flag(bt, 60.0).alias("is_battery_temp_suspicious"),
        C.above_flag(mt, 100.0).alias("is_motor_temp_suspicious"),
        mt.alias("motor_temp_c_raw"),
        _dbl(raw, "motor_rpm").alias("motor_rpm"),
        _dbl(raw, "motor_load_pct").alias("motor_load_pct"),
        _dbl(raw, "vibration_g").alias("vibration_g"),
        C.keep_between(odo, 0.0, None).alias("odometer_m"),
        C.outside_flag(odo, 0.0, None).alias("is_odometer_invalid"),
        C.upper_trim("operational_status").alias("operational_status"),
        C.upper_trim("floor_condition").alias("floor_condition"),
        C.trim_nullif("zone_id").alias("zone_id"),
        *_load_columns(raw))


def stg_robots(raw: DataFrame) -> DataFrame:
    cd = C.safe_date("commissioned_date") if _is_text(raw, "commissioned_date") \
        else F.col("commissioned_date").cast("date")
    return raw.select(
        _text_id("robot_id").alias("robot_id"),
        C.trim_nullif("serial_number").alias("serial_number"),
        C.trim_nullif("model_id").alias("model_id"),
        cd.alias("commissioned_date"),
        C.trim_nullif("home_zone_id").alias("home_zone_id"),
        C.trim_nullif("initial_firmware").alias("initial_firmware"),
        C.trim_nullif("owner_team").alias("owner_team"), *_load_columns(raw))


def stg_robot_models(raw: DataFrame) -> DataFrame:
    return raw.select(
        C.trim_nullif("model_id").alias("model_id"),
        C.trim_nullif("model_name").alias("model_name"),
        C.trim_nullif("manufacturer").alias("manufacturer"),
        *[_dbl(raw, c).alias(c) for c in ("max_payload_kg", "battery_capacity_wh", "weight_kg",
                                          "max_speed_mps", "wear_rate")],
        C.trim_nullif("sensor_suite").alias("sensor_suite"), *_load_columns(raw))


def stg_zones(raw: DataFrame) -> DataFrame:
    return raw.select(
        C.trim_nullif("zone_id").alias("zone_id"),
        C.trim_nullif("zone_name").alias("zone_name"),
        C.trim_nullif("site").alias("site"),
        C.upper_trim("zone_type").alias("zone_type"),
        C.safe_double("floor_area_sqm").alias("floor_area_sqm"),
        C.safe_number("max_robots").alias("max_robots"),
        C.bool_words("has_charging").alias("has_charging"), *_load_columns(raw))


def stg_robot_attribute_changes(raw: DataFrame) -> DataFrame:
    ts = _ts(raw, "changed_at", C.TS_FORMATS)
    return raw.select(
        _text_id("change_id").alias("change_id"),
        _text_id("robot_id").alias("robot_id"),
        ts.alias("changed_at"),
        C.canonical_attribute("attribute").alias("attribute"),
        C.trim_nullif("old_value").alias("old_value"),
        C.trim_nullif("new_value").alias("new_value"),
        C.parse_failed("changed_at", ts).alias("is_changed_at_parse_failed"), *_load_columns(raw))


def stg_tasks(raw: DataFrame) -> DataFrame:
    """Typed tasks + 5 quality flags. Unknown type/status are flagged; NULL ones are not
    (``NULL NOT IN (...)`` is unknown -> false), as in the warehouse."""
    a, s, c = (_ts(raw, x) for x in ("assigned_ts", "started_ts", "completed_ts"))
    ttype, status = C.upper_trim("task_type"), C.upper_trim("status")
    return raw.select(
        _text_id("task_id").alias("task_id"),
        _text_id("robot_id").alias("robot_id"),
        ttype.alias("task_type"), status.alias("status"),
        C.safe_number(F.col("priority").cast("string")).alias("priority"),
        a.alias("assigned_ts"), s.alias("started_ts"), c.alias("completed_ts"),
        _dbl(raw, "distance_m").alias("distance_m"), _dbl(raw, "payload_kg").alias("payload_kg"),
        C.trim_nullif("source_zone_id").alias("source_zone_id"),
        C.trim_nullif("destination_zone_id").alias("destination_zone_id"),
        C.safe_number(F.col("error_count").cast("string")).alias("error_count"),
        (F.col("task_id").isNull() | (F.trim(F.col("task_id").cast("string")) == "")).alias("is_missing_task_id"),
        (F.col("robot_id").isNull() | (F.trim(F.col("robot_id").cast("string")) == "")).alias("is_missing_robot_id"),
        F.coalesce(~ttype.isin(*TASK_TYPES_VALID), F.lit(False)).alias("is_invalid_task_type"),
        F.coalesce(~status.isin(*TASK_STATUSES_VALID), F.lit(False)).alias("is_invalid_status"),
        F.coalesce(a.isNotNull() & s.isNotNull() & (s < a), F.lit(False)).alias("is_task_lifecycle_invalid"),
        *_load_columns(raw))


def stg_telemetry(raw: DataFrame) -> DataFrame:
    """Stream telemetry: unix seconds -> timestamp, partitions passed through."""
    return raw.select("robotid", C.epoch_to_ts("timestamp").alias("event_timestamp"),
                      "motortemp", "batteryvoltage", "vibration", "year", "month", "day", "hour")
