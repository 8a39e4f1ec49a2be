"""Dimensional models and marts, composed from staging + operators.

Inputs are DataFrames, so the same functions build the warehouse from the fixtures, from a
CSV landing or from a stream sink. Nothing here collects: every model is one lazy plan.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetra.functions import columns as C
from telemetra.operators import scd
from telemetra.operators import windows as W
from telemetra.operators.joins import pit_join
from telemetra.plans import fixtures as fx
from telemetra.plans import staging as stg
from telemetra.session import scratch_path, session_key

# ---- dimensions -----------------------------------------------------------------------------


def dim_zone(zones_stg: DataFrame) -> DataFrame:
    return zones_stg.select(C.surrogate_key("zone_id").alias("zone_sk"), "zone_id", "zone_name", "site",
                            "zone_type", "floor_area_sqm", "max_robots", "has_charging")


def dim_robot_model(models_stg: DataFrame) -> DataFrame:
    return models_stg.select(C.surrogate_key("model_id").alias("robot_model_sk"), "model_id", "model_name",
                             "manufacturer", "max_payload_kg", "battery_capacity_wh", "weight_kg",
                             "max_speed_mps", "wear_rate", "sensor_suite")


def dim_robot(robots_stg: DataFrame, changes_stg: DataFrame, mode: str = "latest",
              chunk: str | None = "day") -> DataFrame:
    """SCD2 robot dimension: start state at commissioning + attribute change log.
    ``chunk``: "day" runs the windows per (robot, day) and stitches them, so one robot with a
    large share of all changes does not land in a single task (the default); None: plain per-robot windows."""
    base = robots_stg.select("robot_id", "serial_number", "model_id", "commissioned_date",
                             F.col("home_zone_id").alias("zone_id"),
                             F.col("initial_firmware").alias("firmware_version"), "owner_team")
    out = scd.build_scd2(
        base, changes_stg, key="robot_id",
        attributes={"ZONE": "zone_id", "FIRMWARE": "firmware_version", "TEAM": "owner_team"},
        base_valid_from="commissioned_date", carry=("serial_number", "model_id", "commissioned_date"),
        mode=mode, sk_name="robot_sk", chunk=chunk)
    return out.select("robot_sk", "robot_id", "serial_number", "model_id", "zone_id", "firmware_version",
                      "owner_team", "commissioned_date", "valid_from", "valid_to", "is_current")


def dim_date(spark: SparkSession, start: str = "2024-01-01", days: int = 2000) -> DataFrame:
    """Calendar of ``days`` days from ``start`` (the warehouse's fixed spine)."""
    d = spark.range(days).select(F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("date_day"))
    return calendar(d)


def calendar(days: DataFrame) -> DataFrame:
    """Calendar attributes of a ``date_day`` column: key YYYYMMDD, parts, names, ISO week,
    weekend (day_of_week 0 = Sunday)."""
    d = days
    dow = F.dayofweek("date_day") - 1
    return d.select(
        C.date_key("date_day").alias("date_key"), "date_day",
        F.year("date_day").alias("year"), F.quarter("date_day").alias("quarter"),
        F.month("date_day").alias("month"), F.date_format("date_day", "MMM").alias("month_name"),
        F.dayofmonth("date_day").alias("day_of_month"), dow.alias("day_of_week"),
        F.date_format("date_day", "EEE").alias("day_name"), F.weekofyear("date_day").alias("week_of_year"),
        dow.isin(0, 6).alias("is_weekend"))


# ---- facts ----------------------------------------------------------------------------------


def fct_sensor_reading(readings_stg: DataFrame, robot_dim: DataFrame, zone_dim: DataFrame) -> DataFrame:
    """Readings with both ids, point-in-time robot version key, reading-zone key, date key, and the load
    time of the raw row where the landing has one."""
    r = readings_stg.filter(F.col("reading_id").isNotNull() & F.col("robot_id").isNotNull())
    versions = robot_dim.select(F.col("robot_id").alias("_rid"), "robot_sk", "valid_from", "valid_to")
    j = pit_join(r, versions, key="robot_id", dim_key="_rid", ts="reading_ts")
    z = (zone_dim.select(F.col("zone_id").alias("_zid"), "zone_sk"))
    j = j.join(z, j.zone_id == z._zid, "left")
    return j.select(
        C.surrogate_key("reading_id").alias("sensor_reading_sk"),
        "reading_id", "robot_id", "robot_sk", "zone_sk", "reading_ts",
        C.date_key("reading_ts").alias("reading_date_key"),
        "battery_voltage_v", "battery_soc_pct",
        F.col("battery_temp_c_raw").alias("battery_temp_c"), F.col("motor_temp_c_raw").alias("motor_temp_c"),
        "motor_rpm", "motor_load_pct", "vibration_g", "odometer_m",
        "operational_status", "floor_condition", "zone_id",
        "is_reading_ts_parse_failed", "is_battery_soc_invalid", "is_battery_temp_suspicious",
        "is_motor_temp_suspicious", "is_odometer_invalid",
        *[F.col("_loaded_at").alias("raw_loaded_at") for _ in range("_loaded_at" in readings_stg.columns)])


def fct_robot_daily(fact: DataFrame) -> DataFrame:
    """Periodic snapshot per robot-day (one partial + final hash aggregate)."""
    day = F.to_date("reading_ts")
    cnt = lambda cond: F.count_if(cond).cast("bigint")
    daily = (fact.filter(F.col("reading_ts").isNotNull())
             .groupBy(F.col("robot_id"), day.alias("report_date"))
             .agg(F.count(F.lit(1)).alias("reading_count"),
                  F.avg("battery_voltage_v").alias("avg_battery_voltage_v"),
                  F.avg("battery_soc_pct").alias("avg_battery_soc_pct"),
                  F.min("battery_soc_pct").alias("min_battery_soc_pct"),
                  F.avg("battery_temp_c").alias("avg_battery_temp_c"),
                  F.max("battery_temp_c").alias("max_battery_temp_c"),
                  F.avg("motor_temp_c").alias("avg_motor_temp_c"),
                  F.max("motor_temp_c").alias("max_motor_temp_c"),
                  F.avg("motor_rpm").alias("avg_motor_rpm"),
                  F.avg("motor_load_pct").alias("avg_motor_load_pct"),
                  F.avg("vibration_g").alias("avg_vibration_g"),
                  F.max("vibration_g").alias("max_vibration_g"),
                  F.max("odometer_m").alias("max_odometer_m"),
                  cnt(F.col("operational_status") == "ACTIVE").alias("active_reading_count"),
                  cnt(F.col("operational_status") == "ERROR").alias("error_reading_count"),
                  cnt(F.col("operational_status") == "MAINTENANCE").alias("maintenance_reading_count"),
                  cnt(F.col("is_reading_ts_parse_failed")).alias("timestamp_parse_failure_count"),
                  cnt(F.col("is_battery_soc_invalid")).alias("invalid_soc_count"),
                  cnt(F.col("is_motor_temp_suspicious")).alias("suspicious_motor_temp_count"),
                  cnt(F.col("is_odometer_invalid")).alias("invalid_odometer_count")))
    return daily.select(C.surrogate_key("robot_id", "report_date").alias("robot_daily_sk"),
                        "robot_id", "report_date", C.date_key("report_date").alias("report_date_key"),
                        *[c for c in daily.columns if c not in ("robot_id", "report_date")])


def fct_maintenance(tickets: DataFrame) -> DataFrame:
    """Accumulating snapshot of ticket lifecycles: stage timestamps, date keys, durations."""
    hours = lambda a, b: (F.unix_micros(F.col(b).cast("timestamp")) - F.unix_micros(F.col(a).cast("timestamp"))) \
        / F.lit(3600e6)
    return tickets.select(
        C.surrogate_key("ticket_id").alias("maintenance_sk"),
        "ticket_id", "robot_id", "failure_type", "severity",
        "reported_ts", "diagnosed_ts", "parts_ordered_ts", "repaired_ts", "closed_ts",
        C.date_key("reported_ts").alias("reported_date_key"),
        C.date_key("diagnosed_ts").alias("diagnosed_date_key"),
        C.date_key("repaired_ts").alias("repaired_date_key"),
        C.date_key("closed_ts").alias("closed_date_key"),
        "root_cause", "cost_usd", "downtime_hours",
        hours("reported_ts", "diagnosed_ts").alias("hours_to_diagnose"),
        hours("reported_ts", "closed_ts").alias("hours_to_close"),
        F.col("closed_ts").isNull().alias("is_open"))


MAINTENANCE_PLACEHOLDER_SCHEMA = (
    "maintenance_sk string, ticket_id string, robot_id string, failure_type string, severity string, "
    "reported_ts timestamp_ntz, diagnosed_ts timestamp_ntz, parts_ordered_ts timestamp_ntz, "
    "repaired_ts timestamp_ntz, closed_ts timestamp_ntz, reported_date_key bigint, "
    "diagnosed_date_key bigint, repaired_date_key bigint, closed_date_key bigint, "
    "root_cause string, cost_usd double, downtime_hours double")


def fct_maintenance_placeholder(spark: SparkSession) -> DataFrame:
    """The warehouse's typed, empty accumulating snapshot."""
    return spark.createDataFrame([], MAINTENANCE_PLACEHOLDER_SCHEMA)


def as_placeholder_schema(snapshot: DataFrame) -> DataFrame:
    """The built snapshot in the placeholder's column names and types (a drop-in for it)."""
    from pyspark.sql.types import _parse_datatype_string
    schema = _parse_datatype_string(MAINTENANCE_PLACEHOLDER_SCHEMA)
    return snapshot.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


# ---- marts ----------------------------------------------------------------------------------


def obt_sensor_readings(fact: DataFrame, robot_dim: DataFrame, model_dim: DataFrame,
                        zone_dim: DataFrame) -> DataFrame:
    """One big table: fact + robot version (by key) + model + the robot version's zone."""
    r = (robot_dim.select(F.col("robot_sk").alias("_rsk"), "serial_number", "model_id",
                                            F.col("zone_id").alias("robot_scd_zone_id"),
                                            "firmware_version", "owner_team"))
    m = (model_dim.select(F.col("model_id").alias("_mid"), "model_name", "manufacturer",
                                            "max_payload_kg", "battery_capacity_wh", "weight_kg",
                                            "max_speed_mps", "wear_rate"))
    z = (zone_dim.select(F.col("zone_id").alias("_zid"), "zone_name", "site",
                                           "zone_type", "has_charging"))
    j = (fact.join(r, fact.robot_sk == r._rsk, "left")
         .join(m, F.col("model_id") == m._mid, "left")
         .join(z, F.col("robot_scd_zone_id") == z._zid, "left"))
    return j.select(
        "sensor_reading_sk", "reading_id", "robot_id", "reading_ts", "reading_date_key",
        "serial_number", "model_id", "model_name", "manufacturer", "max_payload_kg", "battery_capacity_wh",
        "weight_kg", "max_speed_mps", "wear_rate", "robot_scd_zone_id", "zone_name", "site", "zone_type",
        "has_charging", "firmware_version", "owner_team",
        "battery_voltage_v", "battery_soc_pct", "battery_temp_c", "motor_temp_c", "motor_rpm",
        "motor_load_pct", "vibration_g", "odometer_m", "operational_status", "floor_condition",
        "is_reading_ts_parse_failed", "is_battery_soc_invalid", "is_battery_temp_suspicious",
        "is_motor_temp_suspicious", "is_odometer_invalid")


FEATURES_7D = {
    "avg_motor_temp_7d": ("avg", "avg_motor_temp_c"),
    "max_motor_temp_7d": ("max", "max_motor_temp_c"),
    "avg_vibration_7d": ("avg", "avg_vibration_g"),
    "max_vibration_7d": ("max", "max_vibration_g"),
    "avg_battery_soc_7d": ("avg", "avg_battery_soc_pct"),
    "error_readings_7d": ("sum", "error_reading_count"),
    "suspicious_motor_temp_count_7d": ("sum", "suspicious_motor_temp_count"),
}


def mart_features_training(daily: DataFrame, rows: int = 7, calendar_days: bool = False) -> DataFrame:
    """Trailing features per robot-day: the last 7 daily rows (default) or 7 calendar days."""
    d = daily.select("robot_id", F.col("report_date").alias("as_of_date"),
                     F.col("report_date_key").alias("as_of_date_key"), "reading_count",
                     *{c for _, c in FEATURES_7D.values()})
    out = W.trailing(d, "robot_id", "as_of_date", FEATURES_7D, rows=rows,
                     day_range="as_of_date" if calendar_days else None)
    return out.select("robot_id", "as_of_date", "as_of_date_key", *FEATURES_7D.keys(), "reading_count")


def fct_robot_health_daily(telemetry_stg: DataFrame) -> DataFrame:
    return (telemetry_stg.groupBy("robotid", F.to_date("event_timestamp").alias("summary_date"))
            .agg(F.count(F.lit(1)).alias("event_count"),
                 F.avg("motortemp").alias("avg_motor_temp"), F.max("motortemp").alias("max_motor_temp"),
                 F.avg("batteryvoltage").alias("avg_battery_voltage"),
                 F.min("batteryvoltage").alias("min_battery_voltage"),
                 F.max("vibration").alias("max_vibration")))


def mart_training_dataset(health: DataFrame, failures: DataFrame, fan_out: bool = True) -> DataFrame:
    """Daily health + will_fail_in_next_7_days label."""
    h = health.select("robotid", "summary_date", "avg_motor_temp", "max_motor_temp",
                      "avg_battery_voltage", "min_battery_voltage", "max_vibration")
    f = failures.select(F.col("robot_id").alias("robotid"), "failure_date")
    return scd.lookahead_label(h, f, key="robotid", day="summary_date", event_day="failure_date",
                               horizon=7, fan_out=fan_out, label="will_fail_in_next_7_days")


# ---- the warehouse, built from the fixtures ---------------------------------------------------


class Warehouse:
    """Lazily built models over one fixture directory; each model is a DataFrame plan.

    ``Warehouse(spark, dir)`` returns the same instance for the same session, directory and
    SCD mode, so queries that share models share their plans (and Spark can reuse their
    exchanges when several of them run in one job)."""

    _instances: dict[tuple, Warehouse] = {}

    def __new__(cls, spark: SparkSession, sf_dir: str, scd_mode: str = "latest"):
        key = (session_key(spark), sf_dir, scd_mode)
        inst = cls._instances.get(key)
        if inst is None:
            inst = super().__new__(cls)
            inst.spark, inst.sf_dir, inst.scd_mode = spark, sf_dir, scd_mode
            inst._cache = {}
            cls._instances[key] = inst
        return inst

    def __init__(self, spark: SparkSession, sf_dir: str, scd_mode: str = "latest"):
        pass

    @classmethod
    @contextmanager
    def built(cls, spark: SparkSession, sf_dir: str, *models: str, scd_mode: str = "latest"):
        """While the block runs, ``Warehouse(spark, dir)`` reads ``models`` from tables that are written first, in the given
        order, each from the ones before: plans made in the block share them instead of computing them again."""
        key = (session_key(spark), sf_dir, scd_mode)
        before = cls._instances.pop(key, None)
        try:
            w = cls(spark, sf_dir, scd_mode)
            for name in models:
                df, path = getattr(w, name), scratch_path(spark, f"built_{name}")
                df.write.parquet(path)
                w._cache[name] = spark.read.schema(df.schema).parquet(path)
            yield w
        finally:
            cls._instances.pop(key, None)
            if before is not None:
                cls._instances[key] = before

    def _get(self, name, build):
        if name not in self._cache:
            self._cache[name] = build()
        return self._cache[name]

    @property
    def stg_readings(self):
        return self._get("stg_readings", lambda: stg.stg_sensor_readings(fx.readings(self.spark, self.sf_dir)))

    @property
    def stg_robots(self):
        return self._get("stg_robots", lambda: stg.stg_robots(fx.robots(self.spark, self.sf_dir)))

    @property
    def stg_changes(self):
        return self._get("stg_changes", lambda: stg.stg_robot_attribute_changes(
            fx.attribute_changes(self.spark, self.sf_dir)))

    @property
    def stg_zones(self):
        return self._get("stg_zones", lambda: stg.stg_zones(fx.zones_raw(self.spark, self.sf_dir)))

    @property
    def stg_models(self):
        return self._get("stg_models", lambda: stg.stg_robot_models(fx.robot_models(self.spark, self.sf_dir)))

    @property
    def stg_tasks(self):
        return self._get("stg_tasks", lambda: stg.stg_tasks(fx.tasks(self.spark, self.sf_dir)))

    @property
    def stg_telemetry(self):
        return self._get("stg_telemetry", lambda: stg.stg_telemetry(fx.telemetry(self.spark, self.sf_dir)))

    @property
    def dim_zone(self):
        return self._get("dim_zone", lambda: dim_zone(self.stg_zones))

    @property
    def dim_robot_model(self):
        return self._get("dim_robot_model", lambda: dim_robot_model(self.stg_models))

    @property
    def dim_robot(self):
        return self._get("dim_robot", lambda: dim_robot(self.stg_robots, self.stg_changes, self.scd_mode))

    @property
    def fct_sensor_reading(self):
        return self._get("fct_sensor_reading", lambda: fct_sensor_reading(
            self.stg_readings, self.dim_robot, self.dim_zone))

    @property
    def obt(self):
        return self._get("obt", lambda: obt_sensor_readings(
            self.fct_sensor_reading, self.dim_robot, self.dim_robot_model, self.dim_zone))

    @property
    def fct_robot_daily(self):
        return self._get("fct_robot_daily", lambda: fct_robot_daily(self.fct_sensor_reading))

    @property
    def health_daily(self):
        return self._get("health_daily", lambda: fct_robot_health_daily(self.stg_telemetry))
