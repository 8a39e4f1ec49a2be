"""Fleet-shaped views over the driver's tables.

The reference's contract tables (robots, zones, robot models, attribute change log, sensor
readings, tasks, maintenance tickets, stream telemetry) are derived deterministically from the
TPC-H-like fixtures so every model runs on data whose volume grows with the scale factor:

    events    -> sensor readings (one reading per event; props.k drives the motor channel)
    customer  -> robots            nation+region -> zones        part -> robot models
    orders    -> attribute change log, tasks and maintenance tickets (lineitem gives lifecycle)
    events    -> stream telemetry (unix seconds + hive partition columns), failures

The same derivations are mirrored in DuckDB SQL in ``plans/oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetra.sources.tables import read_table


def _k(props: Column) -> Column:
    """props.k as INT (get_json_object is code-generated; from_json is not)."""
    return F.get_json_object(props, "$.k").cast("int")


def _d(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def _status_from_event(event_type: Column) -> Column:
    return (F.when(event_type == "click", "ACTIVE")
            .when(event_type == "view", "IDLE")
            .when(event_type == "purchase", "CHARGING")
            .when(event_type == "signup", "MAINTENANCE")
            .otherwise(F.upper(event_type)))


def _floor(k: Column) -> Column:
    m = k % 4
    return (F.when(m == 0, "DRY").when(m == 1, "WET").when(m == 2, "DUSTY").otherwise("OILY"))


def reading_measures(k: Column, value: Column, event_id: Column) -> dict[str, Column]:
    """The measurement channels of one reading, as flat columns."""
    kd = k.cast("double")
    return {
        "battery_voltage_v": F.lit(44.0) + kd / F.lit(10.0),
        "battery_soc_pct": F.lit(105.0) - value,
        "battery_temp_c": F.lit(20.0) + value / F.lit(4.0),
        "motor_temp_c": kd * F.lit(1.8) - F.lit(25.0),
        "motor_rpm": kd * F.lit(30.0),
        "motor_load_pct": value / F.lit(5.0),
        "vibration_g": value / F.lit(20.0) - F.lit(0.5),
        "odometer_m": F.when(event_id % 53 == 0, -value).otherwise(event_id.cast("double") * F.lit(2.5)),
        "power_draw_watts": value * F.lit(3.0) + F.lit(50.0),
    }


def error_codes(k: Column, event_type: Column) -> Column:
    return F.array_compact(F.array(
        F.when(k % 10 == 0, F.lit("E_MOTOR_OVERHEAT")),
        F.when(k % 7 == 0, F.lit("E_LOW_BATTERY")),
        F.when(event_type == "error", F.lit("E_NAV_FAULT")),
    ))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat typed sensor readings (the staged shape of the landing)."""
    e = read_table(spark, sf_dir, "events")
    k = _k(F.col("props"))
    m = reading_measures(k, F.col("value"), F.col("event_id"))
    return e.select(
        F.col("event_id").cast("string").alias("reading_id"),
        F.col("user_id").cast("string").alias("robot_id"),
        F.col("ts").alias("reading_ts"),
        *[v.alias(n) for n, v in m.items()],
        (k % 25).cast("string").alias("zone_id"),
        _floor(k).alias("floor_condition"),
        _status_from_event(F.col("event_type")).alias("operational_status"),
        error_codes(k, F.col("event_type")).alias("error_codes"),
    )


# Structs of the lake landing (fixed layout): field <- channel.
NESTED = {
    "battery": {"voltage_v": "battery_voltage_v", "soc_pct": "battery_soc_pct", "temp_c": "battery_temp_c",
                "charge_cycles": "charge_cycles", "current_amps": "battery_current_amps", "health_pct": "battery_health_pct"},
    "motor": {"temp_c": "motor_temp_c", "rpm": "motor_rpm", "load_pct": "motor_load_pct",
              "current_amps": "motor_current_amps", "vibration_g": "vibration_g"},
    "navigation": {c: c for c in ("x_m", "y_m", "heading_deg", "speed_mps", "zone_id", "lidar_front_m", "lidar_rear_m",
                                  "lidar_left_m", "lidar_right_m", "obstacle_detected")},
    "environment": {c: c for c in ("ambient_temp_c", "humidity_pct", "light_level_lux", "floor_condition")},
    "connectivity": {c: c for c in ("wifi_signal_dbm", "latency_ms", "packet_loss_pct", "access_point_id")},
    "wheels": {"left_rpm": "left_rpm", "right_rpm": "right_rpm", "odometer_m": "odometer_m"},
}


def other_channels(k: Column, value: Column, event_id: Column) -> dict[str, Column]:
    """The channels beside the analysed measures; some lie outside the contract's ranges."""
    kd = k.cast("double")
    numbers = {
        "battery_current_amps": value / F.lit(10.0), "battery_health_pct": F.lit(101.0) - kd / F.lit(4.0),
        "motor_current_amps": kd / F.lit(8.0), "x_m": value, "y_m": kd, "heading_deg": kd * F.lit(4.0),
        "speed_mps": value / F.lit(40.0) - F.lit(0.25), "lidar_front_m": kd / F.lit(4.0), "lidar_rear_m": kd / F.lit(8.0),
        "lidar_left_m": value / F.lit(16.0), "lidar_right_m": value / F.lit(32.0), "ambient_temp_c": F.lit(15.0) + kd / F.lit(16.0),
        "humidity_pct": value - F.lit(1.0), "light_level_lux": kd * F.lit(8.0), "wifi_signal_dbm": F.lit(-30.0) - kd / F.lit(2.0),
        "latency_ms": value * F.lit(2.0), "packet_loss_pct": kd / F.lit(32.0), "left_rpm": kd * F.lit(15.0), "right_rpm": kd * F.lit(16.0),
    }
    return numbers | {
        "charge_cycles": k.cast("bigint") * 3 - 2, "obstacle_detected": event_id % 9 == 0,
        "access_point_id": F.concat(F.lit("AP-"), (event_id % 12).cast("string")),
        "zone_id": (k % 25).cast("string"), "floor_condition": _floor(k)}


def nested_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with the nested struct layout of the lake parquet: six structs, 38 fields in all."""
    e = read_table(spark, sf_dir, "events")
    k, value, event = _k(F.col("props")), F.col("value"), F.col("event_id")
    channels = reading_measures(k, value, event) | other_channels(k, value, event)
    return e.select(
        event.cast("string").alias("reading_id"),
        F.col("user_id").cast("string").alias("robot_id"),
        F.col("ts").alias("reading_ts"),
        *[F.struct(*[channels[c].alias(f) for f, c in fields.items()]).alias(name) for name, fields in NESTED.items()],
        error_codes(k, F.col("event_type")).alias("error_codes"),
        channels["power_draw_watts"].alias("power_draw_watts"),
        _status_from_event(F.col("event_type")).alias("operational_status"),
    )


_LANDED: dict[tuple, str] = {}


def nested_readings_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested readings as a parquet landing (written once per process under the shared
    checkpoint folder), read back like the lake job's input file: a projection of a few struct
    leaves reads only those leaves (nested schema pruning)."""
    from telemetra.session import scratch_path, session_key
    key = (session_key(spark), sf_dir)
    if key not in _LANDED:
        path = scratch_path(spark, "sensor_readings_nested")
        nested_readings(spark, sf_dir).write.mode("overwrite").parquet(path)
        _LANDED[key] = path
    return spark.read.parquet(_LANDED[key])


def robots(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("string").alias("robot_id"),
        F.concat(F.lit("SN-"), F.col("c_custkey").cast("string")).alias("serial_number"),
        (F.col("c_custkey") % 50).cast("string").alias("model_id"),
        F.date_add(F.lit("2023-12-15").cast("date"), (F.col("c_custkey") % 30).cast("int")).alias("commissioned_date"),
        F.col("c_nationkey").cast("string").alias("home_zone_id"),
        F.concat(F.lit("fw-1."), (F.col("c_custkey") % 4).cast("string")).alias("initial_firmware"),
        F.col("c_mktsegment").alias("owner_team"),
    )


def _changed_at(orderdate: Column) -> Column:
    days = F.datediff(orderdate.cast("date"), F.lit("1995-01-01").cast("date"))
    return F.timestamp_add("MINUTE", days * 17, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))


def attribute_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Robot attribute change log (raw attribute names, as written by the source system)."""
    o = read_table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    grp = key % 3
    raw_attr = (F.when(key % 6 == 0, "firmware").when(key % 6 == 1, "home_zone")
                .when(key % 6 == 2, "owner_team").when(key % 6 == 3, "Firmware_Version")
                .when(key % 6 == 4, "zone_id").otherwise(" team "))
    new_value = (F.when(grp == 0, F.concat(F.lit("fw-2."), (key % 9).cast("string")))
                 .when(grp == 1, (key % 25).cast("string"))
                 .otherwise(F.col("o_orderpriority")))
    return o.select(
        key.cast("string").alias("change_id"),
        F.col("o_custkey").cast("string").alias("robot_id"),
        _changed_at(F.col("o_orderdate")).alias("changed_at"),
        raw_attr.alias("attribute"),
        F.when(key % 11 == 0, new_value).otherwise(F.lit("unknown")).alias("old_value"),
        new_value.alias("new_value"),
    )


ZONE_TYPES = ["STORAGE", "PICKING", "PACKING", "SHIPPING", "RECEIVING", "CHARGING", "MAINTENANCE", "STAGING"]


def zones_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones as they land: every column text, booleans as words."""
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    nk = F.col("n_nationkey")
    zt = F.element_at(F.array(*[F.lit(z) for z in ZONE_TYPES]), (nk % 8 + 1).cast("int"))
    charging = (F.when(nk % 5 == 0, "yes").when(nk % 5 == 1, "Y").when(nk % 5 == 2, " false")
                .when(nk % 5 == 3, "0").otherwise("maybe"))
    return n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
        nk.cast("string").alias("zone_id"),
        F.col("n_name").alias("zone_name"),
        F.col("r_name").alias("site"),
        F.lower(zt).alias("zone_type"),
        (nk.cast("double") * F.lit(150.0) + F.lit(500.0)).cast("string").alias("floor_area_sqm"),
        (nk % 7 + 3).cast("string").alias("max_robots"),
        charging.alias("has_charging"),
    )


def robot_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("string").alias("model_id"),
        F.col("p_name").alias("model_name"),
        F.col("p_brand").alias("manufacturer"),
        (F.col("p_size").cast("double") * F.lit(10.0)).alias("max_payload_kg"),
        F.col("p_retailprice").alias("battery_capacity_wh"),
        (F.col("p_size").cast("double") * F.lit(4.0) + F.lit(100.0)).alias("weight_kg"),
        ((F.col("p_partkey") % 5).cast("double") * F.lit(0.5) + F.lit(1.0)).alias("max_speed_mps"),
        (F.col("p_retailprice") / F.lit(10000.0)).alias("wear_rate"),
        F.col("p_type").alias("sensor_suite"),
    )


TASK_TYPES = ["PICK", "PUT", "MOVE", "INSPECT", "CHARGE", "IDLE", "dance"]


def _order_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: first/last ship date, quantity and return counts (partial+final hash agg)."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.groupBy("l_orderkey").agg(
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
        F.sum("l_quantity").alias("qty"),
        F.count_if(F.col("l_returnflag") == "R").alias("n_returned"),
    )


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    lc = _order_lifecycle(spark, sf_dir)
    key = F.col("o_orderkey")
    ttype = F.element_at(F.array(*[F.lit(t) for t in TASK_TYPES]), (key % 7 + 1).cast("int"))
    status = (F.when(F.col("o_orderstatus") == "F", "completed")
              .when(F.col("o_orderstatus") == "O", " in_progress")
              .otherwise("paused"))
    return o.join(lc, o.o_orderkey == lc.l_orderkey, "left").select(
        key.cast("string").alias("task_id"),
        F.col("o_custkey").cast("string").alias("robot_id"),
        ttype.alias("task_type"),
        status.alias("status"),
        F.substring("o_orderpriority", 1, 1).alias("priority"),
        F.col("o_orderdate").alias("assigned_ts"),
        F.col("first_ship").alias("started_ts"),
        F.when(F.col("o_orderstatus") != "O", F.col("last_ship")).alias("completed_ts"),
        (F.col("qty") * F.lit(3.0)).alias("distance_m"),
        F.col("qty").alias("payload_kg"),
        (F.col("o_custkey") % 25).cast("string").alias("source_zone_id"),
        (key % 25).cast("string").alias("destination_zone_id"),
        F.col("n_returned").alias("error_count"),
    )


FAILURE_TYPES = ["MOTOR", "BATTERY", "SENSOR", "WHEEL", "NAVIGATION", "COMMS", "SOFTWARE"]
SEVERITIES = ["CRITICAL", "HIGH", "MEDIUM", "LOW"]


def maintenance_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticket lifecycle: reported (order date) -> diagnosed / parts / repaired / closed."""
    o = read_table(spark, sf_dir, "orders")
    lc = _order_lifecycle(spark, sf_dir)
    key = F.col("o_orderkey")
    ftype = F.element_at(F.array(*[F.lit(t) for t in FAILURE_TYPES]), (key % 7 + 1).cast("int"))
    sev = F.element_at(F.array(*[F.lit(s) for s in SEVERITIES]), (key % 4 + 1).cast("int"))
    done = F.col("o_orderstatus") == "F"
    return o.join(lc, o.o_orderkey == lc.l_orderkey, "left").select(
        key.cast("string").alias("ticket_id"),
        F.col("o_custkey").cast("string").alias("robot_id"),
        ftype.alias("failure_type"),
        sev.alias("severity"),
        F.col("o_orderdate").alias("reported_ts"),
        F.col("first_ship").alias("diagnosed_ts"),
        F.when(F.col("o_orderstatus") != "P", F.timestamp_add("DAY", F.lit(1), F.col("first_ship"))).alias("parts_ordered_ts"),
        F.when(done, F.col("last_ship")).alias("repaired_ts"),
        F.when(done, F.timestamp_add("DAY", F.lit(2), F.col("last_ship"))).alias("closed_ts"),
        F.col("o_orderpriority").alias("root_cause"),
        (F.col("o_totalprice") / F.lit(100.0)).alias("cost_usd"),
        (F.col("qty") * F.lit(1.5)).alias("downtime_hours"),
    )


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream-landing telemetry: unix-second timestamps plus year/month/day/hour partitions."""
    e = read_table(spark, sf_dir, "events")
    k = _k(F.col("props"))
    m = reading_measures(k, F.col("value"), F.col("event_id"))
    return e.select(
        F.col("user_id").cast("string").alias("robotid"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp"),
        m["motor_temp_c"].alias("motortemp"),
        m["battery_voltage_v"].alias("batteryvoltage"),
        m["vibration_g"].alias("vibration"),
        F.year("ts").alias("year"), F.month("ts").alias("month"),
        F.dayofmonth("ts").alias("day"), F.hour("ts").alias("hour"),
    )


def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failure events: error readings with a large value, one row per robot-day."""
    e = read_table(spark, sf_dir, "events")
    return (e.filter((F.col("event_type") == "error") & (F.col("value") > 100.0))
            .select(F.col("user_id").cast("string").alias("robot_id"),
                    F.to_date("ts").alias("failure_date"))
            .distinct())
