"""Registered queries: Structured Streaming jobs, each drained with an availableNow trigger and
read back from its sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetra.plans import fixtures as fx
from telemetra.plans.catalog import query
from telemetra.plans.oracle import sql
from telemetra.session import scratch_path
from telemetra.sources.tables import read_table
from telemetra.streaming import streams as S

EVENT_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
TELEMETRY_SCHEMA = ("robotid STRING, timestamp BIGINT, motortemp DOUBLE, batteryvoltage DOUBLE, vibration DOUBLE, "
                    "year INT, month INT, day INT, hour INT")


@query("stream_land_partitioned", """
SELECT *, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
  CAST(hour(ts) AS INTEGER) AS hour FROM events""")
def stream_land_partitioned(spark, sf):
    """Event stream landed as parquet under year/month/day/hour folders."""
    inbound, sink, ck = (scratch_path(spark, n) for n in ("events_inbound", "events_landed", "ck_land"))
    S.write_inbound_json(read_table(spark, sf, "events"), inbound)
    S.land_partitioned(S.read_json_stream(spark, inbound, EVENT_SCHEMA), "ts", sink, ck)
    back = spark.read.parquet(sink)
    return back.select("event_id", "ts", "user_id", "event_type", "value", "props", "year", "month", "day", "hour")


@query("stream_bad_record_split", """
SELECT event_id, ts, user_id, event_type, value, props, true AS good FROM events WHERE event_id % 50 NOT IN (0, 1)
UNION ALL SELECT event_id, NULL, NULL, NULL, NULL, NULL, false FROM events WHERE event_id % 50 IN (0, 1)""")
def stream_bad_record_split(spark, sf):
    """Malformed records (every 50th line loses its closing brace) go to an error folder with
    the raw line, and so does a record whose time is no time; the rest land. Both folders are returned
    (of the bad lines the id that stands in them)."""
    inbound, good, bad, ck = (scratch_path(spark, n) for n in ("lines_inbound", "good", "bad", "ck_split"))
    e = read_table(spark, sf, "events")
    js = F.to_json(F.struct(*e.columns), {"timestampNTZFormat": S.TS_FORMAT})
    lines = e.select(F.when(F.col("event_id") % 50 == 0, F.regexp_replace(js, "}$", ""))
                     .when(F.col("event_id") % 50 == 1, F.regexp_replace(js, r'"ts":"[^"]*"', '"ts":"not a time"'))
                     .otherwise(js).alias("value"))
    S.write_inbound_lines(lines, inbound)
    S.split_bad_records(spark, inbound, EVENT_SCHEMA, good, bad, ck, key="event_id")
    lost = spark.read.parquet(bad).select(F.regexp_extract("raw_record", r'"event_id":(\d+)', 1).cast("bigint").alias("event_id"))
    return (spark.read.parquet(good).select(*e.columns, F.lit(True).alias("good"))
            .unionByName(lost.withColumn("good", F.lit(False)), allowMissingColumns=True))


_HELD = "event_id % 100 = 7"


@query("stream_dedup", f"""
SELECT *, {_HELD} AND ts < (SELECT max(ts) FROM events WHERE NOT ({_HELD})) - INTERVAL 48 HOUR AS late FROM events""")
def stream_dedup(spark, sf):
    """Every event once: every 20th is re-sent in a later delivery and dropped, every 100th is first delivered there and, if more than 48 h
    older than the latest event so far, lands in the late table (``late``). The first delivery is one micro-batch
    (its file count caps the trigger)."""
    inbound, sink, late, progress, ck = (scratch_path(spark, n) for n in ("dup_inbound", "dedup", "dedup_late", "dedup_progress", "ck_dedup"))
    e = read_table(spark, sf, "events")
    n_first = S.write_inbound_json_counted(spark, e.filter(f"NOT ({_HELD})"), inbound)
    S.write_inbound_json(e.filter(f"event_id % 20 = 0 OR {_HELD}"), inbound)
    stream = S.read_json_stream(spark, inbound, EVENT_SCHEMA, max_files_per_trigger=n_first)
    S.land_first_copies(stream, ["event_id"], "ts", sink, late, progress, ck)
    return (S.landed(spark, sink, stream.schema).withColumn("late", F.lit(False))
            .unionByName(S.landed(spark, late, stream.schema).withColumn("late", F.lit(True))))


_TEL_HELD = "timestamp % 11 = 3"


def _health_log(spark, sf):
    """The daily health log of two deliveries: every eleventh second's records come in the second one. A snapshot
    follows every second batch, so the state is read from snapshot and deltas."""
    inbound, log, ck = (scratch_path(spark, n) for n in ("tel_inbound", "health_log", "ck_health"))
    t = fx.telemetry(spark, sf)
    n_first = S.write_inbound_json_counted(spark, t.filter(f"NOT ({_TEL_HELD})"), inbound)
    S.write_inbound_json(t.filter(_TEL_HELD), inbound)
    st = S.read_json_stream(spark, inbound, TELEMETRY_SCHEMA, max_files_per_trigger=n_first).withColumn(
        "event_timestamp", F.timestamp_seconds("timestamp").cast("timestamp_ntz"))
    log = S.daily_health_deltas(st, "robotid", "event_timestamp", log, ck, compact_every=2)
    return log.current()


@query("stream_daily_health", sql("SELECT * FROM health_daily", "health_daily"))
def stream_daily_health(spark, sf):
    """Incremental robot-day health (deltas per micro-batch, merged into snapshots) equals the batch mart."""
    return _health_log(spark, sf).select(
        "robotid", "summary_date", "event_count",
        (F.col("sum_motor_temp") / F.col("n_motor_temp")).alias("avg_motor_temp"), "max_motor_temp",
        (F.col("sum_battery_voltage") / F.col("n_battery_voltage")).alias("avg_battery_voltage"),
        "min_battery_voltage", "max_vibration")


_TEL_HELD_SQL = "CAST(epoch(event_timestamp) AS BIGINT) % 11 = 3"


@query("stream_health_late_rows", sql(f"""
SELECT CAST(event_timestamp AS DATE) AS summary_date, count(*) AS event_count,
  count_if({_TEL_HELD_SQL} AND event_timestamp < (SELECT max(event_timestamp) FROM stg_telemetry WHERE NOT ({_TEL_HELD_SQL}))
           - INTERVAL 48 HOUR) AS late_rows
FROM stg_telemetry GROUP BY 1""", "stg_telemetry"))
def stream_health_late_rows(spark, sf):
    """Records a day, and how many of them came more than 48 h behind the latest record so far: counted, not dropped."""
    return (_health_log(spark, sf).groupBy("summary_date")
            .agg(F.sum("event_count").alias("event_count"), F.sum("late_rows").alias("late_rows")))


_LATE = ("SELECT event_id + 10000000000 AS event_id, ts - to_hours(event_id % 46 + 1) AS ts "
         "FROM events WHERE event_id % 10 = 0")


@query("stream_late_audit", f"""
SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS rows, CAST(0 AS BIGINT) AS late_rows, max(ts) AS batch_max_ts
FROM events
UNION ALL
SELECT 1, count(*), count_if(ts < (SELECT max(ts) FROM events) - INTERVAL 1 HOUR), max(ts) FROM ({_LATE})""")
def stream_late_audit(spark, sf):
    """Late arrivals per micro-batch: all events arrive first, then every 10th event is re-sent
    1..46 hours older; rows older than the previous batches' latest event time minus 1 hour
    count as late."""
    inbound, audit, ck = (scratch_path(spark, n) for n in ("late_inbound", "late_audit", "ck_late"))
    e = read_table(spark, sf, "events")
    n_first = S.write_inbound_json_counted(spark, e, inbound)
    late = e.filter(F.col("event_id") % 10 == 0).withColumns({
        "event_id": F.col("event_id") + F.lit(10_000_000_000),
        "ts": F.timestamp_add("HOUR", -(F.col("event_id") % 46 + 1), F.col("ts"))})
    S.write_inbound_json(late, inbound)
    S.late_rows_audit(S.read_json_stream(spark, inbound, EVENT_SCHEMA, max_files_per_trigger=n_first),
                      "ts", audit, ck, lateness_seconds=3600)
    return S.read_audit(spark.read.parquet(audit))
