"""Registered queries: ingestion, sinks, partitioned scans, staging cleaners, web and geo jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetra.functions import columns as C
from telemetra.plans import fixtures as fx
from telemetra.plans import lake, models
from telemetra.plans.catalog import query
from telemetra.plans.models import Warehouse
from telemetra.plans.oracle import sql
from telemetra.session import scratch_path
from telemetra.sources import ingest as I
from telemetra.sources.tables import TABLES, read_table

LOAD_TIME = "2024-02-01 00:00:00"

# ---- ingestion ------------------------------------------------------------------------------------

# messy header -> cleaned: O_ORDERKEY, O_CUSTKEY, STATUS, COL_1PRICE, ORDER_DATE, COL_5, PRIORITY, PRIORITY_2
_MESSY = [("o_orderkey", " o orderkey"), ("o_custkey", "o-custkey"), ("o_orderstatus", "  status "),
          ("o_totalprice", "1price"), ("o_orderdate", "order date!"), ("_blank", "@@"),
          ("o_orderpriority", "priority"), ("_dup", "Priority ")]

_TOKENS = ["", "NULL", "null", "N/A", "NA", "nan", "None", "-", "#N/A", "n/a", "NaN", "ok"]


def _token_expr_spark():
    key = F.col("o_orderkey")
    arr = F.array(*[F.lit(t) for t in _TOKENS])
    return F.element_at(arr, (key % len(_TOKENS) + 1).cast("int"))


def _token_sql() -> str:
    lst = ", ".join("'" + t + "'" for t in _TOKENS)
    return f"[{lst}][o_orderkey % {len(_TOKENS)} + 1]"


_NULLED = ("CASE WHEN {x} IN ('', 'NULL', 'null', 'N/A', 'NA', 'nan', 'None', '-', '#N/A') "
           "THEN NULL ELSE {x} END")


@query("ingest_csv_raw", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS O_ORDERKEY, CAST(o_custkey AS VARCHAR) AS O_CUSTKEY, o_orderstatus AS STATUS,
  CAST(o_totalprice AS VARCHAR) AS COL_1PRICE, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ORDER_DATE,
  {_NULLED.format(x=_token_sql())} AS COL_5, o_orderpriority AS PRIORITY,
  CASE WHEN o_orderkey % 2 = 0 THEN lower(o_orderpriority) END AS PRIORITY_2
FROM orders""")
def ingest_csv_raw(spark, sf):
    """Orders written as CSV under a messy header, loaded back as an all-text raw table."""
    o = read_table(spark, sf, "orders")
    src = o.select(*[(F.col(c) if c not in ("_blank", "_dup") else
                      (_token_expr_spark() if c == "_blank" else
                       F.when(F.col("o_orderkey") % 2 == 0, F.lower("o_orderpriority")))).alias(h)
                     for c, h in _MESSY])
    path = scratch_path(spark, "orders_raw_csv")
    I.write_csv(src, path)
    raw = I.read_csv_raw(spark, path, loaded_at=LOAD_TIME)
    return raw.drop(I.LOADED_AT, I.SOURCE_FILE)


@query("ingest_null_tokens", f"SELECT o_orderkey, {_NULLED.format(x=_token_sql())} AS token_clean FROM orders")
def ingest_null_tokens(spark, sf):
    """The loader's null tokens, exactly as written -> NULL across the text columns."""
    o = read_table(spark, sf, "orders").select("o_orderkey", _token_expr_spark().alias("token_clean"))
    return I.apply_null_tokens(o)


@query("raw_load_reconcile", f"""
WITH found AS ({" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES)}),
lines AS (SELECT count(*) AS n, count(DISTINCT l_orderkey) AS orders FROM lineitem),
want AS (SELECT 'region' AS table_name, CAST(5 AS BIGINT) AS expected_rows UNION ALL SELECT 'nation', 25
  UNION ALL SELECT 'lineitem', n FROM lines UNION ALL SELECT 'orders', orders FROM lines UNION ALL SELECT 'returns', 0)
SELECT table_name, expected_rows, row_count, row_count - expected_rows AS difference,
  CASE WHEN row_count IS NULL THEN 'MISSING' WHEN expected_rows IS NULL THEN 'UNEXPECTED' WHEN row_count = expected_rows THEN 'MATCH'
    WHEN row_count < expected_rows THEN 'SHORT' ELSE 'EXCESS' END AS status
FROM found FULL JOIN want USING (table_name)""")
def raw_load_reconcile(spark, sf):
    """Rows of every loaded table against what its delivery promises: fixed counts of the small tables, line items as counted in their
    own table, one order per order number that lines name, and a table that was never delivered."""
    lines = read_table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("l_orderkey").alias("orders"))
    want = lines.select(F.explode(F.array(*[F.struct(F.lit(t).alias("table_name"), n.cast("bigint").alias("expected_rows")) for t, n in (
        ("region", F.lit(5)), ("nation", F.lit(25)), ("lineitem", F.col("n")), ("orders", F.col("orders")), ("returns", F.lit(0)))])).alias("r")).select("r.*")
    return I.reconcile({t: read_table(spark, sf, t) for t in TABLES}, want)


_RDQ_SCHEMA = ("robot_id string, reading_date date, reading_count bigint, avg_battery_voltage_v double, "
               "avg_battery_soc_pct double, min_battery_soc_pct double, avg_battery_temp_c double, "
               "avg_motor_temp_c double, max_motor_temp_c double, avg_motor_rpm double, avg_motor_load_pct double, "
               "avg_vibration_g double, max_vibration_g double, max_odometer_m double, bad_soc_count bigint, "
               "bad_motor_temp_count bigint, bad_vibration_count bigint, bad_odometer_count bigint")


def _rdq_oracle() -> str:
    from telemetra.plans.q_models import _RDQ
    return sql(_RDQ, "cleaned_values")


@query("sink_csv_daily", _rdq_oracle())
def sink_csv_daily(spark, sf):
    """Robot-day quality table written as CSV by the executors, read back with its schema."""
    daily = lake.robot_daily_quality(lake.null_out(lake.quality_flags(
        lake.flatten_readings(fx.nested_readings(spark, sf)))))
    path = scratch_path(spark, "robot_daily_quality_csv")
    I.write_csv(daily, path)
    return spark.read.schema(_RDQ_SCHEMA).option("header", True).csv(path)


@query("sink_parquet_table", sql("SELECT * FROM fct_robot_daily", "fct_robot_daily"))
def sink_parquet_table(spark, sf):
    """Daily fact materialised as date-partitioned parquet and read back."""
    daily = Warehouse(spark, sf).fct_robot_daily
    path = scratch_path(spark, "fct_robot_daily")
    I.write_table(daily, path, partition_by=["report_date"])
    back = I.read_partitioned(spark, path)
    return back.select(*[F.col(c).cast("date") if c == "report_date" else F.col(c) for c in daily.columns])


@query("scan_hive_partitioned", sql("SELECT * FROM telemetry WHERE day = 15", "telemetry"))
def scan_hive_partitioned(spark, sf):
    """Telemetry landed under year/month/day/hour folders; a filter on day prunes folders."""
    t = fx.telemetry(spark, sf)
    path = scratch_path(spark, "telemetry_landing")
    I.write_table(t, path, partition_by=["year", "month", "day", "hour"])
    back = I.read_partitioned(spark, path).filter(F.col("day") == 15)
    return back.select(*t.columns)


@query("union_tables_by_pattern", """
SELECT *, 'events_' || strftime(CAST(ts AS DATE), '%Y%m%d') AS _source_table FROM events
WHERE strftime(CAST(ts AS DATE), '%Y%m%d') <> '20240115'""")
def union_tables_by_pattern(spark, sf):
    """Daily slices landed as day-partitioned parquet and registered as one view per day; then
    every view matching events_2024% except one day, unioned by name. Each view reads only its
    own partition folder, so the union reads the data once."""
    e = read_table(spark, sf, "events")
    path = scratch_path(spark, "events_by_day")
    I.write_table(e.withColumn("day", F.date_format("ts", "yyyyMMdd")), path, partition_by=["day"])
    landed = I.read_partitioned(spark, path)
    days = [r[0] for r in landed.select("day").distinct().collect()]  # partition values only
    for d in days:
        landed.filter(F.col("day") == d).drop("day").createOrReplaceTempView(f"events_{d}")
    try:
        out = I.union_tables_by_pattern(spark, "events_2024%", exclude="events_20240115")
    finally:  # the union keeps its plan; the views must not leak into the next call's pattern
        for d in days:
            spark.catalog.dropTempView(f"events_{d}")
    return out.select(*e.columns, "_source_table")


@query("union_folders_by_pattern", """
SELECT *, 'raw_' || event_type || '.events_' || strftime(CAST(ts AS DATE), '%Y%m%d') AS _source_table FROM events
WHERE event_type LIKE '%e%' AND strftime(CAST(ts AS DATE), '%Y%m%d') <> '20240115'""")
def union_folders_by_pattern(spark, sf):
    """Events landed as one schema per event type and one table per day; then the tables of every schema whose type has an e and
    of every day except one, as one scan over the matching folders."""
    e = read_table(spark, sf, "events")
    path = scratch_path(spark, "events_by_type_and_day")
    I.write_table(e.withColumns({"schema": F.concat(F.lit("raw_"), "event_type"),
                                 "table": F.concat(F.lit("events_"), F.date_format("ts", "yyyyMMdd"))}),
                  path, partition_by=["schema", "table"])
    return I.union_folders_by_pattern(spark, path, "raw_%e%", "events_2024%", "events_20240115").select(*e.columns, "_source_table")


# ---- staging cleaners -------------------------------------------------------------------------------

_PADDED = "CASE o_orderkey % 3 WHEN 0 THEN '  ' || o_orderpriority || '  ' WHEN 1 THEN '' ELSE '   ' END"


@query("stg_trim_nullif", f"SELECT o_orderkey, nullif(trim({_PADDED}), '') AS priority FROM orders")
def stg_trim_nullif(spark, sf):
    k = F.col("o_orderkey")
    padded = (F.when(k % 3 == 0, F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit("  ")))
              .when(k % 3 == 1, F.lit("")).otherwise(F.lit("   ")))
    return read_table(spark, sf, "orders").select("o_orderkey", C.trim_nullif(padded).alias("priority"))


@query("stg_upper_enum", sql("SELECT task_id, task_type, status FROM stg_tasks", "stg_tasks"))
def stg_upper_enum(spark, sf):
    return Warehouse(spark, sf).stg_tasks.select("task_id", "task_type", "status")


_NUMTXT = ("CASE o_orderkey % 4 WHEN 0 THEN CAST(o_totalprice AS VARCHAR) WHEN 1 THEN 'abc' "
           "WHEN 2 THEN CAST(o_orderkey % 10 AS VARCHAR) || '.7' ELSE '' END")


@query("stg_safe_cast", f"""
SELECT o_orderkey, TRY_CAST({_NUMTXT} AS DOUBLE) AS as_double,
  CAST(round(TRY_CAST({_NUMTXT} AS DECIMAL(38, 9)), 0) AS BIGINT) AS as_number FROM orders""")
def stg_safe_cast(spark, sf):
    """Text -> double / integer; bad text -> NULL; '1.7' rounds to 2."""
    k = F.col("o_orderkey")
    txt = (F.when(k % 4 == 0, F.col("o_totalprice").cast("string")).when(k % 4 == 1, F.lit("abc"))
           .when(k % 4 == 2, F.concat((k % 10).cast("string"), F.lit(".7"))).otherwise(F.lit("")))
    return read_table(spark, sf, "orders").select("o_orderkey", C.safe_double(txt).alias("as_double"),
                                                  C.safe_number(txt).alias("as_number"))


_DATETXT = ("CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN 'not a date' "
            "ELSE '2024-02-30' END")


@query("stg_safe_date", f"SELECT o_orderkey, TRY_CAST({_DATETXT} AS DATE) AS order_day FROM orders")
def stg_safe_date(spark, sf):
    k = F.col("o_orderkey")
    txt = (F.when(k % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k % 3 == 1, F.lit("not a date"))
           .otherwise(F.lit("2024-02-30")))
    return read_table(spark, sf, "orders").select("o_orderkey", C.safe_date(txt).alias("order_day"))


_TS = "o_orderdate + to_hours(o_orderkey % 24) + to_minutes(o_orderkey % 60)"
_TSTXT = (f"CASE o_orderkey % 5 WHEN 0 THEN strftime({_TS}, '%Y-%m-%d %H:%M:%S') "
          f"WHEN 1 THEN strftime({_TS}, '%m/%d/%Y %H:%M:%S') WHEN 2 THEN strftime({_TS}, '%m/%d/%Y %I:%M:%S %p') "
          f"WHEN 3 THEN strftime({_TS}, '%Y-%m-%dT%H:%M:%S') "
          f"ELSE CASE WHEN o_orderkey % 2 = 0 THEN CAST(1700000000 + o_orderkey AS VARCHAR) ELSE 'yesterday' END END")
_TSPARSE = ("coalesce(TRY_CAST(raw AS TIMESTAMP), try_strptime(raw, '%m/%d/%Y %H:%M:%S'), "
            "try_strptime(raw, '%m/%d/%Y %I:%M:%S %p'), try_strptime(raw, '%Y-%m-%d %H:%M:%S'), "
            "try_strptime(raw, '%Y-%m-%dT%H:%M:%S'), "
            "CASE WHEN regexp_full_match(trim(raw), '[0-9]{9,11}') THEN make_timestamp(TRY_CAST(trim(raw) AS BIGINT) * 1000000) END)")


@query("stg_multi_format_ts", f"""
SELECT o_orderkey, raw, {_TSPARSE} AS parsed_ts, coalesce(raw IS NOT NULL AND {_TSPARSE} IS NULL, false) AS is_parse_failed
FROM (SELECT o_orderkey, {_TSTXT} AS raw FROM orders)""")
def stg_multi_format_ts(spark, sf):
    """Timestamps rendered in four layouts, as Unix seconds, or unparseable,  parsed by an ordered coalesce."""
    k = F.col("o_orderkey")
    ts = F.timestamp_add("MINUTE", k % 60, F.timestamp_add("HOUR", k % 24, F.col("o_orderdate")))
    raw = (F.when(k % 5 == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
           .when(k % 5 == 1, F.date_format(ts, "MM/dd/yyyy HH:mm:ss"))
           .when(k % 5 == 2, F.date_format(ts, "MM/dd/yyyy hh:mm:ss a"))
           .when(k % 5 == 3, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
           .otherwise(F.when(k % 2 == 0, (F.lit(1_700_000_000) + k).cast("string")).otherwise(F.lit("yesterday"))))
    df = read_table(spark, sf, "orders").select("o_orderkey", raw.alias("raw"))
    parsed = C.parse_ts("raw", C.TS_FORMATS_WITH_T)
    return df.select("o_orderkey", "raw", parsed.alias("parsed_ts"), C.parse_failed("raw", parsed).alias("is_parse_failed"))


_WORDS = ["true", "TRUE", " yes ", "Y", "1", "false", "No", "n", "0", "maybe"]


@query("stg_bool_words", "SELECT o_orderkey, CASE WHEN lower(trim(w)) IN ('true', '1', 'yes', 'y') THEN true "
                         "WHEN lower(trim(w)) IN ('false', '0', 'no', 'n') THEN false END AS flag FROM "
                         "(SELECT o_orderkey, [" + ", ".join(f"'{w}'" for w in _WORDS) + f"][o_orderkey % {len(_WORDS)} + 1]"
                         " AS w FROM orders)")
def stg_bool_words(spark, sf):
    w = F.element_at(F.array(*[F.lit(x) for x in _WORDS]), (F.col("o_orderkey") % len(_WORDS) + 1).cast("int"))
    return read_table(spark, sf, "orders").select("o_orderkey", C.bool_words(w).alias("flag"))


@query("stg_enum_canonical", sql("SELECT change_id, attribute FROM stg_changes", "stg_changes"))
def stg_enum_canonical(spark, sf):
    """Attribute synonyms -> FIRMWARE / ZONE / TEAM."""
    return Warehouse(spark, sf).stg_changes.select("change_id", "attribute")


@query("stg_range_null_out", sql("SELECT reading_id, battery_soc_pct, is_battery_soc_invalid, odometer_m, "
                                 "is_odometer_invalid FROM stg_readings", "stg_readings"))
def stg_range_null_out(spark, sf):
    return Warehouse(spark, sf).stg_readings.select("reading_id", "battery_soc_pct", "is_battery_soc_invalid",
                                                    "odometer_m", "is_odometer_invalid")


@query("stg_threshold_flags", sql("SELECT reading_id, is_battery_temp_suspicious, is_motor_temp_suspicious "
                                  "FROM stg_readings", "stg_readings"))
def stg_threshold_flags(spark, sf):
    return Warehouse(spark, sf).stg_readings.select("reading_id", "is_battery_temp_suspicious",
                                                    "is_motor_temp_suspicious")


@query("stg_task_flags", sql("SELECT * FROM stg_tasks", "stg_tasks"))
def stg_task_flags(spark, sf):
    """Typed tasks with missing-id, invalid type/status and lifecycle flags."""
    return Warehouse(spark, sf).stg_tasks


@query("stg_sensor_readings", sql("SELECT * FROM stg_readings", "stg_readings"))
def stg_sensor_readings(spark, sf):
    return Warehouse(spark, sf).stg_readings.drop("reading_ts_raw")


def _placeholder_sql() -> str:
    from telemetra.plans.q_models import _MAINT
    cols = ["maintenance_sk", "ticket_id", "robot_id", "failure_type", "severity", "reported_ts", "diagnosed_ts",
            "parts_ordered_ts", "repaired_ts", "closed_ts"]
    keys = ["reported_date_key", "diagnosed_date_key", "repaired_date_key", "closed_date_key"]
    sel = cols + [f"CAST({k} AS BIGINT) AS {k}" for k in keys] + ["root_cause", "cost_usd", "downtime_hours"]
    return f"SELECT {', '.join(sel)} FROM ({_MAINT})"


@query("fct_maintenance_placeholder", _placeholder_sql())
def fct_maintenance_placeholder(spark, sf):
    """The built maintenance snapshot in the warehouse placeholder's columns and types."""
    return models.as_placeholder_schema(models.fct_maintenance(fx.maintenance_tickets(spark, sf)))


# ---- web ------------------------------------------------------------------------------------------

_HOST = ("split_part(split_part(replace(replace(replace(url, 'android-app://', ''), 'http://', ''), 'https://', ''), "
         "'/', 1), '?', 1)")
_STRIP = "replace(replace(url, 'http://', ''), 'https://', '')"
_PATH = (f"split_part(right({_STRIP}, length({_STRIP}) - coalesce(nullif(instr({_STRIP}, '/'), 0), "
         f"instr({_STRIP}, '?') - 1)), '?', 1)")


@query("web_host_rollup", f"SELECT {_HOST} AS host, count(*) AS n_pages FROM pages GROUP BY 1")
def web_host_rollup(spark, sf):
    """Pages per URL host."""
    return (read_table(spark, sf, "pages").groupBy(C.url_host("url").alias("host"))
            .agg(F.count(F.lit(1)).alias("n_pages")))


@query("web_path_rollup", f"SELECT page_id, {_PATH} AS path FROM pages")
def web_path_rollup(spark, sf):
    return read_table(spark, sf, "pages").select("page_id", C.url_path("url").alias("path"))


@query("web_param_rollup", """
SELECT utm_source, page, count(*) AS n_pages FROM (
  SELECT nullif(split_part(split_part(url, 'utm_source=', 2), '&', 1), '') AS utm_source,
         nullif(split_part(split_part(url, 'page=', 2), '&', 1), '') AS page FROM pages) GROUP BY 1, 2""")
def web_param_rollup(spark, sf):
    """Pages per (utm_source, page) query-parameter values."""
    p = read_table(spark, sf, "pages")
    return (p.groupBy(C.url_parameter("url", "utm_source").alias("utm_source"),
                      C.url_parameter("url", "page").alias("page"))
            .agg(F.count(F.lit(1)).alias("n_pages")))


# ---- geo ------------------------------------------------------------------------------------------

def _lat(nk):
    return (nk * 37 % 150).cast("double") - F.lit(75.0)


def _lon(nk):
    return (nk * 53 % 340).cast("double") - F.lit(170.0)


_HAV = ("2 * 3961 * asin(sqrt(power(sin(radians((lat2 - lat1) / 2)), 2) + cos(radians(lat1)) * cos(radians(lat2)) "
        "* power(sin(radians((lon2 - lon1) / 2)), 2))) * 1.60934")


@query("geo_nearest_pairs", f"""
SELECT l_orderkey, CAST(floor(max(d)) AS BIGINT) AS max_leg_km, count(*) AS n_lines FROM (
  SELECT l.l_orderkey, {_HAV} AS d FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN (SELECT c_custkey, CAST(c_nationkey * 37 % 150 AS DOUBLE) - 75.0 AS lat2,
               CAST(c_nationkey * 53 % 340 AS DOUBLE) - 170.0 AS lon2 FROM customer) c ON o.o_custkey = c.c_custkey
  JOIN (SELECT s_suppkey, CAST(s_nationkey * 37 % 150 AS DOUBLE) - 75.0 AS lat1,
               CAST(s_nationkey * 53 % 340 AS DOUBLE) - 170.0 AS lon1 FROM supplier) s ON l.l_suppkey = s.s_suppkey)
GROUP BY l_orderkey""")
def geo_nearest_pairs(spark, sf):
    """Haversine km from supplier zone to customer zone per line; longest leg per order.

    Distances are computed along existing relations (equi-joins), never over all pairs."""
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey")
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = read_table(spark, sf, "customer").select("c_custkey", _lat(F.col("c_nationkey")).alias("lat2"),
                                                 _lon(F.col("c_nationkey")).alias("lon2"))
    s = read_table(spark, sf, "supplier").select("s_suppkey", _lat(F.col("s_nationkey")).alias("lat1"),
                                                 _lon(F.col("s_nationkey")).alias("lon1"))
    j = (li.join(o, li.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == c.c_custkey)
         .join(s, F.col("l_suppkey") == s.s_suppkey))
    d = j.select("l_orderkey", C.haversine("lat1", "lon1", "lat2", "lon2", unit="km").alias("d"))
    return d.groupBy("l_orderkey").agg(F.floor(F.max("d")).cast("bigint").alias("max_leg_km"),
                                       F.count(F.lit(1)).alias("n_lines"))
