"""CSV landing, sinks and stream helpers on small literal inputs."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from telemetra.session import scratch_path
from telemetra.sources import ingest as I
from telemetra.streaming import streams as S

CSV = """ reading id,soc-%,,Reading_ID,status
R1,55.5,x,dup1,active
R2,N/A,y
R3,nan,z,dup3,IDLE,extra
  ,-,,,#N/A
"""


def test_read_csv_raw(spark):
    path = scratch_path(spark, "raw_csv")
    os.makedirs(path)
    with open(os.path.join(path, "part-0.csv"), "w") as f:
        f.write(CSV)
    df = I.read_csv_raw(spark, path, loaded_at="2024-02-01 00:00:00")
    assert df.columns == ["READING_ID", "SOC", "COL_2", "READING_ID_2", "STATUS", "_LOADED_AT", "_SOURCE_FILE"]
    rows = {r.READING_ID: r for r in df.collect()}
    assert len(rows) == 4                                   # short and long rows are kept
    assert rows["R1"].SOC == "55.5" and rows["R1"].STATUS == "active"
    assert rows["R2"].SOC is None and rows["R2"].STATUS is None   # token -> NULL, short row padded
    assert rows["R3"].SOC is None and rows["R3"].STATUS == "IDLE"  # extra field dropped
    blank = rows["  "]                                      # tokens are exact: white space is a text
    assert blank.SOC is None and blank.STATUS is None
    assert all(r._SOURCE_FILE.endswith("part-0.csv") for r in rows.values())
    assert all(r._LOADED_AT == dt.datetime(2024, 2, 1) for r in rows.values())


def test_partitioned_roundtrip_prunes(spark):
    df = spark.createDataFrame([(1, 2024, 1), (2, 2024, 2), (3, 2025, 1)], "v int, year int, month int")
    path = scratch_path(spark, "parts")
    I.write_table(df, path, partition_by=["year", "month"])
    back = I.read_partitioned(spark, path).filter(F.col("year") == 2024)
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and sorted(r.v for r in back.collect()) == [1, 2]


def test_union_tables_by_pattern(spark):
    spark.createDataFrame([(1, "a")], "id int, x string").createOrReplaceTempView("data_events_20180101")
    spark.createDataFrame([(2, 1.5)], "id int, y double").createOrReplaceTempView("data_events_20180102")
    spark.createDataFrame([(3, "c")], "id int, x string").createOrReplaceTempView("data_events_20180103")
    out = I.union_tables_by_pattern(spark, "data_events_2018%", exclude="%0103")
    assert sorted((r.id, r._source_table) for r in out.collect()) == [
        (1, "data_events_20180101"), (2, "data_events_20180102")]
    assert set(out.columns) == {"id", "x", "y", "_source_table"}


def test_union_folders_by_pattern(spark, tmp_path):
    for schema, table, rows, cols in (("Web_eu", "ev_1", [(1, "a")], "id int, x string"), ("web_us", "EV_2", [(2, 1.5)], "id int, y double"),
                                      ("web_us", "ev_skip", [(3, "c")], "id int, x string"), ("shop", "ev_4", [(4, "d")], "id int, x string"),
                                      ("schema=web_k", "table=ev_5", [(5, "e")], "id int, x string"), ("web_us", "other", [(6, "f")], "id int, x string")):
        spark.createDataFrame(rows, cols).coalesce(1).write.parquet(f"{tmp_path}/{schema}/{table}")
    out = I.union_folders_by_pattern(spark, str(tmp_path), "WEB%", "ev%", exclude="%SKIP")
    assert sorted((r.id, r.x, r.y, r._source_table) for r in out.collect()) == [
        (1, "a", None, "Web_eu.ev_1"), (2, None, 1.5, "web_us.EV_2"), (5, "e", None, "web_k.ev_5")]
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    with pytest.raises(ValueError):
        I.union_folders_by_pattern(spark, str(tmp_path), "none%", "ev%")


def test_health_log_survives_replay_and_half_done_compaction(spark, tmp_path):
    """Every batch counts once whatever is replayed, a snapshot without its commit is not read, and the
    state after compaction equals the state without."""
    def partial(k, n, top):
        row = (k, dt.date(2024, 1, 1), n, 0, 2.0 * n, n, top, 1.0 * n, n, 1.0, None)
        return spark.createDataFrame([row], "robotid string, summary_date date, event_count long, late_rows long, sum_motor_temp double, n_motor_temp long, "
                                            "max_motor_temp double, sum_battery_voltage double, n_battery_voltage long, min_battery_voltage double, max_vibration double")

    def state(log):
        return sorted((r.robotid, r.event_count, r.max_motor_temp, r.max_vibration) for r in log.current().collect())

    log = S.HealthLog(spark, str(tmp_path / "log"), "robotid")
    assert log.current() is None
    log.compact(0)
    assert log.current() is None
    log.add(partial("a", 3, 5.0), 0)
    log.add(partial("a", 4, 9.0), 1)
    log.add(partial("b", 1, 7.0), 1)  # a replay of batch 1 overwrites it
    plain = state(log)
    assert plain == [("a", 3, 5.0, None), ("b", 1, 7.0, None)]
    log.compact(1)
    log.compact(1)
    assert state(log) == plain
    log.add(partial("b", 1, 8.0), 2)
    log.add(partial("c", 2, 1.0), 3)
    later = [("a", 3, 5.0, None), ("b", 2, 8.0, None), ("c", 2, 1.0, None)]
    assert state(log) == later
    partial("a", 1000, 1.0).write.parquet(f"{log.path}/snapshots/upto=3")  # died before its commit
    assert state(log) == later
    log.compact(3)
    assert state(log) == later
    plan = log.current()._jdf.queryExecution().executedPlan().toString()
    assert "upto=3" in str(log.current().inputFiles())
    assert "PartitionFilters: [isnotnull(batch_id" in plan  # earlier deltas are pruned


def test_latest_versions(spark):
    log = spark.createDataFrame([("k", 1, 10), ("k", 2, 20), ("j", 1, 5)], "key string, batch_id int, v int")
    got = {r.key: r.v for r in S.latest_versions(log, ["key"]).collect()}
    assert got == {"k": 20, "j": 5}


def test_stream_restart_processes_each_record_once(spark):
    inbound, good, bad, ck = (scratch_path(spark, n) for n in ("in", "good", "bad", "ck"))
    schema = "id BIGINT, v STRING"
    first = spark.createDataFrame([(i, f"v{i}") for i in range(50)], schema)
    S.write_inbound_lines(first.select(F.to_json(F.struct("id", "v")).alias("value")), inbound)
    S.split_bad_records(spark, inbound, schema, good, bad, ck, key="id")
    # a second delivery (with one malformed line), then a restart from the same checkpoint
    more = spark.createDataFrame([(i, f"v{i}") for i in range(50, 80)], schema)
    lines = more.select(F.to_json(F.struct("id", "v")).alias("value")).unionByName(
        spark.createDataFrame([("{broken",)], "value string"))
    S.write_inbound_lines(lines, inbound)
    S.split_bad_records(spark, inbound, schema, good, bad, ck, key="id")
    landed = spark.read.parquet(good)
    assert landed.count() == 80 and landed.select("id").distinct().count() == 80
    assert sorted(landed.select("batch_id").distinct().toPandas()["batch_id"]) == [0, 1]
    assert [r.raw_record for r in spark.read.parquet(bad).collect()] == ["{broken"]


def test_csv_landing_stages_like_typed_input(spark, sf_dir):
    from telemetra.plans import fixtures as fx
    from telemetra.plans import staging as stg
    typed = fx.readings(spark, sf_dir).drop("error_codes")
    path = scratch_path(spark, "readings_csv")
    I.write_csv(typed.select(*[F.col(c).cast("string").alias(c) for c in typed.columns]), path)
    raw = I.read_csv_raw(spark, path, loaded_at="2024-02-01 00:00:00")
    assert "READING_ID" in raw.columns and all(t == "string" for _, t in raw.dtypes[:-2])
    cols = ["reading_id", "robot_id", "reading_ts", "battery_soc_pct", "is_battery_soc_invalid", "motor_temp_c_raw",
            "odometer_m", "is_odometer_invalid", "operational_status", "zone_id", "is_reading_ts_parse_failed"]
    from_text = stg.stg_sensor_readings(raw).select(*cols)
    from_typed = stg.stg_sensor_readings(typed).select(*cols)
    assert from_text.count() == typed.count()
    assert from_text.exceptAll(from_typed).count() == 0 and from_typed.exceptAll(from_text).count() == 0


def test_csv_landing_other_staging(spark, sf_dir):
    from telemetra.plans import fixtures as fx
    from telemetra.plans import staging as stg
    cases = {"tasks": (fx.tasks, stg.stg_tasks), "robots": (fx.robots, stg.stg_robots),
             "changes": (fx.attribute_changes, stg.stg_robot_attribute_changes),
             "models": (fx.robot_models, stg.stg_robot_models)}
    for name, (source, stage) in cases.items():
        typed = source(spark, sf_dir)
        path = scratch_path(spark, f"{name}_csv")
        I.write_csv(typed.select(*[F.col(c).cast("string").alias(c) for c in typed.columns]), path)
        from_text = stage(I.read_csv_raw(spark, path, loaded_at="2024-02-01 00:00:00"))
        assert from_text.columns[-2:] == ["_loaded_at", "_source_file"]
        from_text, from_typed = from_text.drop("_loaded_at", "_source_file"), stage(typed)
        assert from_text.columns == from_typed.columns, name
        assert from_text.exceptAll(from_typed).count() == 0 and from_typed.exceptAll(from_text).count() == 0, name


def test_quoted_line_end_stays_one_record(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,note\n1,"line one\nline two"\n2,NA\n3,none\n')
    rows = I.read_csv_raw(spark, str(tmp_path)).orderBy("ID").collect()
    assert [(r.ID, r.NOTE) for r in rows] == [("1", "line one\nline two"), ("2", None), ("3", "none")]


@pytest.mark.parametrize("names", ["id,note", "id,,id"])
def test_other_header_is_an_error(spark, tmp_path, names):
    other = ",".join(reversed(names.split(","))) if names == "id,note" else "id,,other"
    (tmp_path / "a.csv").write_text(names + "\n" + ",".join("1" * (names.count(",") + 1)) + "\n")
    (tmp_path / "b.csv").write_text(other + "\n" + ",".join("1" * (names.count(",") + 1)) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        I.read_csv_raw(spark, str(tmp_path)).collect()


def test_landing_header_of_the_contract(spark, tmp_path):
    from telemetra.plans import models
    from telemetra.plans import staging as stg
    (tmp_path / "r.csv").write_text(
        "reading_id,robot_id,reading_ts,voltage_v,soc_pct,battery_temp_c,motor_temp_c,rpm,load_pct,vibration_g,odometer_m,"
        "operational_status,floor_condition,zone_id\n"
        "r1,b1,2024-01-02T03:04:05,48.1,120,30,60,900,55,0.2,10,active,dry,z1\n"
        "r2,b1,1704164645,48.2,80,30,60,901,56,0.2,-1,idle,dry,z1\n")
    staged = stg.stg_sensor_readings(I.read_csv_raw(spark, str(tmp_path), loaded_at="2024-02-01 00:00:00"))
    rows = {r.reading_id: r for r in staged.collect()}
    assert rows["r1"].battery_voltage_v == 48.1 and rows["r1"].battery_soc_pct is None and rows["r1"].is_battery_soc_invalid
    assert rows["r2"].motor_rpm == 901 and rows["r2"].motor_load_pct == 56 and rows["r2"].reading_ts == dt.datetime(2024, 1, 2, 3, 4, 5)
    dims = [spark.createDataFrame([], t) for t in ("robot_id string, robot_sk string, valid_from timestamp_ntz, valid_to timestamp_ntz",
                                                   "zone_id string, zone_sk string")]
    fact = models.fct_sensor_reading(staged, *dims).collect()
    assert {r.raw_loaded_at for r in fact} == {dt.datetime(2024, 2, 1)}


def test_task_errors_as_text_beside_typed_priority(spark):
    from telemetra.plans import staging as stg
    raw = spark.createDataFrame([("t", "r", "pick", "completed", 1, "3.6"), ("u", "r", "pick", "completed", 2, "none")],
                                "task_id string, robot_id string, task_type string, status string, priority int, error_count string")
    raw = raw.selectExpr("*", *[f"CAST(NULL AS {t}) AS {c}" for c, t in (
        ("assigned_ts", "timestamp_ntz"), ("started_ts", "timestamp_ntz"), ("completed_ts", "timestamp_ntz"), ("distance_m", "double"),
        ("payload_kg", "double"), ("source_zone_id", "string"), ("destination_zone_id", "string"))])
    assert {r.task_id: r.error_count for r in stg.stg_tasks(raw).collect()} == {"t": 4, "u": None}


def _deliver(spark, deliveries, order):
    """(landed, late) ids after deliveries of (id, hour), one micro-batch each, in the given order."""
    import datetime as dt
    import tempfile
    base = tempfile.mkdtemp(prefix="telemetra-land-")
    start = dt.datetime(2024, 1, 1)
    schema = "event_id BIGINT, ts TIMESTAMP_NTZ"
    for k in order:
        rows = [(i, None if h is None else start + dt.timedelta(hours=h)) for i, h in deliveries[k]]
        S.write_inbound_json(spark.createDataFrame(rows, schema).coalesce(1), f"{base}/in")
        stream = S.read_json_stream(spark, f"{base}/in", schema, max_files_per_trigger=1)
        S.land_first_copies(stream, ["event_id"], "ts", f"{base}/good", f"{base}/late", f"{base}/progress", f"{base}/ck")
    return tuple(sorted(r.event_id for r in S.landed(spark, f"{base}/{x}", stream.schema).collect()) for x in ("good", "late"))


def test_late_first_copies_land_beside_and_replays_go(spark):
    deliveries = {"a": [(1, 100), (2, 99), (2, 99)], "b": [(1, 100), (3, 49), (4, 60), (5, 300)], "c": [(3, 49), (4, 60), (6, 240), (2, 99), (7, 270)]}
    # 3 is 51 h older than the first delivery's latest; 6 is 60 h older than 5; replays go however late
    assert _deliver(spark, deliveries, "abc") == ([1, 2, 4, 5, 7], [3, 6])
    for order in ("cba", "bca"):
        good, late = _deliver(spark, deliveries, order)
        assert sorted(good + late) == [1, 2, 3, 4, 5, 6, 7]  # nothing lost or doubled, whatever comes first


def test_reconcile_names_every_case(spark):
    tables = {"a": spark.range(3), "b": spark.range(2), "c": spark.range(5), "d": spark.range(1)}
    want = spark.createDataFrame([("a", 3), ("b", 4), ("c", 1), ("e", 9)], "table_name string, expected_rows long")
    got = {r.table_name: (r.expected_rows, r.row_count, r.difference, r.status) for r in I.reconcile(tables, want).collect()}
    assert got == {"a": (3, 3, 0, "MATCH"), "b": (4, 2, -2, "SHORT"), "c": (1, 5, 4, "EXCESS"), "d": (None, 1, None, "UNEXPECTED"),
                   "e": (9, None, None, "MISSING")}
