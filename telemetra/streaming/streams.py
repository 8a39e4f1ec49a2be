"""Structured Streaming jobs: landing, bad-record split, replay dedup, incremental daily health,
late-arrival audit.

Each job reads newline-delimited JSON records from an inbound folder (the stream delivery's
files), keeps its progress in a checkpoint on shared storage, and writes with an exactly-once
file sink or ``foreachBatch``. In production the trigger is ``processingTime`` (the landing
buffers 300 s); tests and the registered queries use ``availableNow`` to drain what is there.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
CORRUPT = "_corrupt_record"
# State partitions of a stateful stream are fixed at its first start (AQE does not apply to
# streaming). "auto": one per core of the cluster, capped by the session's shuffle partitions
# -- not the tens of thousands a batch shuffle may start with.
DEFAULT_STATE_PARTITIONS = "auto"


def _trigger(writer, trigger: str | None):
    return writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)


@contextmanager
def _state_partitions(spark: SparkSession, n: int | str | None):
    """Start a stateful query with ``n`` shuffle (= state) partitions, then restore the session
    setting. On restart the checkpoint's own count wins, as Spark requires."""
    if not n:
        yield
        return
    old = spark.conf.get("spark.sql.shuffle.partitions")
    if n == "auto":
        n = max(1, min(int(old), spark.sparkContext.defaultParallelism))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def _batch_dir(sink: str, batch_id: int) -> str:
    """Folder of one micro-batch's output; read back, ``batch_id`` becomes a column."""
    return f"{sink.rstrip('/')}/batch_id={batch_id}"


def write_inbound_json(df: DataFrame, path: str, mode: str = "append") -> None:
    """Write records as newline-delimited JSON (how the stream delivery lands them)."""
    df.write.mode(mode).option("timestampNTZFormat", TS_FORMAT).json(path)


def write_inbound_json_counted(spark: SparkSession, df: DataFrame, path: str) -> int:
    """Write a delivery into an empty inbound folder and return how many files it made (the
    file listing is driver metadata), so a stream can take exactly this delivery per trigger."""
    write_inbound_json(df, path)
    return max(1, len(spark.read.text(path).inputFiles()))


def write_inbound_lines(lines: DataFrame, path: str, mode: str = "append") -> None:
    """Write raw text lines (one record per line, possibly malformed)."""
    lines.write.mode(mode).text(path)


def read_json_stream(spark: SparkSession, path: str, schema: StructType | str,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).option("timestampNTZFormat", TS_FORMAT)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(path)


def land_partitioned(stream: DataFrame, ts_col: str, sink: str, checkpoint: str,
                     trigger: str | None = None) -> None:
    """Stream -> parquet under year/month/day/hour folders (exactly-once file sink)."""
    folder = {"year": F.year(ts_col), "month": F.month(ts_col), "day": F.dayofmonth(ts_col), "hour": F.hour(ts_col)}
    out = stream.withColumns(folder).repartition(*folder)  # a batch writes one file a folder, not one a task
    q = _trigger(out.writeStream.format("parquet").option("checkpointLocation", checkpoint)
                 .partitionBy("year", "month", "day", "hour").outputMode("append"), trigger).start(sink)
    q.awaitTermination()


def split_bad_records(spark: SparkSession, inbound: str, schema: StructType | str, good_sink: str, bad_sink: str,
                      checkpoint: str, key: str, trigger: str | None = None) -> None:
    """Parse each text line; records that do not parse as a whole (any field, not only the key) or lack the
    key go to an error folder, with the raw line, instead of failing the stream. One micro-batch
    writes both outputs and parses once."""
    lines = spark.readStream.text(inbound)
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    full = StructType([*wanted.fields, StructField(CORRUPT, StringType())])
    parsed = lines.select("value", F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT,
                                                               "timestampNTZFormat": TS_FORMAT}).alias("r"))

    def sink(batch: DataFrame, batch_id: int) -> None:
        # each batch overwrites its own folder: a replayed batch id rewrites, never duplicates
        ok = F.col(f"r.{key}").isNotNull() & F.col(f"r.{CORRUPT}").isNull()
        batch = batch.persist()
        try:
            batch.filter(ok).select("r.*").drop(CORRUPT).write.mode("overwrite").parquet(_batch_dir(good_sink, batch_id))
            (batch.filter(~ok).select(F.col("value").alias("raw_record"))
             .write.mode("overwrite").parquet(_batch_dir(bad_sink, batch_id)))
        finally:
            batch.unpersist()

    q = _trigger(parsed.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint), trigger).start()
    q.awaitTermination()


def dedup_replays(stream: DataFrame, keys: Sequence[str], ts_col: str, sink: str, checkpoint: str,
                  lateness: str = "48 hours", trigger: str | None = None,
                  state_partitions: int | str | None = DEFAULT_STATE_PARTITIONS) -> None:
    """Drop replayed records (same keys) arriving within ``lateness`` of the first copy.
    State per key is kept until the watermark passes it, so state stays bounded."""
    ev = stream.withColumn("_event_time", F.col(ts_col).cast("timestamp"))
    d = ev.withWatermark("_event_time", lateness).dropDuplicatesWithinWatermark(list(keys)).drop("_event_time")
    with _state_partitions(stream.sparkSession, state_partitions):
        q = _trigger(d.writeStream.format("parquet").option("checkpointLocation", checkpoint)
                     .outputMode("append"), trigger).start(sink)
    q.awaitTermination()


def _read_if_there(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """A folder of Parquet files, or None before anything was written there; any other failure must stop the stream."""
    try:
        return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    except AnalysisException as ex:
        if ex.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def land_first_copies(stream: DataFrame, keys: Sequence[str], ts_col: str, sink: str, late_sink: str, progress: str, checkpoint: str,
                      lateness_hours: int = 48, trigger: str | None = None) -> None:
    """Land every record once, and lose none: replays (same keys and event day as a landed record) are dropped however late
    they come, and a first copy whose event time is more than ``lateness_hours`` older than the latest of all
    earlier batches goes to ``late_sink`` instead of vanishing.

    What is known is the landed data itself, foldered by event day: a batch is matched with the keys of the days it
    holds, so nothing is kept in memory and no state outgrows its store. ``progress`` holds one row a batch (the latest event time so
    far), read from the batch before. Each batch overwrites its own ``batch_id=`` folders and looks only at earlier
    ones, so a replayed batch rewrites the same rows. A NULL key or time is never a replay."""
    spark = stream.sparkSession
    known = StructType([*(stream.schema[k] for k in keys), StructField("day", DateType()), StructField("batch_id", LongType())])

    def fn(batch: DataFrame, batch_id: int) -> None:
        before = _read_if_there(spark, _batch_dir(progress, batch_id - 1)) if batch_id else None
        latest = before.first()["latest"] if before is not None else None
        ts = F.col(ts_col)
        first = batch.dropDuplicates(list(keys)).withColumn("day", F.to_date(ts))
        for landed in (sink, late_sink):
            old = _read_if_there(spark, landed, known)
            if old is not None:
                first = first.join(old.filter(F.col("batch_id") < batch_id).drop("batch_id"), [*keys, "day"], "left_anti")
        late = F.lit(False) if latest is None else F.coalesce(
            ts < F.timestamp_add("HOUR", F.lit(-lateness_hours), F.lit(latest).cast("timestamp_ntz")), F.lit(False))
        first = first.persist()
        try:
            for rows, path in ((first.filter(~late), sink), (first.filter(late), late_sink)):
                rows.repartition("day").write.mode("overwrite").partitionBy("day").parquet(_batch_dir(path, batch_id))
        finally:
            first.unpersist()
        (batch.agg(F.greatest(F.max(ts), F.lit(latest).cast("timestamp_ntz")).alias("latest"))
         .coalesce(1).write.mode("overwrite").parquet(_batch_dir(progress, batch_id)))

    q = _trigger(stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint), trigger).start()
    q.awaitTermination()


def landed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The records of a sink of ``land_first_copies``; none if none was ever written there."""
    df = _read_if_there(spark, path, StructType([*schema.fields, StructField("day", DateType()), StructField("batch_id", LongType())]))
    return spark.createDataFrame([], schema) if df is None else df.select(*schema.names)


def daily_health_incremental(stream: DataFrame, key: str, ts_col: str, sink: str, checkpoint: str,
                             lateness: str = "48 hours", trigger: str | None = None,
                             state_partitions: int | str | None = DEFAULT_STATE_PARTITIONS) -> None:
    """Tumbling 1-day window aggregates in update mode; each micro-batch writes the groups it
    changed to its own ``batch_id=`` folder of an upsert log (idempotent on replay).
    ``latest_versions`` reads the current state."""
    ev = stream.withColumn("_event_time", F.col(ts_col).cast("timestamp"))
    agg = (ev.withWatermark("_event_time", lateness)
           .groupBy(F.col(key), F.window("_event_time", "1 day").alias("w"))
           .agg(F.count(F.lit(1)).alias("event_count"),
                F.sum("motortemp").alias("sum_motor_temp"), F.count("motortemp").alias("n_motor_temp"),
                F.max("motortemp").alias("max_motor_temp"),
                F.sum("batteryvoltage").alias("sum_battery_voltage"),
                F.count("batteryvoltage").alias("n_battery_voltage"),
                F.min("batteryvoltage").alias("min_battery_voltage"), F.max("vibration").alias("max_vibration")))

    def sink_fn(batch: DataFrame, batch_id: int) -> None:
        (batch.select(key, F.col("w.start").cast("timestamp_ntz").cast("date").alias("summary_date"),
                      "event_count", "sum_motor_temp", "n_motor_temp", "max_motor_temp", "sum_battery_voltage",
                      "n_battery_voltage", "min_battery_voltage", "max_vibration")
         .write.mode("overwrite").parquet(_batch_dir(sink, batch_id)))

    with _state_partitions(stream.sparkSession, state_partitions):
        q = _trigger(agg.writeStream.outputMode("update").foreachBatch(sink_fn)
                     .option("checkpointLocation", checkpoint), trigger).start()
    q.awaitTermination()


#: Daily health as partial results that merge: column -> (aggregate over records, how partial results merge).
_HEALTH = {
    "event_count": ("count(1)", "sum"), "late_rows": ("count_if(_late)", "sum"),
    "sum_motor_temp": ("sum(motortemp)", "sum"), "n_motor_temp": ("count(motortemp)", "sum"),
    "max_motor_temp": ("max(motortemp)", "max"),
    "sum_battery_voltage": ("sum(batteryvoltage)", "sum"), "n_battery_voltage": ("count(batteryvoltage)", "sum"),
    "min_battery_voltage": ("min(batteryvoltage)", "min"), "max_vibration": ("max(vibration)", "max")}


def _merged(deltas: DataFrame, keys: Sequence[str]) -> DataFrame:
    return deltas.groupBy(*keys).agg(*[F.expr(f"{merge}({c})").alias(c) for c, (_, merge) in _HEALTH.items()])


class HealthLog:
    """Daily health as a log of deltas with snapshots, under one shared folder.

    ``deltas/batch_id=N``: the partial results of one micro-batch's records. ``snapshots/upto=N``: all deltas up
    to batch N merged. ``commits/upto=N``: written after the snapshot of N is whole; a snapshot without it is never read, so
    a compaction that dies half-way leaves the previous snapshot and its deltas in force. Every folder
    is overwritten by a replay of its batch with the same rows, and a replay of batch N builds on snapshots before N only."""

    def __init__(self, spark: SparkSession, path: str, key: str) -> None:
        self.spark, self.path, self.keys = spark, path.rstrip("/"), [key, "summary_date"]

    def _committed(self, before: int | None = None) -> int | None:
        commits = _read_if_there(self.spark, f"{self.path}/commits", StructType([StructField("upto", LongType())]))
        if commits is None:
            return None
        return (commits if before is None else commits.filter(F.col("upto") < before)).agg(F.max("upto")).first()[0]

    def _deltas(self) -> DataFrame | None:
        return _read_if_there(self.spark, f"{self.path}/deltas")

    def add(self, partial: DataFrame, batch_id: int) -> None:
        partial.write.mode("overwrite").parquet(_batch_dir(f"{self.path}/deltas", batch_id))

    def compact(self, upto: int) -> None:
        """Merges the newest earlier snapshot with the deltas after it, up to batch ``upto``."""
        rows = self._rows(self._committed(before=upto), upto)
        if rows is None:
            return
        _merged(rows, self.keys).write.mode("overwrite").parquet(f"{self.path}/snapshots/upto={upto}")
        (self.spark.range(1).select(F.lit(upto).cast("bigint").alias("batch")).coalesce(1)
         .write.mode("overwrite").parquet(f"{self.path}/commits/upto={upto}"))

    def _rows(self, base: int | None, upto: int | None) -> DataFrame | None:
        deltas = self._deltas()
        if deltas is None:
            return None
        after = deltas
        if base is not None:
            after = after.filter(F.col("batch_id") > base)
        if upto is not None:
            after = after.filter(F.col("batch_id") <= upto)
        after = after.drop("batch_id")
        if base is None:
            return after
        return self.spark.read.parquet(f"{self.path}/snapshots/upto={base}").unionByName(after)

    def current(self) -> DataFrame | None:
        """The present state: the newest committed snapshot and the deltas after it (folders before it are pruned);
        None before the first batch."""
        rows = self._rows(self._committed(), None)
        return None if rows is None else _merged(rows, self.keys)


def daily_health_deltas(stream: DataFrame, key: str, ts_col: str, sink: str, checkpoint: str, lateness_hours: int = 48,
                        compact_every: int = 20, trigger: str | None = None) -> HealthLog:
    """Daily health per key without loss: each micro-batch writes the partial results of its own records (they add up, so no state is
    kept and a record counts however late it comes), and every ``compact_every`` batches the log is merged into a snapshot.

    ``late_rows`` counts the records whose event time is more than ``lateness_hours`` older than the latest event time of
    all earlier batches. ``sink/progress`` holds that time, one row a batch. A record without event time has no
    day: it counts under a NULL date and is never late."""
    spark = stream.sparkSession
    log = HealthLog(spark, sink, key)
    progress = f"{log.path}/progress"

    def fn(batch: DataFrame, batch_id: int) -> None:
        before = _read_if_there(spark, _batch_dir(progress, batch_id - 1)) if batch_id else None
        latest = before.first()["latest"] if before is not None else None
        ts = F.col(ts_col)
        late = F.lit(False) if latest is None else F.coalesce(
            ts < F.timestamp_add("HOUR", F.lit(-lateness_hours), F.lit(latest).cast("timestamp_ntz")), F.lit(False))
        partial = (batch.withColumns({"_late": late, "summary_date": ts.cast("date")}).groupBy(*log.keys)
                   .agg(*[F.expr(agg).alias(c) for c, (agg, _) in _HEALTH.items()]))
        log.add(partial, batch_id)
        (batch.agg(F.greatest(F.max(ts), F.lit(latest).cast("timestamp_ntz")).alias("latest"))
         .coalesce(1).write.mode("overwrite").parquet(_batch_dir(progress, batch_id)))
        if (batch_id + 1) % compact_every == 0:
            log.compact(batch_id)

    q = _trigger(stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint), trigger).start()
    q.awaitTermination()
    return log


def latest_versions(log: DataFrame, keys: Sequence[str], version: str = "batch_id") -> DataFrame:
    """Current row per key from an append-only upsert log (max version wins; one hash agg)."""
    others = [c for c in log.columns if c not in set(keys) | {version}]
    latest = log.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col(version)).alias("_v"))
    return latest.select(*keys, "_v.*")


def late_rows_audit(stream: DataFrame, ts_col: str, audit: str, checkpoint: str, lateness_seconds: int = 3600,
                    trigger: str | None = None) -> None:
    """Per micro-batch: rows, and rows whose event time is older than (the latest event time of
    all earlier batches - lateness), i.e. rows a watermark of that lateness would call late.

    The running maximum lives in the audit table itself (shared storage): each row carries it on from the
    batch before, so a batch reads one row whatever the history, and the audit survives a restart; each batch overwrites its own ``batch_id=`` folder, so a replay never duplicates."""
    spark = stream.sparkSession

    def fn(batch: DataFrame, batch_id: int) -> None:
        before = _read_if_there(spark, _batch_dir(audit, batch_id - 1)) if batch_id else None
        prev_max = before.first()["max_ts_so_far"] if before is not None else None
        ts = F.col(ts_col)
        late = (ts < F.timestamp_add("SECOND", F.lit(-lateness_seconds), F.lit(prev_max).cast("timestamp_ntz"))) \
            if prev_max is not None else F.lit(False)
        (batch.agg(F.count(F.lit(1)).alias("rows"), F.count_if(late).alias("late_rows"),
                   F.max(ts).alias("batch_max_ts"), F.greatest(F.max(ts), F.lit(prev_max).cast("timestamp_ntz")).alias("max_ts_so_far"))
         .write.mode("overwrite").parquet(_batch_dir(audit, batch_id)))

    q = _trigger(stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint), trigger).start()
    q.awaitTermination()


def read_audit(log: DataFrame) -> DataFrame:
    """The audit rows: batch id, rows, late rows, latest event time of the batch."""
    return log.select(F.col("batch_id").cast("bigint").alias("batch_id"), "rows", "late_rows", "batch_max_ts")
