"""Build the whole warehouse: every model written as a table in dependency order, then the
data-quality report over the written tables.

Staging stays lazy (views); dimensions, facts and marts are materialised as parquet under
``out_dir`` (facts partitioned by date), and each downstream model reads its inputs back from
those tables, so lineage is cut at every layer and a lost executor only recomputes one layer.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetra.operators import quality as Q
from telemetra.operators import scd
from telemetra.plans import fixtures as fx
from telemetra.plans import models
from telemetra.plans.models import Warehouse
from telemetra.sources import ingest as I

# model -> partition columns (facts by day)
LAYOUT = {
    "dim_zone": (), "dim_robot_model": (), "dim_robot": (),
    "fct_sensor_reading": ("reading_date_key",), "fct_robot_daily": ("report_date",),
    "fct_maintenance": (), "obt_sensor_readings": ("reading_date_key",),
    "mart_features_training": (), "fct_robot_health_daily": (), "ml_robot_training_dataset": (),
}


def build_warehouse(spark: SparkSession, sf_dir: str, out_dir: str) -> DataFrame:
    """Write every model under ``out_dir``/<model> and return the assertion report
    (test, failures, status) computed on the written tables."""
    w = Warehouse(spark, sf_dir)
    tables: dict[str, DataFrame] = {}

    def write(name: str, df: DataFrame) -> DataFrame:
        path = os.path.join(out_dir, name)
        I.write_table(df, path, partition_by=LAYOUT[name])
        back = I.read_partitioned(spark, path)
        tables[name] = back.select(*df.columns)
        return tables[name]

    zone = write("dim_zone", w.dim_zone)
    model = write("dim_robot_model", w.dim_robot_model)
    robot = write("dim_robot", w.dim_robot)
    fact = write("fct_sensor_reading", models.fct_sensor_reading(w.stg_readings, robot, zone))
    daily = write("fct_robot_daily", models.fct_robot_daily(fact))
    write("fct_maintenance", models.fct_maintenance(fx.maintenance_tickets(spark, sf_dir)))
    obt = write("obt_sensor_readings", models.obt_sensor_readings(fact, robot, model, zone))
    write("mart_features_training", models.mart_features_training(daily))
    health = write("fct_robot_health_daily", w.health_daily)
    write("ml_robot_training_dataset", models.mart_training_dataset(health, fx.failures(spark, sf_dir)))

    checks = {
        "dim_zone.zone_id unique": (Q.unique(zone, "zone_id"), None),
        "dim_robot_model.model_id unique": (Q.unique(model, "model_id"), None),
        "dim_robot.robot_sk not null": (Q.not_null(robot, "robot_sk"), None),
        "dim_robot versions do not overlap": (scd.overlapping_versions(robot, "robot_id"), None),
        "fct_sensor_reading.reading_id unique": (Q.unique(fact, "reading_id"), None),
        "fct_sensor_reading.robot_sk -> dim_robot": (Q.relationships(fact, "robot_sk", robot, "robot_sk"), None),
        "fct_sensor_reading.zone_sk -> dim_zone": (Q.relationships(fact, "zone_sk", zone, "zone_sk"), None),
        "fct_robot_daily (robot_id, report_date) unique":
            (Q.unique_combination(daily, ["robot_id", "report_date"]), None),
        "obt reconciles with fact": (Q.rowcounts_differ(fact, obt), None),
        "no reading in the future": (Q.no_future_timestamps(fact, "reading_ts", F.current_timestamp()), None),
    }
    return Q.report(checks)
