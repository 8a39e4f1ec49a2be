"""Whole-warehouse build: tables written per layer, assertions over the written tables."""

from __future__ import annotations

import os

from telemetra.plans.build import LAYOUT, build_warehouse
from telemetra.session import scratch_path


def test_build_warehouse(spark, sf_dir):
    out = scratch_path(spark, "warehouse")
    report = {r.test: (r.failures, r.status) for r in build_warehouse(spark, sf_dir, out).collect()}
    assert set(os.listdir(out)) == set(LAYOUT)
    must_pass = [t for t in report if t not in ("obt reconciles with fact",)]
    assert all(report[t] == (0, "PASS") for t in must_pass), report
    n_events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    assert spark.read.parquet(os.path.join(out, "fct_sensor_reading")).count() == n_events
