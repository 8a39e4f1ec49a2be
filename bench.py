"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and print one JSON line.

Each query is fully executed with the ``noop`` sink (every row is produced, nothing is
collected to the driver). A first untimed pass warms the JVM; the reported time per query is
the best of ``$BENCH_REPEAT`` timed runs (default 2: steady state, codegen compiled);
``first_call`` is each query's first run in the session, with all that it builds or counts once.
With ``$BENCH_EVENTLOG_DIR`` set (an existing scratch folder) Spark writes its event log
there; ``scripts/stage_times.py`` summarises it.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "mart_features_training",   # flagship: staging -> SCD2 -> PIT join -> daily snapshot -> trailing window
    "fct_sensor_reading",
    "obt_sensor_readings",
    "dim_robot_scd2",
    "agg_robot_daily_quality",  # the lake job
    "agg_health_daily",
    "mart_training_dataset",
    "dedup_row_number",
    "pivot_counts",
    "unpivot_melt",
    "fct_maintenance",
    "unit_repair_temp",
    "inject_dirt",
    "geo_nearest_pairs",
    "dq_pk_fk_gate",
    "dq_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from telemetra.plans.catalog import load_all
    from telemetra.session import build_session

    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    if os.environ.get("BENCH_EVENTLOG_DIR"):  # stage / task timings for scripts/stage_times.py
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENTLOG_DIR"]})
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus), extra=extra)
    reg = load_all()
    names = only or HEADLINE

    def run(name: str) -> float:
        t0 = time.perf_counter()
        reg[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    try:
        run(names[0])  # warm-up: JIT, class loading, file listing caches
    except Exception as ex:  # noqa: BLE001 - reported below with the query
        print(f"warm-up failed: {ex}", file=sys.stderr)
    times: dict[str, float | None] = {}
    first: dict[str, float] = {}  # build and plan-time jobs included, nothing kept from an earlier call of the query
    for n in names:
        try:
            runs = [round(run(n), 3) for _ in range(max(1, repeat))]
            first[n], times[n] = runs[0], min(runs)
        except Exception as ex:  # noqa: BLE001 - a failing query is reported as null, not fatal
            print(f"{n} failed: {ex}", file=sys.stderr)
            times[n] = None
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    total = round(sum(t for t in times.values() if t is not None), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "first_call": first,
                      "first_call_total": round(sum(first.values()), 3), "sf": sf,
                      "failed": [n for n, t in times.items() if t is None]}))
    spark.stop()


if __name__ == "__main__":
    main()
