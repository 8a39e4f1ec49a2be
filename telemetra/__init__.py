"""telemetra: fleet-telemetry warehouse transforms expressed as Spark DataFrame plans.

Layers
------
sources/    readers, raw CSV ingestion, sinks, partitioned landings
functions/  Column -> Column helpers (safe casts, keys, URL parts, geo, buckets)
operators/  generic DataFrame -> DataFrame operators (relational macros, SCD2,
            windows, data-quality assertions, fault injection)
plans/      the fleet models (staging -> dims -> facts -> marts) composed from the
            operators, plus the fixture mapping used by tests and benchmarks
streaming/  Structured Streaming versions of the landing and incremental marts
"""

__version__ = "0.1.0"
