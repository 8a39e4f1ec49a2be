"""Join helpers: point-in-time joins, range joins rewritten as equi-joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pit_join(fact: DataFrame, dim: DataFrame, key: str, ts: str, valid_from: str = "valid_from",
             valid_to: str = "valid_to", how: str = "left", dim_key: str | None = None) -> DataFrame:
    """Point-in-time join: equal key and ``valid_from <= ts < valid_to`` (half-open).

    Every version is spread over the days it covers inside the facts' own time span (one aggregate over their
    time column), and a fact meets the versions of its key and day: the join is an equi-join on (key, day)
    with the interval as a residual. A key's F facts and V versions cost what meets in a day, not F x V, and a
    hot key is spread over its days. A fact lies in one day, so no pair is found twice.

    Overlapping versions give one row each. A NULL key, time or bound matches nothing; so does an empty or inverted interval."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"pit_join: {how!r} would need versions without facts; use inner, left, left_semi or left_anti")
    d = dim_key or key
    span = fact.agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    covered = ((F.col(valid_from) < F.col(valid_to)) & (F.col(valid_from) <= F.col("_hi")) & (F.col(valid_to) > F.col("_lo")))
    last = F.least(F.col(valid_to) - F.expr("INTERVAL 1 MICROSECOND"), F.col("_hi"))
    cells = (dim.crossJoin(span).filter(covered)
             .withColumn("_cell", F.explode(F.sequence(F.to_date(F.greatest(F.col(valid_from), F.col("_lo"))), F.to_date(last))))
             .drop("_lo", "_hi"))
    met = ((fact[key] == cells[d]) & (F.to_date(fact[ts]) == cells["_cell"])
           & (fact[ts] >= cells[valid_from]) & (fact[ts] < cells[valid_to]))
    joined = fact.join(cells, met, how)
    return joined if how in ("left_semi", "left_anti") else joined.select(*[fact[c] for c in fact.columns], *[cells[c] for c in dim.columns])


def pit_merge(fact: DataFrame, dim: DataFrame, key: str, ts: str, valid_from: str, valid_to: str,
              dim_key: str, chunk: str = "day") -> DataFrame:
    """Left point-in-time join for versions that do not overlap, by merging: for callers who know that
    one key has very many versions. Same columns as ``pit_join``, which it equals on such a table; on
    overlapping versions it keeps only the latest started one.

    Rows of both sides are put in one stream ordered by (key, time, versions before facts,
    version end); a fact row takes the last version started at or before it, if it has not
    ended yet. Forward fill runs per (key, chunk of time) plus, per chunk, the last version
    of all earlier chunks."""
    from pyspark.sql import Window

    from telemetra.operators import windows as W

    dim_cols = dim.columns
    fact_cols = fact.columns
    vstruct = F.struct(*[F.col(c) for c in dim_cols])
    fstruct = F.struct(*[F.col(c) for c in fact_cols])
    v_type = dim.select(vstruct).schema[0].dataType
    f_type = fact.select(fstruct).schema[0].dataType
    t2_type = dim.schema[valid_to].dataType
    v = dim.filter(F.col(valid_from).isNotNull()).select(
        F.col(dim_key).alias("_k"), F.col(valid_from).alias("_t"), F.lit(0).alias("_kind"),
        F.col(valid_to).alias("_t2"), vstruct.alias("_v"), F.lit(None).cast(f_type).alias("_f"))
    f = fact.select(
        F.col(key).alias("_k"), F.col(ts).alias("_t"), F.lit(1).alias("_kind"),
        F.lit(None).cast(t2_type).alias("_t2"), F.lit(None).cast(v_type).alias("_v"), fstruct.alias("_f"))
    rows = v.unionByName(f).withColumn("_chunk", F.date_trunc(chunk, F.col("_t")).cast("timestamp_ntz"))
    order = ["_t", "_kind", "_t2"]
    local = rows.withColumn("_lv", W.forward_fill("_v", ["_k", "_chunk"], order))
    # last version of each chunk, then the last of all earlier chunks
    # (one row per key and chunk holding any row: chunks with facts only carry NULL)
    last_v = rows.groupBy("_k", "_chunk").agg(
        F.max(F.when(F.col("_kind") == 0, F.struct(F.col("_t"), F.col("_t2"), F.col("_v")))).alias("_m"))
    prev = W.ordered("_k", ["_chunk"]).rowsBetween(Window.unboundedPreceding, -1)
    carry = last_v.select("_k", "_chunk", F.last(F.col("_m._v"), ignorenulls=True).over(prev).alias("_cv"))
    j = (local.filter(F.col("_kind") == 1)
         .join(carry, (local["_k"].eqNullSafe(carry["_k"])) & (local["_chunk"].eqNullSafe(carry["_chunk"])), "left")
         .select(F.col("_f"), F.coalesce(F.col("_lv"), F.col("_cv")).alias("_ver"), local["_t"].alias("_ts")))
    # a NULL key or time never matches; the version must not have ended
    ok = (F.col("_f").getField(key).isNotNull() & F.col("_ts").isNotNull()
          & F.col("_ver").isNotNull() & (F.col("_ts") < F.col("_ver").getField(valid_to)))
    return j.select(*[F.col("_f").getField(c).alias(c) for c in fact_cols],
                    *[F.when(ok, F.col("_ver").getField(c)).alias(c) for c in dim_cols])


def days_before(event_day: Column, horizon: int) -> Column:
    """Array of the ``horizon`` days strictly before ``event_day``: [d - horizon, d - 1]."""
    return F.sequence(F.date_sub(event_day, horizon), F.date_sub(event_day, 1))
