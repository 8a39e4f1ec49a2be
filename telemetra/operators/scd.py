"""Slowly-changing dimension (type 2) build, interval checks and look-ahead labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemetra.functions.columns import open_end, surrogate_key
from telemetra.operators import windows as W
from telemetra.operators.joins import days_before
from telemetra.session import checkpoint_dir

def build_scd2(base: DataFrame, changes: DataFrame, key: str, attributes: dict[str, str],
               base_valid_from: str, carry: Sequence[str] = (), change_ts: str = "changed_at",
               change_attr: str = "attribute", change_value: str = "new_value",
               change_id: str = "change_id", mode: str = "latest", sk_name: str = "sk",
               chunk: str | None = "day") -> DataFrame:
    """Versions of each key from a start state plus an attribute change log.

    ``attributes`` maps a canonical change-log attribute to the output column holding it in
    ``base`` (e.g. ``{"ZONE": "zone_id"}``). Output: key, carry columns, attribute columns,
    ``valid_from``, ``valid_to`` (next version start, open end 9999-12-31), ``is_current`` and a
    surrogate key over (key, valid_from). Versions are ordered by (valid_from, start state
    first, change id) so ties are deterministic.

    mode="latest": each version holds the most recent value of every attribute.
    mode="running_max": a change row holds the running maximum of each attribute's values
    (lexicographic), which reproduces the warehouse model exactly.

    chunk="day" (or "hour", "month"): skew-safe evaluation. The windows run per (key, time
    chunk) instead of per key, and a small per-chunk table carries the last known value and the
    next chunk's first start across chunk boundaries. A key holding a large share of all
    changes is then spread over as many tasks as it has chunks. Same result as chunk=None.
    """
    attr_cols = list(attributes.values())
    start = base.select(
        F.col(key), *[F.col(c) for c in carry], *[F.col(c) for c in attr_cols],
        F.col(base_valid_from).cast("timestamp_ntz").alias("valid_from"),
        F.lit(0).alias("_src"), F.lit(None).cast("string").alias("_cid"))

    ch = changes.filter(F.col(change_ts).isNotNull())
    ch = ch.join(base.select(key, *carry), on=key, how="inner")
    raw = {out: F.when(F.col(change_attr) == canon, F.col(change_value)) for canon, out in attributes.items()}
    if mode == "running_max" and chunk is not None:
        ch = _running_max_chunked(ch.withColumns({f"_raw_{o}": v for o, v in raw.items()}), key,
                                  [F.col(change_ts), F.col(change_id)], change_ts, list(raw), chunk)
        vals = {out: F.col(f"_rmax_{out}") for out in raw}
    elif mode == "running_max":
        vals = {out: W.running("max", v, key, [F.col(change_ts), F.col(change_id)]) for out, v in raw.items()}
    else:
        vals = raw
    ev = ch.select(
        F.col(key), *[F.col(c) for c in carry],
        *[v.alias(out) for out, v in vals.items()],
        F.col(change_ts).alias("valid_from"), F.lit(1).alias("_src"), F.col(change_id).alias("_cid"))

    combined = start.unionByName(ev)
    order = [F.col("valid_from"), F.col("_src"), F.col("_cid")]
    if chunk is None:
        filled = combined.select(
            F.col(key), *[F.col(c) for c in carry],
            *[W.forward_fill(c, key, order).alias(c) for c in attr_cols],
            "valid_from", "_src", "_cid",
            W.next_value("valid_from", key, order).alias("_next"))
    else:
        filled = _fill_chunked(combined, key, carry, attr_cols, order, chunk)
    return filled.select(
        surrogate_key(key, "valid_from").alias(sk_name),
        F.col(key), *[F.col(c) for c in carry], *[F.col(c) for c in attr_cols],
        "valid_from",
        F.coalesce(F.col("_next"), open_end()).alias("valid_to"),
        F.col("_next").isNull().alias("is_current"))


def _running_max_chunked(ch: DataFrame, key: str, order: list, ts: str, outs: list, chunk: str) -> DataFrame:
    """Running max of each ``_raw_<out>`` per key in ``order``: the running max inside each
    (key, chunk) combined with the max over all earlier chunks (a small per-chunk table)."""
    d = ch.withColumn("_rchunk", F.date_trunc(chunk, F.col(ts)).cast("timestamp_ntz"))
    local = d.withColumns({f"_lmax_{o}": W.running("max", f"_raw_{o}", [key, "_rchunk"], order) for o in outs})
    per_chunk = d.groupBy(key, "_rchunk").agg(*[F.max(f"_raw_{o}").alias(f"_cmax_{o}") for o in outs])
    prev = W.ordered(key, ["_rchunk"]).rowsBetween(Window.unboundedPreceding, -1)
    carry = per_chunk.select(key, "_rchunk", *[F.max(f"_cmax_{o}").over(prev).alias(f"_carry_{o}") for o in outs])
    j = local.join(carry, [key, "_rchunk"], "left")
    return j.withColumns({f"_rmax_{o}": F.greatest(F.col(f"_lmax_{o}"), F.col(f"_carry_{o}")) for o in outs})


def _fill_chunked(combined: DataFrame, key: str, carry: Sequence[str], attr_cols: Sequence[str],
                  order: list, chunk: str) -> DataFrame:
    """Forward fill + lead per (key, chunk), stitched with per-chunk carry-in values."""
    # NULL starts sort last, so they form the last chunk (a non-null key for the stitch join)
    rows = combined.withColumn("_chunk", F.coalesce(F.date_trunc(chunk, F.col("valid_from")).cast("timestamp_ntz"),
                                                    open_end()))
    part = [key, "_chunk"]
    local = rows.select(
        F.col(key), *[F.col(c) for c in carry], "valid_from", "_src", "_cid", "_chunk",
        *[W.forward_fill(c, part, order).alias(c) for c in attr_cols],
        W.next_value("valid_from", part, order).alias("_next_local"))
    # per chunk: last non-null value of each attribute, first start (one hash aggregate)
    pos = F.struct(F.col("valid_from"), F.col("_src"), F.col("_cid"))
    summary = rows.groupBy(key, "_chunk").agg(
        F.min("valid_from").alias("_first"),
        *[F.max(F.when(F.col(c).isNotNull(), F.struct(pos.alias("p"), F.col(c).alias("v")))).alias("_last_" + c)
          for c in attr_cols])
    prev = W.ordered(key, ["_chunk"]).rowsBetween(Window.unboundedPreceding, -1)
    stitched = summary.select(
        key, "_chunk",
        *[F.last(F.col(f"_last_{c}.v"), ignorenulls=True).over(prev).alias("_carry_" + c) for c in attr_cols],
        F.lead("_first").over(W.ordered(key, ["_chunk"])).alias("_next_chunk"))
    j = local.join(stitched, [key, "_chunk"], "left")
    return j.select(
        F.col(key), *[F.col(c) for c in carry],
        *[F.coalesce(F.col(c), F.col("_carry_" + c)).alias(c) for c in attr_cols],
        "valid_from", "_src", "_cid",
        F.coalesce(F.col("_next_local"), F.col("_next_chunk")).alias("_next"))


def overlapping_versions(dim: DataFrame, key: str, valid_from: str = "valid_from",
                         valid_to: str = "valid_to", chunk: str = "day") -> DataFrame:
    """Pairs of versions of one key whose [from, to) intervals overlap and whose starts differ,
    in both orders (a, b) and (b, a) -- the rows of the warehouse's theta self-join.

    No pair of a key is compared unless it is in the output: of two overlapping versions the
    later-starting one, b, starts inside the earlier one, a, so b's rank in start order lies in
    ``(starts <= a.from, starts < a.to]``. Ranks and counts come from windows per (key, time
    chunk) plus cumulative per-chunk counts (no window spans a whole key); each version then
    expands to exactly its partners' ranks and is joined to them on (key, rank)."""
    # a NULL bound never satisfies the overlap predicate: such versions have no partner
    # identical versions are collapsed (multiplicity _m) and their pairs replicated at the end
    # (the interval table feeds several branches below: it is checkpointed to the shared
    # checkpoint folder once instead of being recomputed per branch)
    checkpoint_dir(dim.sparkSession)
    iv = (dim.select(F.col(key).alias("_k"), F.col(valid_from).alias("_from"), F.col(valid_to).alias("_to"))
          .filter(F.col("_from").isNotNull() & F.col("_to").isNotNull())
          .groupBy("_k", "_from", "_to").agg(F.count(F.lit(1)).alias("_m"))
          .checkpoint(eager=True))
    one_us = F.expr("INTERVAL 1 MICROSECOND")
    # point events: each start, and each end moved 1 us earlier so "<= t" counts starts "< to"
    pts = (iv.select("_k", F.col("_from").alias("_t"), F.lit(1).alias("_is_start"), "_from", "_to", "_m")
           .unionByName(iv.select("_k", (F.col("_to") - one_us).alias("_t"), F.lit(0).alias("_is_start"),
                                  "_from", "_to", "_m")))
    pts = pts.withColumn("_chunk", F.date_trunc(chunk, "_t").cast("timestamp_ntz"))
    per_chunk = pts.groupBy("_k", "_chunk").agg(F.sum("_is_start").alias("_n"))
    before = per_chunk.select("_k", "_chunk", F.coalesce(F.sum("_n").over(
        W.ordered("_k", ["_chunk"]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    local_le = F.sum("_is_start").over(Window.partitionBy("_k", "_chunk").orderBy("_t")
                                       .rangeBetween(Window.unboundedPreceding, 0))
    counted = pts.join(before, ["_k", "_chunk"]).withColumn("_le", F.col("_base") + local_le)
    starts = (counted.filter(F.col("_is_start") == 1)
              .withColumn("_rank", F.col("_base") + F.row_number().over(
                  Window.partitionBy("_k", "_chunk").orderBy("_t", F.col("_to").asc_nulls_last()))))
    lo = starts.select("_k", "_from", "_to", "_m", (F.col("_le") + 1).alias("_lo"))
    hi = counted.filter(F.col("_is_start") == 0).select("_k", "_from", "_to", F.col("_le").alias("_hi"))
    spans = lo.join(hi, ["_k", "_from", "_to"]).filter(F.col("_hi") >= F.col("_lo"))
    cand = spans.select("_k", F.col("_from").alias("a_valid_from"), F.col("_to").alias("a_valid_to"),
                        F.col("_m").alias("_ma"), F.explode(F.sequence("_lo", "_hi")).alias("_rank"))
    b = starts.select("_k", "_rank", F.col("_from").alias("b_valid_from"), F.col("_to").alias("b_valid_to"),
                      F.col("_m").alias("_mb"))
    pairs = (cand.join(b, ["_k", "_rank"])
             .filter((F.col("a_valid_from") < F.col("b_valid_to")) & (F.col("b_valid_from") < F.col("a_valid_to"))
                     & (F.col("a_valid_from") != F.col("b_valid_from")))
             .withColumn("_rep", F.explode(F.sequence(F.lit(1), F.col("_ma") * F.col("_mb")))))
    fwd = pairs.select(F.col("_k").alias(key), "a_valid_from", "a_valid_to", "b_valid_from", "b_valid_to")
    rev = pairs.select(F.col("_k").alias(key), F.col("b_valid_from").alias("a_valid_from"),
                       F.col("b_valid_to").alias("a_valid_to"), F.col("a_valid_from").alias("b_valid_from"),
                       F.col("a_valid_to").alias("b_valid_to"))
    return fwd.unionByName(rev)


def overlapping_versions_selfjoin(dim: DataFrame, key: str, valid_from: str = "valid_from",
                                  valid_to: str = "valid_to") -> DataFrame:
    """The same pairs by a theta self-join on the key (compares every pair of a key: only for
    small inputs and as the reference form in tests)."""
    a = dim.select(F.col(key).alias("robot_key"), F.col(valid_from).alias("a_valid_from"),
                   F.col(valid_to).alias("a_valid_to"))
    b = dim.select(F.col(key).alias("b_key"), F.col(valid_from).alias("b_valid_from"),
                   F.col(valid_to).alias("b_valid_to"))
    cond = ((a.robot_key == b.b_key) & (a.a_valid_from < b.b_valid_to)
            & (b.b_valid_from < a.a_valid_to) & (a.a_valid_from != b.b_valid_from))
    return a.join(b, cond, "inner").select(
        F.col("robot_key").alias(key), "a_valid_from", "a_valid_to", "b_valid_from", "b_valid_to")


def overlaps_by_lead(dim: DataFrame, key: str, valid_from: str = "valid_from",
                     valid_to: str = "valid_to") -> DataFrame:
    """Versions whose end runs past the next version's start: one sort per key, no product."""
    nxt = W.next_value(valid_from, key, [F.col(valid_from), F.col(valid_to)])
    return (dim.select(key, valid_from, valid_to, nxt.alias("next_valid_from"))
            .filter(F.col(valid_to) > F.col("next_valid_from")))


def lookahead_label(daily: DataFrame, events: DataFrame, key: str, day: str, event_day: str,
                    horizon: int = 7, fan_out: bool = True, label: str = "label") -> DataFrame:
    """Label each (key, day) with 1 when an event falls within the next ``horizon`` days
    (``day >= event - horizon`` and ``day < event``), else 0.

    The range condition is rewritten as an equi-join: each event is expanded into the
    ``horizon`` days it labels (a fixed fan-out of ``horizon`` rows per event), then joined on
    (key, day). ``fan_out=True`` keeps one output row per matching event, as a plain range
    join does; ``fan_out=False`` de-duplicates the labelled days first (one row per input row).
    """
    lab = (events.select(F.col(key).alias("_k"),
                         F.explode(days_before(F.col(event_day).cast("date"), horizon)).alias("_d")))
    if not fan_out:
        lab = lab.distinct()
    lab = lab.withColumn("_hit", F.lit(1))
    out = daily.join(lab, (daily[key] == lab["_k"]) & (daily[day] == lab["_d"]), "left")
    return out.withColumn(label, F.coalesce(F.col("_hit"), F.lit(0))).drop("_k", "_d", "_hit")
