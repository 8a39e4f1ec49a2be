"""Window operators. Specs that share partition + order keys are planned as one Window node over
one sort, so stacking several features costs a single shuffle on the partition key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType


def _cols(cs) -> list[Column]:
    if isinstance(cs, (str, Column)):
        cs = [cs]
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def ordered(partition_by, order_by) -> Window:
    """Partition + ascending order with NULLs last (the warehouse default)."""
    return Window.partitionBy(*_cols(partition_by)).orderBy(
        *[c.asc_nulls_last() for c in _cols(order_by)])


_AGGS = {"avg": F.avg, "max": F.max, "min": F.min, "sum": F.sum, "count": F.count}


def trailing(df: DataFrame, partition_by, order_by, features: dict[str, tuple[str, str]],
             rows: int = 7, day_range: str | None = None) -> DataFrame:
    """Trailing-window features: ``{out: (agg, column)}`` over the last ``rows`` rows
    (current row included). With ``day_range`` = a date column, the frame is the last ``rows``
    calendar days instead (``rangeBetween`` over the day number)."""
    if day_range is None:
        w = ordered(partition_by, order_by).rowsBetween(-(rows - 1), 0)
    else:
        w = (Window.partitionBy(*_cols(partition_by))
             .orderBy(F.unix_date(F.col(day_range).cast("date")))
             .rangeBetween(-(rows - 1), 0))
    return df.withColumns({out: _AGGS[agg](F.col(c)).over(w) for out, (agg, c) in features.items()})


def running(agg: str, c, partition_by, order_by) -> Column:
    """agg(c) over rows between unbounded preceding and current row."""
    w = ordered(partition_by, order_by).rowsBetween(Window.unboundedPreceding, 0)
    return _AGGS[agg](c if isinstance(c, Column) else F.col(c)).over(w)


def forward_fill(c, partition_by, order_by) -> Column:
    """last_value(c ignore nulls) over the running frame."""
    w = ordered(partition_by, order_by).rowsBetween(Window.unboundedPreceding, 0)
    return F.last(c if isinstance(c, Column) else F.col(c), ignorenulls=True).over(w)


def next_value(c, partition_by, order_by) -> Column:
    return F.lead(c if isinstance(c, Column) else F.col(c)).over(ordered(partition_by, order_by))


def previous_value(c, partition_by, order_by) -> Column:
    return F.lag(c if isinstance(c, Column) else F.col(c)).over(ordered(partition_by, order_by))


def first_per_group(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """Keep the first row of each group under ``order_by`` (row_number() = 1).

    Catalyst plans this as a partial WindowGroupLimit before the shuffle, so each map task
    forwards at most one row per key: a hot key does not flood a single reducer."""
    w = Window.partitionBy(*_cols(partition_by)).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def next_row(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str], cols: Sequence[str],
             chunk: Column | None = None, nulls_first: bool = False) -> DataFrame:
    """Add ``_next_<c>`` (the value of ``c`` on the next row in ``order_by`` within the
    partition, like ``lead``) and ``_has_next`` to every row. Ascending order, NULLs last
    (or first with ``nulls_first``).

    With ``chunk`` -- an expression non-decreasing along ``order_by``, e.g. the day of the first
    order column, NULL where that column is NULL -- the windows run per (partition, chunk): the
    last row of a chunk takes its successor from the first row of the next non-empty chunk (a
    small per-chunk table), so no window partition holds a whole key."""
    part = list(partition_by)

    def order(cols_):
        return [(F.col(c).asc_nulls_first() if nulls_first else F.col(c).asc_nulls_last()) for c in cols_]

    if chunk is None:
        w = Window.partitionBy(*part).orderBy(*order(order_by))
        return df.withColumns({**{f"_next_{c}": F.lead(c).over(w) for c in cols},
                               "_has_next": F.lead(F.lit(1)).over(w).isNotNull()})
    # chunks in order: NULL chunk last (or first), then by value
    d = df.withColumns({"_chunk": chunk, "_cnull": chunk.isNull() if not nulls_first else chunk.isNotNull()})
    wl = Window.partitionBy(*part, "_cnull", "_chunk").orderBy(*order(order_by))
    local = d.withColumns({**{f"_nl_{c}": F.lead(c).over(wl) for c in cols},
                           "_hl": F.lead(F.lit(1)).over(wl).isNotNull()})
    # first row of each chunk: min over the order (NULL placement encoded in the key)
    null_key = (lambda o: F.col(o).isNotNull()) if nulls_first else (lambda o: F.col(o).isNull())
    key = F.struct(*[F.struct(null_key(o).alias("n"), F.col(o).alias("v")).alias(f"_o{i}")
                     for i, o in enumerate(order_by)],
                   *[F.col(c).alias(f"_v{i}") for i, c in enumerate(cols)])
    firsts = d.groupBy(*part, "_cnull", "_chunk").agg(F.min(key).alias("_first"))
    wc = Window.partitionBy(*part).orderBy(F.col("_cnull").asc(), F.col("_chunk").asc())
    nxt = firsts.select(*[F.col(p).alias(f"_p_{p}") for p in part], F.col("_cnull").alias("_p_cnull"),
                        F.col("_chunk").alias("_p_chunk"), F.lead("_first").over(wc).alias("_nf"))
    cond = None
    for a, b in [(p, f"_p_{p}") for p in part] + [("_cnull", "_p_cnull"), ("_chunk", "_p_chunk")]:
        c = local[a].eqNullSafe(nxt[b])
        cond = c if cond is None else cond & c
    j = local.join(nxt, cond, "left")
    return j.select(
        *[F.col(c) for c in df.columns],
        *[F.when(F.col("_hl"), F.col(f"_nl_{c}")).otherwise(F.col("_nf").getField(f"_v{i}"))
          .alias(f"_next_{c}") for i, c in enumerate(cols)],
        (F.col("_hl") | F.col("_nf").isNotNull()).alias("_has_next"))


#: Quantile cuts are looked up in two steps, so a row meets 2 * STEP of the STEP * STEP cuts.
STEP = 40


def with_range_chunk(df: DataFrame, column: str, name: str) -> DataFrame | None:
    """``df`` with a chunk number that does not decrease along ``column`` (for ``next_row``), so that a window over a whole
    table is many tasks: how many of STEP * STEP quantiles of the column lie at or below the value (NULL: NULL).
    A value that many rows share is one chunk, as a day is.

    The quantiles are one row of STEP * STEP numbers from a mergeable sketch. They only place the cuts, so their error moves
    rows between tasks and never changes a result. None for types that have no quantiles."""
    if not isinstance(df.schema[column].dataType, (NumericType, DateType, TimestampType, TimestampNTZType)):
        return None
    n = STEP * STEP
    cuts = (df.agg(F.percentile_approx(column, [i / n for i in range(n)], 4 * n).alias("_q"))
            .select(F.transform(F.sequence(F.lit(0), F.lit(STEP - 1)),
                                lambda i: F.slice("_q", i * STEP + 1, STEP)).alias("_cuts")))

    def below(a: Column) -> Column:
        return F.size(F.filter(a, lambda b: b <= F.col(column)))

    heads = below(F.transform("_cuts", lambda a: F.get(a, F.lit(0))))
    return (df.crossJoin(F.broadcast(cuts)).withColumn("_head", heads)
            .withColumn(name, F.when(F.col(column).isNotNull(), F.when(F.col("_head") == 0, 0).otherwise(
                F.col("_head") * STEP + below(F.get("_cuts", F.col("_head") - 1)))))
            .drop("_cuts", "_head"))
