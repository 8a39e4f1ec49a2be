"""Data-quality assertions. Each returns the violating rows (empty = pass) as a lazy DataFrame;
``report`` turns a set of them into one (test, failures, status) table in a single job.

Grouped checks are hash aggregates (partial aggregation before the shuffle), existence checks
are anti joins, and ordering checks are window functions over the partition key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from telemetra.functions.columns import WIDE_NULL_TOKENS
from telemetra.operators import windows as W


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _where(df: DataFrame, where) -> DataFrame:
    return df.filter(where) if where is not None else df


# ---- column tests ----------------------------------------------------------------------------

def not_null(df: DataFrame, column: str, where=None) -> DataFrame:
    return _where(df, where).filter(F.col(column).isNull())


def unique(df: DataFrame, column: str, where=None) -> DataFrame:
    return (_where(df, where).filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("unique_field"))
            .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def unique_combination(df: DataFrame, columns: Sequence[str], where=None) -> DataFrame:
    return (_where(df, where).groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1))


def accepted_values(df: DataFrame, column: str, values: Sequence, where=None) -> DataFrame:
    """Values outside the list with their counts (NULL passes)."""
    return (_where(df, where).groupBy(F.col(column).alias("value_field"))
            .agg(F.count(F.lit(1)).alias("n_records"))
            .filter(~F.col("value_field").isin(*values)))


def not_accepted_values(df: DataFrame, column: str, values: Sequence, where=None) -> DataFrame:
    return (_where(df, where).select(F.col(column).alias("value_field")).distinct()
            .filter(F.col("value_field").isin(*values)))


def accepted_range(df: DataFrame, column: str, min_value=None, max_value=None, inclusive: bool = True,
                   where=None) -> DataFrame:
    """Rows with ``not(x >= min)`` or ``not(x <= max)`` (strict when not inclusive); NULL passes."""
    return _where(df, where).filter(out_of_range(column, min_value, max_value, inclusive))


def out_of_range(column: str, min_value=None, max_value=None, inclusive: bool = True) -> Column:
    c = F.col(column)
    bad = F.lit(False)
    if min_value is not None:
        bad = bad | ~((c >= F.lit(min_value)) if inclusive else (c > F.lit(min_value)))
    if max_value is not None:
        bad = bad | ~((c <= F.lit(max_value)) if inclusive else (c < F.lit(max_value)))
    return bad


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str,
                  from_condition=None, to_condition=None) -> DataFrame:
    """Child rows whose non-null key has no parent (anti join; NULL passes)."""
    ch = _where(child, from_condition).filter(F.col(column).isNotNull()).select(F.col(column).alias("from_field"))
    pa = _where(parent, to_condition).select(F.col(field).alias("to_field"))
    return ch.join(pa, ch.from_field == pa.to_field, "left_anti")


def at_least_one(df: DataFrame, column: str | Column, group_by: Sequence[str] = (), where=None) -> DataFrame:
    """Groups (or the whole table) holding no non-null value."""
    src = _where(df, where)
    agg = F.count(_c(column)).alias("filler_column")
    out = src.groupBy(*group_by).agg(agg) if group_by else src.agg(agg)
    return out.filter(F.col("filler_column") == 0)


def not_constant(df: DataFrame, column: str | Column, group_by: Sequence[str] = (), where=None) -> DataFrame:
    """Groups whose non-null values are all the same (exactly one distinct value)."""
    src = _where(df, where)
    agg = F.count_distinct(_c(column)).alias("filler_column")
    out = src.groupBy(*group_by).agg(agg) if group_by else src.agg(agg)
    return out.filter(F.col("filler_column") == 1)


def not_empty_string(df: DataFrame, column: str | Column, trim_whitespace: bool = True, where=None) -> DataFrame:
    c = _c(column)
    return _where(df, where).filter((F.trim(c) if trim_whitespace else c) == "")


def not_null_proportion(df: DataFrame, column: str | Column, at_least: float, at_most: float = 1.0,
                        group_by: Sequence[str] = (), where=None) -> DataFrame:
    src = _where(df, where)
    prop = (F.sum(F.when(_c(column).isNull(), 0).otherwise(1)) / F.count(F.lit(1))).alias("not_null_proportion")
    out = src.groupBy(*group_by).agg(prop) if group_by else src.agg(prop)
    p = F.col("not_null_proportion")
    return out.filter((p < F.lit(at_least)) | (p > F.lit(at_most)))


def recency(df: DataFrame, field: str, datepart: str, interval: int, now, group_by: Sequence[str] = (),
            ignore_time_component: bool = False, where=None) -> DataFrame:
    """Groups whose latest ``field`` is older than ``now - interval datepart`` .
    Groups without any value are not judged. ``now`` is a parameter (not the wall clock) so results are reproducible."""
    src = _where(df, where)
    f = F.col(field).cast("date") if ignore_time_component else F.col(field)
    agg = F.max(f).alias("most_recent")
    out = src.groupBy(*group_by).agg(agg) if group_by else src.agg(agg)
    now_c = F.lit(now).cast("timestamp_ntz")
    thr = F.timestamp_add(datepart.upper(), F.lit(-int(interval)), now_c)
    if ignore_time_component:
        thr = thr.cast("date")
    out = out.withColumn("threshold", thr)
    return out.filter(F.col("most_recent") < F.col("threshold"))


def sequential_values(df: DataFrame, column: str, interval: int = 1, datepart: str | None = None,
                      group_by: Sequence[str] = (), where=None) -> DataFrame:
    """Rows whose value is not the previous value + interval (first row of a group passes). Without groups the whole table
    is one sequence; it is cut into value ranges (``windows.with_range_chunk``), not sorted in one task."""
    src = _where(df, where)
    prev = "previous_" + column
    cut = None if group_by else W.with_range_chunk(src.select(column), column, "_range")
    if cut is None:
        out = src.select(*group_by, column, F.lag(F.col(column)).over(W.ordered(list(group_by), [column])).alias(prev))
    else:
        nxt = W.next_row(cut, [], [column], [column], chunk=F.col("_range"))
        out = nxt.filter("_has_next").select(F.col(f"_next_{column}").alias(column), F.col(column).alias(prev))
    if datepart:
        expect = F.timestamp_add(datepart.upper(), F.lit(int(interval)), F.col(prev).cast("timestamp_ntz"))
        return out.filter(~(F.col(column).cast("timestamp_ntz") == expect))
    return out.filter(~(F.col(column) == F.col(prev) + F.lit(interval)))


def expression_is_true(df: DataFrame, expression: str | Column, column_name: str | None = None,
                       where=None) -> DataFrame:
    e = expression if isinstance(expression, Column) else F.expr(
        f"{column_name} {expression}" if column_name else expression)
    return _where(df, where).filter(~e)


def ranges_with_next(df: DataFrame, lower: str, upper: str, partition_by: str | None = None,
                     chunk: Column | None = None) -> DataFrame:
    """(partition, lower, upper, next lower bound, is-last-record) per range: the next range in
    (lower, upper) order and whether this is the greatest range of its partition.

    ``chunk`` (e.g. ``F.date_trunc("day", lower)``): evaluate both per (partition, chunk) and
    stitch chunks (``windows.next_row``), so a partition holding a large share of all ranges
    is not one window task. Same rows as without. With neither, the whole table is one partition and is
    cut into ranges of ``lower``."""
    parts = [partition_by] if partition_by else []
    if chunk is None and not parts:
        cut = W.with_range_chunk(df.select(lower, upper), lower, "_range")
        df, chunk = (df, None) if cut is None else (cut, F.col("_range"))
    lo, hi = F.col(lower), F.col(upper)
    if chunk is None:
        from pyspark.sql import Window
        nxt = F.lead(lo).over(W.ordered(parts, [lower, upper]))
        last = F.row_number().over(Window.partitionBy(*parts).orderBy(lo.desc_nulls_last(),
                                                                      hi.desc_nulls_last())) == 1
        base = df.select(*parts, lower, upper, nxt.alias("_next"), last.alias("_last"))
    else:
        # next lower bound: ascending, NULLs last; last record: the greatest (lower, upper) with
        # NULLs smallest, i.e. no successor in ascending order with NULLs first
        a = W.next_row(df if "_range" in df.columns else df.select(*parts, lower, upper), parts, [lower, upper], [lower], chunk=chunk).drop("_has_next")
        b = W.next_row(a, parts, [lower, upper], [], chunk=chunk, nulls_first=True)
        base = b.select(*parts, lower, upper, F.col(f"_next_{lower}").alias("_next"),
                        (~F.col("_has_next")).alias("_last"))
    return base.select(*([F.col(partition_by).alias("partition_by_col")] if partition_by else []),
                       F.col(lower).alias("lower_bound"), F.col(upper).alias("upper_bound"),
                       F.col("_next").alias("next_lower_bound"), F.col("_last").alias("is_last_record"))


def mutually_exclusive_ranges(df: DataFrame, lower: str, upper: str, partition_by: str | None = None,
                              gaps: str = "allowed", zero_length_range_allowed: bool = False,
                              chunk: Column | None = None) -> DataFrame:
    """Ranges that are empty / inverted or that run into the next range of their partition
    (``chunk``: see ``ranges_with_next``)."""
    gap_ops = {"not_allowed": lambda a, b: a == b, "allowed": lambda a, b: a <= b, "required": lambda a, b: a < b}
    if gaps not in gap_ops:
        raise ValueError(f"`gaps` must be one of {sorted(gap_ops)}, got {gaps!r}")
    w = ranges_with_next(df, lower, upper, partition_by, chunk)
    ok_len = F.coalesce((F.col("lower_bound") <= F.col("upper_bound")) if zero_length_range_allowed
                        else (F.col("lower_bound") < F.col("upper_bound")), F.lit(False))
    ok_next = F.coalesce(gap_ops[gaps](F.col("upper_bound"), F.col("next_lower_bound")),
                         F.col("is_last_record"), F.lit(False))
    return w.filter(~(ok_len & ok_next))


# ---- table comparisons -----------------------------------------------------------------------------

def _counts(df: DataFrame, group_by: Sequence[str], name: str) -> DataFrame:
    return df.groupBy(*group_by).agg(F.count(F.lit(1)).alias(name)) if group_by else \
        df.agg(F.count(F.lit(1)).alias(name))


def _full_counts(a: DataFrame, b: DataFrame, group_by: Sequence[str], na: str, nb: str) -> DataFrame:
    ca = _counts(a, group_by, na).select(*[F.col(g).alias(g + "_a") for g in group_by], na)
    cb = _counts(b, group_by, nb).select(*[F.col(g).alias(g + "_b") for g in group_by], nb)
    if not group_by:
        return ca.crossJoin(cb)
    cond = None
    for g in group_by:
        c = ca[g + "_a"] == cb[g + "_b"]
        cond = c if cond is None else cond & c
    return ca.join(cb, cond, "full")


def equal_rowcount(a: DataFrame, b: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Per group: both counts and their absolute difference; the failure measure is
    ``sum(coalesce(diff_count, 0))`` (a group present on one side only counts 0)."""
    j = _full_counts(a, b, group_by, "count_a", "count_b")
    return j.withColumn("diff_count", F.abs(F.col("count_a") - F.col("count_b")))


def fewer_rows_than(a: DataFrame, b: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """``row_count_delta`` = ours - theirs when ours > theirs, 1 when equal, else 0."""
    j = _full_counts(a, b, group_by, "count_our_model", "count_comparison_model")
    o, c = F.col("count_our_model"), F.col("count_comparison_model")
    return j.withColumn("row_count_delta", F.when(o > c, o - c).when(o == c, F.lit(1)).otherwise(F.lit(0)))


def cardinality_equality(a: DataFrame, column_a: str, b: DataFrame, column_b: str) -> DataFrame:
    """Values whose row counts differ between the two tables (both directions). Both tables meet in one grouping."""
    both = a.select(F.col(column_a).alias("value_field"), F.lit(True).alias("_a")).union(
        b.select(F.col(column_b).alias("value_field"), F.lit(False).alias("_a")))
    counts = both.groupBy("value_field").agg(F.count_if("_a").alias("na"), F.count_if(~F.col("_a")).alias("nb"))
    return (counts.filter(F.col("na") != F.col("nb")).select("value_field", F.explode(F.array("na", "nb")).alias("n_records"))
            .filter(F.col("n_records") > 0))


def equality(a: DataFrame, b: DataFrame, compare_columns: Sequence[str] | None = None,
             exclude_columns: Sequence[str] = (), precision: int | None = None, strict: bool = False) -> DataFrame:
    """Rows in one table and not the other over the compared columns, numerics rounded to
    ``precision``. Without ``compare_columns`` the column sets that remain after
    ``exclude_columns`` must match (an error otherwise)."""
    left_out = {x.lower() for x in exclude_columns}
    own, other = ([c for c in df.columns if c.lower() not in left_out] for df in (a, b))
    if compare_columns is None and {c.lower() for c in own} != {c.lower() for c in other}:
        raise ValueError("equality: the two relations have different columns")
    cols = list(compare_columns or own)

    def proj(df):
        out = []
        for c in cols:
            col = F.col(c)
            if precision is not None and isinstance(df.schema[c].dataType, NumericType):
                col = F.round(col, precision)
            out.append(col.alias(c))
        return df.select(*out)

    pa, pb = proj(a), proj(b)
    diff = (lambda x, y: x.exceptAll(y)) if strict else (lambda x, y: x.subtract(y))
    return (diff(pa, pb).withColumn("which_diff", F.lit("a_minus_b"))
            .unionByName(diff(pb, pa).withColumn("which_diff", F.lit("b_minus_a"))))


# ---- singular tests -------------------------------------------------------------------------------

def no_future_timestamps(df: DataFrame, column: str, now) -> DataFrame:
    return df.filter(F.col(column) > F.lit(now).cast("timestamp_ntz"))


def cleaning_incomplete(df: DataFrame, columns: Sequence[str], tokens: Sequence[str] = WIDE_NULL_TOKENS) -> DataFrame:
    """Rows where an id still holds a null word after staging."""
    return df.filter(holds_null_word(columns, tokens))


def holds_null_word(columns: Sequence[str], tokens: Sequence[str] = WIDE_NULL_TOKENS) -> Column:
    words = [t.upper() for t in tokens if t]
    cond = None
    for c in columns:
        e = F.upper(F.trim(F.col(c))).isin(*words)
        cond = e if cond is None else cond | e
    return cond


def flags_not_null(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    return df.filter(any_null(flags))


def any_null(columns: Sequence[str]) -> Column:
    return F.exists(F.array(*[F.col(c).isNull() for c in columns]), lambda x: x)


def rowcounts_differ(a: DataFrame, b: DataFrame, name_a: str = "fact_row_count",
                     name_b: str = "obt_row_count") -> DataFrame:
    """One row holding both counts when they differ (cross join of two 1-row aggregates)."""
    ca = a.agg(F.count(F.lit(1)).alias(name_a))
    cb = b.agg(F.count(F.lit(1)).alias(name_b))
    return ca.crossJoin(cb).filter(F.col(name_a) != F.col(name_b))


def negative_values(df: DataFrame, column: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.filter(F.col(column) < 0).select(*keep, column)


def values_equal(df: DataFrame, left: str, right: str) -> DataFrame:
    """Rows where two columns hold the same value, two NULLs included (a change that changes nothing)."""
    return df.filter(F.col(left).eqNullSafe(F.col(right)))


def outside_domain(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Rows whose value is not in the set; NULL counts as outside."""
    return df.filter(is_outside(column, allowed))


def is_outside(column: str, allowed: Sequence[str]) -> Column:
    return F.coalesce(~F.col(column).isin(*allowed), F.lit(True))


def unequal(df: DataFrame, actual: str, expected: str) -> DataFrame:
    """Rows where actual != expected (NULL-unsafe: a NULL on either side passes)."""
    return df.filter(F.col(actual) != F.col(expected))


def timestamps_out_of_order(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose present (non-null) timestamps are not non-decreasing."""
    return df.filter(out_of_order(columns))


def out_of_order(columns: Sequence[str]) -> Column:
    present = F.filter(F.array(*[F.col(c) for c in columns]), lambda x: x.isNotNull())
    return present != F.array_sort(present)


def lifecycle_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose first stage is NULL, whose stage timestamps are out of order, or that have a NULL before a
    later non-null."""
    return df.filter(lifecycle_broken(columns))


def lifecycle_broken(columns: Sequence[str]) -> Column:
    arr = F.array(*[F.col(c) for c in columns])
    present = F.filter(arr, lambda x: x.isNotNull())
    n_present = F.size(present)
    # nulls only at the tail: the first size(present) entries are all present
    head_ok = F.forall(F.slice(arr, 1, F.greatest(n_present, F.lit(1))), lambda x: x.isNotNull())
    return ~head_ok | out_of_order(columns)


# ---- gates and report ---------------------------------------------------------------------------

def range_gate(df: DataFrame, ranges: dict[str, tuple[str, float | None, float | None, bool]],
               arrays: dict[str, str] | None = None) -> DataFrame:
    """One pass over ``df``: for each label, rows outside [lo, hi] (hi exclusive when the flag
    is set; a NULL is outside), and rows without an array. Returns (check, status, bad_rows)."""
    arrays = arrays or {}
    aggs = []
    for label, (c, lo, hi, hi_open) in ranges.items():
        x = F.col(c)
        ok = F.lit(True)
        if lo is not None:
            ok = ok & (x >= F.lit(lo))
        if hi is not None:
            ok = ok & ((x < F.lit(hi)) if hi_open else (x <= F.lit(hi)))
        aggs.append(F.count_if(~F.coalesce(ok, F.lit(False))).alias(label))
    aggs += [F.count_if(F.col(c).isNull()).alias(label) for label, c in arrays.items()]
    wide = df.agg(*aggs)
    long = wide.unpivot([], [F.col(f"`{x}`") for x in [*ranges, *arrays]], "check", "bad_rows")
    return long.select("check", F.when(F.col("bad_rows") == 0, "PASS").otherwise("FAIL").alias("status"),
                       F.col("bad_rows").cast("bigint").alias("bad_rows"))


def pk_fk_gate(tables: dict[str, tuple[DataFrame, str]],
               foreign_keys: dict[tuple[str, str], tuple[str, str]]) -> DataFrame:
    """PK not-null + unique per table, FK orphans per declared key (a NULL is an orphan), as one report.

    Every table is read once: a row gives its own key and its foreign keys, each under the table whose
    key it is. One aggregate per (table, key value) counts owners and references; what is missing,
    repeated or unowned follows from those counts."""
    def entry(domain: str, c: str, role: int) -> Column:
        return F.struct(F.lit(domain).alias("domain"), F.col(c).cast("string").alias("v"), F.lit(role).alias("role"))

    links = [(child, col, parent, pcol) for (child, col), (parent, pcol) in foreign_keys.items()]
    for _, _, parent, pcol in links:
        if tables[parent][1] != pcol:
            raise ValueError(f"{parent}.{pcol} is not the table's key")
    stacked = None
    for name, (df, pk) in tables.items():
        own = [entry(name, pk, -1)] + [entry(parent, col, i) for i, (child, col, parent, _) in enumerate(links) if child == name]
        rows = df.select(F.explode(F.array(*own)).alias("e")).select("e.*")
        stacked = rows if stacked is None else stacked.unionByName(rows)
    counts = stacked.groupBy("domain", "v").agg(
        F.count_if(F.col("role") == -1).alias("owners"),
        *[F.count_if(F.col("role") == i).alias(f"r{i}") for i in range(len(links))])
    v, owners = F.col("v"), F.col("owners")
    sums: dict[str, Column] = {}
    for name, (_, pk) in tables.items():
        here = F.col("domain") == name
        sums[f"{name}.{pk} not null (PK)"] = F.sum(F.when(here & v.isNull(), owners).otherwise(0))
        sums[f"{name}.{pk} unique (PK)"] = F.sum(F.when(here & v.isNotNull() & (owners > 0), owners - 1).otherwise(0))
    for i, (child, col, parent, pcol) in enumerate(links):
        lost = (F.col("domain") == parent) & (v.isNull() | (owners == 0))
        sums[f"{child}.{col} -> {parent}.{pcol} (FK)"] = F.sum(F.when(lost, F.col(f"r{i}")).otherwise(0))
    wide = counts.agg(*[F.coalesce(c, F.lit(0)).cast("bigint").alias(label) for label, c in sums.items()])
    long = wide.unpivot([], [F.col(f"`{label}`") for label in sums], "check", "bad_rows")
    return long.select("check", F.when(F.col("bad_rows") == 0, "PASS").otherwise("FAIL").alias("status"), "bad_rows")


class Total(str):
    """A failure measure that is an aggregate (SQL text) of a test's rows, not a column to sum."""


#: The failure measure of ``equality``: the rows that differ, and by how much one side has more of them.
EQUALITY_MEASURE = Total("count(*) + coalesce(abs(count_if(which_diff = 'a_minus_b') - count_if(which_diff = 'b_minus_a')), 0)")


def failure_count(result: DataFrame, measure: str | Column | None = None) -> DataFrame:
    """One-row failure measure of a test result: row count, ``sum(measure)``, or the aggregate of a ``Total``."""
    if isinstance(measure, Total):
        m = F.expr(measure)
    else:
        m = F.count(F.lit(1)) if measure is None else F.coalesce(F.sum(_c(measure)), F.lit(0))
    return result.agg(m.cast("bigint").alias("failures"))


@dataclass(frozen=True)
class Rows:
    """A test of single rows: fails once for every row of ``table`` where ``broken`` holds."""

    table: DataFrame
    broken: Column


@dataclass(frozen=True)
class Groups:
    """A test of groups: ``sums`` are aggregates of ``table`` per ``keys``; a group where ``broken`` holds fails by
    ``measure`` (one without). Both are given the aggregates by name."""

    table: DataFrame
    keys: tuple[str, ...]
    sums: dict[str, Column]
    broken: Callable[[dict[str, Column]], Column]
    measure: Callable[[dict[str, Column]], Column] | None = None


def _long(wide: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row of counts -> (test, failures)."""
    return wide.select(F.explode(F.array(*[F.struct(F.lit(n).alias("test"), F.coalesce(F.col(f"`{n}`"), F.lit(0)).cast("bigint").alias("failures"))
                                           for n in names])).alias("r")).select("r.*")


def counted(tests: dict[str, Rows | Groups]) -> list[DataFrame]:
    """(test, failures) of the tests, compiled to one aggregate for all row tests of a table and one grouping for
    all group tests of a table and its keys, with a total over the groups. Tests share a table if they
    are given the same DataFrame."""
    out: list[DataFrame] = []
    tables: dict[int, dict[str, Rows]] = {}
    groupings: dict[tuple, dict[str, Groups]] = {}
    for name, t in tests.items():
        if isinstance(t, Rows):
            tables.setdefault(id(t.table), {})[name] = t
        else:
            groupings.setdefault((id(t.table), t.keys), {})[name] = t
    for own in tables.values():
        table = next(iter(own.values())).table
        out.append(_long(table.agg(*[F.count_if(t.broken).alias(n) for n, t in own.items()]), list(own)))
    for (_, keys), own in groupings.items():
        table = next(iter(own.values())).table
        aggs = [c.alias(f"{n}.{k}") for n, t in own.items() for k, c in t.sums.items()]
        grouped = table.groupBy(*keys).agg(*aggs) if aggs else table.select(*keys).distinct()
        fails = []
        for n, t in own.items():
            by = {k: F.col(f"`{n}.{k}`") for k in t.sums} | {k: F.col(k) for k in keys}
            fails.append(F.sum(F.when(t.broken(by), t.measure(by) if t.measure else F.lit(1))).alias(n))
        out.append(_long(grouped.agg(*fails), list(own)))
    return out


def report(results: dict[str, tuple[DataFrame, str | Column | None] | Rows | Groups], warn_if: str = "!= 0",
           error_if: str = "!= 0") -> DataFrame:
    """(test, failures, status) for many tests as one union of aggregates: tests given as ``Rows`` or ``Groups`` share
    passes (``counted``), those given as (violating rows, measure) have a plan each. Thresholds follow
    the ``warn_if`` / ``error_if`` convention ('!= 0', '> 10', ...)."""
    parts = [failure_count(t[0], t[1]).select(F.lit(name).alias("test"), "failures") for name, t in results.items() if isinstance(t, tuple)]
    parts += counted({n: t for n, t in results.items() if not isinstance(t, tuple)})
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    err = F.expr(f"failures {error_if}")
    warn = F.expr(f"failures {warn_if}")
    return out.withColumn("status", F.when(err, "ERROR").when(warn, "WARN").otherwise("PASS"))
