"""Relational operators of the macro library, as DataFrame -> DataFrame functions."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from telemetra.operators.windows import first_per_group

# Name of the source column added by union_relations (fixed value, kept for parity):
SOURCE_COLUMN = "_dbt_source_relation"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def deduplicate(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """One row per ``partition_by`` group: the first under ``order_by``. Rows with NULL keys are
    kept (grouped together), unlike the natural-join form that drops them."""
    return first_per_group(df, partition_by, list(order_by))


def slugify(s: str) -> str:
    """A lower-case name of letters, digits and underscores: words are joined by an underscore,
    other characters dropped, and a name that would begin with a digit gets an underscore first."""
    words = re.split("[ -]", s.lower())
    parts = ["".join(re.findall("[a-z0-9_]", w)) for w in words if w]
    lead, trail = words[0] == "" and bool(s), len(words) > 1 and words[-1] == ""
    name = "_" * lead + "_".join(parts) + "_" * (trail and bool(parts))
    return "_" + name if name[:1].isdigit() else name


def column_values(df: DataFrame, column: str, order_by: str = "count", max_records: int | None = None,
                  where: str | Column | None = None) -> DataFrame:
    """Distinct values of ``column`` with their frequency, most frequent first (value breaks
    ties), optionally filtered and capped at ``max_records`` (a top-k report)."""
    src = df.filter(where) if where is not None else df
    out = src.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    if order_by == "count":
        out = out.orderBy(F.col("n").desc(), F.col("value").asc_nulls_last())
    else:
        out = out.orderBy(F.col("value").asc_nulls_last())
    return out if max_records is None else out.limit(max_records)


def column_values_list(df: DataFrame, column: str, max_records: int | None = None, default=None,
                       where=None) -> list:
    """The values as a Python list (used to name pivot columns); all of them unless the caller asks for
    the ``max_records`` most frequent."""
    vals = [r["value"] for r in column_values(df, column, max_records=max_records, where=where).collect()]
    return vals if vals else list(default or [])


def pivot(df: DataFrame, group_by: Sequence[str], column: str, values: Iterable | None = None,
          agg: str = "sum", cmp: str = "=", prefix: str = "", suffix: str = "", then_value=1,
          else_value=0, quote_identifiers: bool = True, distinct: bool = False) -> DataFrame:
    """Rows -> columns: ``agg(case when column <cmp> value then then_value else else_value end)``
    per value, as one hash aggregate (a single pass; no join per value)."""
    if values is None:
        values = column_values_list(df, column)
    ops = {"=": lambda c, v: c == v, "!=": lambda c, v: c != v, "<>": lambda c, v: c != v,
           "<": lambda c, v: c < v, "<=": lambda c, v: c <= v, ">": lambda c, v: c > v,
           ">=": lambda c, v: c >= v}
    aggs = {"sum": F.sum, "max": F.max, "min": F.min, "count": F.count, "avg": F.avg}
    exprs = []
    for v in values:
        e = F.when(ops[cmp](F.col(column), F.lit(v)), _lit(then_value)).otherwise(_lit(else_value))
        a = (F.count_distinct(e) if agg == "count" else F.sum_distinct(e)) if distinct else aggs[agg](e)
        name = f"{prefix}{v}{suffix}"
        exprs.append(a.alias(name if quote_identifiers else slugify(name)))
    return df.groupBy(*group_by).agg(*exprs)


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def unpivot(df: DataFrame, cast_to: str = "string", exclude: Sequence[str] = (), remove: Sequence[str] = (),
            field_name: str = "field_name", value_name: str = "value") -> DataFrame:
    """Columns -> rows (NULLs kept). One scan: Spark plans ``unpivot`` as an Expand node,
    where the SQL form needs one scan per column."""
    drop = {c.lower() for c in list(exclude) + list(remove)}
    cols = [f for f in df.schema.fields if f.name.lower() not in drop]

    def as_text(f):
        c = F.col(f.name)
        if isinstance(f.dataType, BooleanType):
            c = F.when(c, F.lit("true")).when(~c, F.lit("false"))
        return c.cast(cast_to).alias(f.name)

    casted = df.select(*exclude, *[as_text(f) for f in cols])
    return casted.unpivot(list(exclude), [f.name for f in cols], field_name, value_name)


def union_relations(relations: dict[str, DataFrame], include: Sequence[str] = (), exclude: Sequence[str] = (),
                    column_override: dict[str, str] | None = None,
                    source_column_name: str | None = SOURCE_COLUMN, where: str | None = None) -> DataFrame:
    """Union over a column superset in first-seen order; a column missing from a relation is a
    typed NULL; optional include or exclude list (not both), type overrides, source label."""
    if include and exclude:
        raise ValueError("give either columns to include or columns to exclude, not both")
    override = {k.lower(): v for k, v in (column_override or {}).items()}
    order: list[str] = []
    types: dict[str, str] = {}
    for df in relations.values():
        for f in df.schema.fields:
            key = f.name.lower()
            if include and key not in {c.lower() for c in include}:
                continue
            if key in {c.lower() for c in exclude}:
                continue
            if key not in types:
                order.append(f.name)
                types[key] = override.get(key, f.dataType.simpleString())
    parts = []
    for name, df in relations.items():
        have = {f.name.lower(): f.name for f in df.schema.fields}
        cols = []
        if source_column_name:
            cols.append(F.lit(name).cast("string").alias(source_column_name))
        for c in order:
            k = c.lower()
            src = F.col(have[k]) if k in have else F.lit(None)
            cols.append(src.cast(types[k]).alias(c))
        p = df.select(*cols)
        parts.append(p.filter(where) if where else p)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def star(df: DataFrame, except_: Sequence[str] = (), relation_alias: str | None = None, prefix: str = "",
         suffix: str = "") -> DataFrame:
    """All columns except a list, optionally renamed with prefix / suffix."""
    drop = {c.lower() for c in except_}
    keep = [c for c in df.columns if c.lower() not in drop]
    if not keep:
        raise ValueError("star() would select no column")
    src = df.alias(relation_alias) if relation_alias else df
    return src.select(*[F.col(f"{relation_alias}.{c}" if relation_alias else c).alias(f"{prefix}{c}{suffix}")
                        for c in keep])


def nullcheck_table(df: DataFrame) -> DataFrame:
    """Every string column: '' -> NULL (no trim); other columns unchanged."""
    return df.select(*[F.nullif(F.col(f.name), F.lit("")).alias(f.name)
                       if f.dataType.simpleString() == "string" else F.col(f.name) for f in df.schema.fields])


def generate_series(spark: SparkSession, upper_bound: int, num_partitions: int | None = None) -> DataFrame:
    """1..upper_bound as ``generated_number``: a distributed range, not a chain of cross joins."""
    return spark.range(1, int(upper_bound) + 1, numPartitions=num_partitions).select(
        F.col("id").alias("generated_number"))


def periods_between(datepart: str, start, end) -> int:
    """Boundaries of ``datepart`` crossed from ``start`` to ``end`` (weeks begin on Monday)."""
    import datetime as dt

    def when(x):
        return x if isinstance(x, dt.datetime) else dt.datetime.combine(x, dt.time())
    start, end = when(start), when(end)
    days = end.toordinal() - start.toordinal()
    count = {
        "second": lambda: int((end.replace(microsecond=0) - start.replace(microsecond=0)).total_seconds()),
        "minute": lambda: int((end.replace(second=0, microsecond=0) - start.replace(second=0, microsecond=0)).total_seconds()) // 60,
        "hour": lambda: days * 24 + end.hour - start.hour,
        "day": lambda: days,
        "week": lambda: (end.toordinal() - 1) // 7 - (start.toordinal() - 1) // 7,
        "month": lambda: (end.year - start.year) * 12 + end.month - start.month,
        "quarter": lambda: (end.year - start.year) * 4 + (end.month - 1) // 3 - (start.month - 1) // 3,
        "year": lambda: end.year - start.year,
    }
    if datepart.lower() not in count:
        raise ValueError(f"unsupported datepart {datepart}")
    return count[datepart.lower()]()


def date_spine(spark: SparkSession, datepart: str, start, end, num_partitions: int | None = None) -> DataFrame:
    """``start``, ``start`` + 1 ``datepart``, ... : as many rows as boundaries of the part lie between the
    bounds, less those that reach ``end``. Dates for day and longer, else timestamps."""
    part = datepart.lower()
    n = periods_between(part, start, end)
    at = F.timestamp_add(part.upper(), F.col("id"), F.lit(start).cast("timestamp_ntz"))
    out = spark.range(0, max(n, 0), numPartitions=num_partitions).select(at.alias("date_" + part))
    out = out.filter(F.col("date_" + part) <= F.lit(end).cast("timestamp_ntz"))
    return out if part in ("hour", "minute", "second") else out.select(F.col("date_" + part).cast("date"))


def single_value(df: DataFrame, expr: Column | str | None = None, default=None) -> DataFrame:
    """A one-row, one-column frame: the first value of ``expr`` (or of the first column), or
    ``default`` when there is no row. Cross-join it where a scalar subquery would go."""
    col = _col(expr) if expr is not None else F.col(df.columns[0])
    one = df.select(col.alias("value")).limit(1)
    return one.agg(F.coalesce(F.first("value"), F.lit(default)).alias("value"))


def except_both_ways(a: DataFrame, b: DataFrame, strict: bool = False, label: str = "which_diff") -> DataFrame:
    """Rows of a not in b and of b not in a, labelled. ``strict`` compares multisets."""
    diff = (lambda x, y: x.exceptAll(y)) if strict else (lambda x, y: x.subtract(y))
    return (diff(a, b).withColumn(label, F.lit("a_minus_b"))
            .unionByName(diff(b, a).withColumn(label, F.lit("b_minus_a"))))
