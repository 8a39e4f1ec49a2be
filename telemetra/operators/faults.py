"""Deterministic fault and dirt injection, and robust repair of unit / spike errors.

Row selection uses ``md5(key ':' seed)``: hex digits of the digest decide whether and how a
row is touched, so the same rows are chosen on any cluster layout (no driver-side sampling,
no global sort). Rates are realised approximately; the manifest reports exact counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


HEX = "0123456789abcdef"
# Tokens the dirt generator writes for a missing value (fixed values):
DIRT_NULL_TOKENS = ("null", "N/A", "", "nan", "None", "-", "NA", "n/a", "NaN", "#N/A")


def row_hash(keys: Sequence[str], seed: int) -> Column:
    return F.md5(F.concat_ws(":", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


def hex_digit(h: Column, pos: int) -> Column:
    """Value 0..15 of the hex digit at 1-based ``pos``."""
    return F.instr(F.lit(HEX), F.substring(h, pos, 1)) - 1


def threshold(rate: float, digits: int = 4) -> str:
    """Hex prefix below which a ``digits``-wide prefix of the digest falls with probability ~rate."""
    return format(int(rate * 16 ** digits), f"0{digits}x")


def below(h: Column, pos: int, rate: float, digits: int = 4) -> Column:
    return F.substring(h, pos, digits) < F.lit(threshold(rate, digits))


def inject_faults(df: DataFrame, key: str, ts_col: str, null_fields: Sequence[str], seed: int = 42,
                  dup_rate: float = 0.02, null_rate: float = 0.01, late_rate: float = 0.005,
                  max_late_hours: int = 48) -> tuple[DataFrame, DataFrame]:
    """Duplicate ~dup_rate of rows, NULL one of ``null_fields`` in ~null_rate, shift ~late_rate
    back by 1..max_late_hours hours. Returns (faulted rows, one-row manifest of exact counts).
    Duplicates are copies of the already faulted row."""
    h = row_hash([key], seed)
    marked = df.withColumns({
        "_h": h,
        "_dup": below(h, 1, dup_rate),
        "_null": below(h, 5, null_rate),
        "_late": below(h, 9, late_rate),
    })
    which = hex_digit(F.col("_h"), 13) % len(null_fields)
    hours = (hex_digit(F.col("_h"), 14) * 16 + hex_digit(F.col("_h"), 15)) % max_late_hours + 1
    changes = {f: F.when(F.col("_null") & (which == i), F.lit(None).cast(df.schema[f].dataType)).otherwise(F.col(f))
               for i, f in enumerate(null_fields)}
    changes[ts_col] = F.when(F.col("_late"), F.timestamp_add("HOUR", -hours, F.col(ts_col))).otherwise(F.col(ts_col))
    faulted = marked.withColumns(changes)
    out = faulted.unionByName(faulted.filter(F.col("_dup")))
    manifest = marked.agg(F.count_if("_dup").alias("duplicates_injected"),
                          F.count_if("_null").alias("nulled_scalars_injected"),
                          F.count_if("_late").alias("late_rows_injected"))
    return out.drop("_h", "_dup", "_null", "_late"), manifest


def _title(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 20)))


def inject_dirt(text: DataFrame, key: str, numeric: Sequence[str], ids: Sequence[str], categorical: Sequence[str],
                temps: Sequence[str], ts_col: str, negative_field: str, seed: int = 7, rate: float = 0.08,
                kind_rate: float = 5 / 16) -> DataFrame:
    """Raw-text dirt on ~``rate`` of the rows (all columns text). Each dirty row gets each of
    these kinds with probability ``kind_rate``: null token in a numeric field, casing on
    categoricals, padding on ids, Celsius written as Fahrenheit, a 5-20x spike, an alternative
    timestamp layout (US, EU without seconds, epoch seconds, 12-hour, zone dropped), a
    negative value, a junk column and a near-duplicate column."""
    h = row_hash([key], seed)
    # the digest's digits and the per-kind decisions are derived once per row as columns
    digits = {f"_d{p}": hex_digit(F.col("_h"), p) for p in range(3, 23)}
    d = text.withColumn("_h", h).withColumns(digits)
    d = d.withColumn("_dirty", F.substring(F.col("_h"), 1, 2) < F.lit(threshold(rate, 2)))
    d = d.withColumns({f"_k{k}": F.col("_dirty") & (F.col(f"_d{3 + k}") < F.lit(int(kind_rate * 16)))
                       for k in range(10)})
    hd = lambda p: F.col(f"_d{p}")
    kind = lambda k: F.col(f"_k{k}")
    num = lambda c: F.col(c).try_cast("double")
    out: dict[str, Column] = {c: F.col(c) for c in text.columns}

    # 3 unit confusion, 4 spike, 6 negative: numeric rewrites (applied on the clean value)
    for c in temps:
        out[c] = F.when(kind(3), (num(c) * F.lit(1.8) + F.lit(32.0)).cast("string")).otherwise(out[c])
    spike_field = hd(18) % len(numeric)
    for i, c in enumerate(numeric):
        out[c] = F.when(kind(4) & (spike_field == i),
                        (num(c) * (F.lit(5.0) + hd(19).cast("double"))).cast("string")).otherwise(out[c])
    out[negative_field] = F.when(kind(6), (-F.abs(num(negative_field))).cast("string")).otherwise(out[negative_field])
    # 0 null token into one numeric field (after the rewrites: the token wins)
    tok = F.element_at(F.array(*[F.lit(t) for t in DIRT_NULL_TOKENS]), (hd(14) % len(DIRT_NULL_TOKENS) + 1).cast("int"))
    field = hd(13) % len(numeric)
    for i, c in enumerate(numeric):
        out[c] = F.when(kind(0) & (field == i), tok).otherwise(out[c])
    # 1 casing, 2 padding
    for c in categorical:
        out[c] = F.when(kind(1), F.when(hd(15) % 2 == 0, F.lower(F.col(c))).otherwise(_title(F.col(c)))).otherwise(out[c])
    pad = lambda n: F.repeat(F.lit(" "), n)
    for c in ids:
        out[c] = F.when(kind(2), F.concat(pad(hd(16) % 4), F.col(c), pad(hd(17) % 4))).otherwise(out[c])
    # 5 timestamp layouts
    ts = F.col(ts_col).try_cast("timestamp_ntz")
    layout = hd(20) % 5
    alt = (F.when(layout == 0, F.date_format(ts, "MM/dd/yyyy HH:mm:ss"))
           .when(layout == 1, F.date_format(ts, "dd-MM-yyyy HH:mm"))
           .when(layout == 2, F.unix_seconds(ts.cast("timestamp")).cast("string"))
           .when(layout == 3, F.date_format(ts, "yyyy/MM/dd hh:mm:ss a"))
           .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss")))
    out[ts_col] = F.when(kind(5), alt).otherwise(out[ts_col])
    # 7 junk column, 9 near-duplicate column
    out["debug_flag"] = F.when(kind(7), F.when(hd(21) % 2 == 0, tok).otherwise((hd(22) * 7 - 50).cast("string")))
    out["motor_temp"] = F.when(kind(9), F.col("motor_temp_c"))
    return d.select(*[v.alias(k) for k, v in out.items()])


#: Value cells per doubling of a value's size.
CELLS = 4096


def value_cell(x: Column) -> Column:
    """A cell number that never falls as the value grows: about 0.02 % wide for a number of any size; zero,
    infinities and NaN (largest) have cells of their own."""
    size = F.floor(F.log2(F.abs(x)) * CELLS).cast("long") + F.lit(2000 * CELLS)
    return (F.when(F.isnan(x), F.lit(1 << 40)).when(x == 0, F.lit(0)).when(F.abs(x) == float("inf"), F.signum(x).cast("long") * (1 << 39))
            .otherwise(F.signum(x).cast("long") * size))


def exact_median(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Exact lower median per key: the first value whose running count reaches half of the key's values.

    1. A histogram of value cells per key (partial sums, so a hot key sends a row per task and cell).
    2. Running counts over a key's cells name the cell that holds the median and what lies before it.
    3. Only the values of that cell are looked at again: their distinct values are counted and ranked.
    No window runs over a key's values; the ranked rows are the distinct values of a cell 0.02 % wide."""
    x = F.col(value).cast("double")
    rows = df.filter(F.col(value).isNotNull()).select(F.col(key).alias("_k"), x.alias("_x")).withColumn("_cell", value_cell(F.col("_x")))
    upto = F.sum("_n").over(Window.partitionBy("_k").orderBy("_cell"))
    middle = (rows.groupBy("_k", "_cell").agg(F.count(F.lit(1)).alias("_n"))
              .select("_k", "_cell", "_n", upto.alias("_upto"), F.sum("_n").over(Window.partitionBy("_k")).alias("_all"))
              .filter((2 * F.col("_upto") >= F.col("_all")) & (2 * (F.col("_upto") - F.col("_n")) < F.col("_all")))
              .select(F.col("_k").alias("_mk"), F.col("_cell").alias("_mcell"), (F.col("_upto") - F.col("_n")).alias("_before"), "_all"))
    inside = (rows.join(middle, (F.col("_k") == F.col("_mk")) & (F.col("_cell") == F.col("_mcell")))
              .groupBy("_k", "_x", "_before", "_all").agg(F.count(F.lit(1)).alias("_n")))
    rank = F.col("_before") + F.sum("_n").over(Window.partitionBy("_k").orderBy("_x"))
    return (inside.select("_k", "_x", "_all", rank.alias("_upto")).filter(2 * F.col("_upto") >= F.col("_all"))
            .groupBy(F.col("_k").alias(key)).agg(F.min("_x").alias(name)))


def robust_repair(df: DataFrame, key: str, value: str, k: float = 3.5) -> DataFrame:
    """Flag values far from their group's median (|x - median| > k * MAD) and repair them:
    a value that lands inside the band once read as Fahrenheit is converted back to Celsius,
    any other outlier (a spike) becomes NULL.

    Medians are exact at any group size (``exact_median``); the per-key statistics are joined back. ``df`` is read five
    times: store it first if its rows are costly."""
    x = F.col(value)
    med = exact_median(df, key, value, "median")
    dev = df.select(key, value).join(med, key).select(key, F.abs(x - F.col("median")).alias("_dev"))
    stats = med.join(exact_median(dev, key, "_dev", "mad"), key)
    j = df.join(stats, key, "left")
    band = F.lit(k) * F.col("mad")
    outlier = F.coalesce(F.abs(x - F.col("median")) > band, F.lit(False))
    as_c = (x - F.lit(32.0)) / F.lit(1.8)
    fahrenheit = outlier & (F.abs(as_c - F.col("median")) <= band)
    return j.withColumns({
        "is_outlier": outlier,
        "repair_kind": F.when(fahrenheit, "FAHRENHEIT").when(outlier, "SPIKE"),
        f"{value}_repaired": F.when(fahrenheit, as_c).when(outlier, F.lit(None)).otherwise(x),
    })
