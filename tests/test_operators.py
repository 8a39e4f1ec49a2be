"""Operators on literal rows: SCD2, point-in-time join, labels, relational macros, assertions."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from telemetra.operators import quality as Q
from telemetra.operators import relational as R
from telemetra.operators import scd
from telemetra.operators import windows as W
from telemetra.operators.joins import pit_join, pit_merge

T = dt.datetime
D = dt.date


@pytest.fixture
def robots(spark):
    return spark.createDataFrame([("r1", "z1", "fw1", D(2024, 1, 1)), ("r2", "z2", "fw1", D(2024, 1, 5))],
                                 "robot_id string, zone_id string, fw string, since date")


@pytest.fixture
def changes(spark):
    return spark.createDataFrame([
        ("c1", "r1", T(2024, 1, 2), "ZONE", "z9"),
        ("c2", "r1", T(2024, 1, 3), "ZONE", "z3"),   # lexicographically smaller than z9
        ("c3", "r1", T(2024, 1, 3), "FIRMWARE", "fw2"),  # same instant: tie broken by change id
        ("c4", "rX", T(2024, 1, 3), "ZONE", "z1"),   # unknown robot: dropped by the inner join
        ("c5", "r2", None, "ZONE", "z5"),            # unparsed time: ignored
    ], "change_id string, robot_id string, changed_at timestamp_ntz, attribute string, new_value string")


def _scd(robots, changes, mode):
    return scd.build_scd2(robots, changes, "robot_id", {"ZONE": "zone_id", "FIRMWARE": "fw"}, "since",
                          mode=mode).orderBy("robot_id", "valid_from", "zone_id").collect()


def test_scd2_latest(robots, changes):
    rows = _scd(robots, changes, "latest")
    r1 = [(r.zone_id, r.fw, r.valid_from, r.valid_to, r.is_current) for r in rows if r.robot_id == "r1"]
    assert r1[0] == ("z1", "fw1", T(2024, 1, 1), T(2024, 1, 2), False)
    assert r1[1] == ("z9", "fw1", T(2024, 1, 2), T(2024, 1, 3), False)
    assert r1[2] == ("z3", "fw1", T(2024, 1, 3), T(2024, 1, 3), False)  # c2 before c3 at the same instant
    assert r1[3] == ("z3", "fw2", T(2024, 1, 3), T(9999, 12, 31), True)
    r2 = [r for r in rows if r.robot_id == "r2"]
    assert len(r2) == 1 and r2[0].is_current and r2[0].valid_to == T(9999, 12, 31)


def test_scd2_running_max_keeps_lexicographic_max(robots, changes):
    rows = [r for r in _scd(robots, changes, "running_max") if r.robot_id == "r1"]
    assert [r.zone_id for r in rows] == ["z1", "z9", "z9", "z9"]


def test_pit_join_half_open(spark):
    dim = spark.createDataFrame([("a", T(2024, 1, 1), T(2024, 1, 2), 1), ("a", T(2024, 1, 2), T(9999, 12, 31), 2)],
                                "k string, valid_from timestamp_ntz, valid_to timestamp_ntz, v int")
    fact = spark.createDataFrame([("a", T(2024, 1, 2)), ("a", T(2023, 12, 31)), ("b", T(2024, 1, 5))],
                                 "key string, ts timestamp_ntz")
    out = pit_join(fact, dim, key="key", dim_key="k", ts="ts").orderBy("ts").collect()
    assert [(r.key, r.v) for r in out] == [("a", None), ("a", 2), ("b", None)]


def test_pit_join_equals_the_plain_join_with_many_and_overlapping_versions(spark):
    dim = (spark.range(5000).select(F.lit("a").alias("k"), F.timestamp_add("HOUR", F.col("id"), F.lit(T(2024, 1, 1))).alias("valid_from"),
                                    F.timestamp_add("HOUR", F.col("id") + F.col("id") % 3 + 1, F.lit(T(2024, 1, 1))).alias("valid_to"),
                                    F.col("id").alias("v"))
           .unionByName(spark.createDataFrame([("a", T(2024, 1, 1), T(2024, 2, 1), -1), ("a", T(2024, 1, 5), T(2024, 1, 6), -2)],
                                              "k string, valid_from timestamp_ntz, valid_to timestamp_ntz, v long")))
    fact = spark.createDataFrame([("a", T(2024, 1, 1) + dt.timedelta(minutes=37 * i)) for i in range(300)] + [("b", T(2024, 1, 5)), (None, None)],
                                 "key string, ts timestamp_ntz")
    plain = "SELECT * FROM f {how} JOIN d ON f.key = d.k AND f.ts >= d.valid_from AND f.ts < d.valid_to"
    fact.createOrReplaceTempView("f")
    dim.createOrReplaceTempView("d")
    for how in ("left", "inner"):
        got, want = pit_join(fact, dim, "key", "ts", dim_key="k", how=how), spark.sql(plain.format(how=how))
        assert got.count() == want.count() and got.exceptAll(want).count() == 0
    fact7 = spark.createDataFrame([("a", T(2024, 1, 7))], "key string, ts timestamp_ntz")
    two = dim.filter("v < 0")
    assert [r.v for r in pit_join(fact7, two, "key", "ts", dim_key="k").collect()] == [-1]
    spark.catalog.dropTempView("f")
    spark.catalog.dropTempView("d")


def test_repair_is_exact_at_any_group_size(spark):
    from telemetra.operators import faults as X
    df = spark.range(200_000).select(F.lit("r").alias("k"), (F.rand(5) * 40).alias("x"))
    values = sorted(r[0] for r in df.select("x").collect())
    got = X.robust_repair(df, "k", "x").select("median", "mad").distinct().collect()
    median = values[(len(values) + 1) // 2 - 1]
    assert [(r.median, r.mad) for r in got] == [(median, sorted(abs(v - median) for v in values)[(len(values) + 1) // 2 - 1])]


def test_rules_follow_the_contract_text(spark):
    now = T(2024, 1, 10)
    df = spark.createDataFrame([("a", T(2024, 1, 1)), ("b", None), ("c", T(2024, 1, 9, 12))], "g string, t timestamp_ntz")
    assert [r.g for r in Q.recency(df, "t", "day", 1, now, group_by=["g"]).collect()] == ["a"]  # most_recent < threshold only
    ch = spark.createDataFrame([("1", None, None), ("2", "x", "y"), ("3", "x", "x")], "id string, o string, n string")
    assert sorted(r.id for r in Q.values_equal(ch, "o", "n").collect()) == ["1", "3"]
    lc = spark.createDataFrame([(1, None, None), (2, T(2024, 1, 1), None), (3, None, T(2024, 1, 1))], "id int, a timestamp_ntz, b timestamp_ntz")
    assert sorted(r.id for r in Q.lifecycle_violations(lc, ["a", "b"]).collect()) == [1, 3]
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(1, 3)], "x int, z int")
    assert Q.equality(a, b, exclude_columns=["y", "z"]).count() == 0
    with pytest.raises(ValueError):
        Q.equality(a, b)


def test_lookahead_label_fan_out_and_defanned(spark):
    daily = spark.createDataFrame([("r", D(2024, 1, d)) for d in range(1, 11)], "k string, day date")
    fails = spark.createDataFrame([("r", D(2024, 1, 8)), ("r", D(2024, 1, 9))], "k string, fday date")
    fan = scd.lookahead_label(daily, fails, "k", "day", "fday", 7, fan_out=True)
    one = scd.lookahead_label(daily, fails, "k", "day", "fday", 7, fan_out=False)
    # day 1 is within 7 days before the 8th; days 2..7 before both; day 8 before the 9th only
    counts = {r.day.day: r["count"] for r in fan.groupBy("day").count().collect()}
    assert counts[1] == 1 and counts[2] == 2 and counts[7] == 2 and counts[8] == 1 and counts[9] == 1
    labels = {r.day.day: r.label for r in one.collect()}
    assert one.count() == 10
    assert [labels[d] for d in range(1, 11)] == [1, 1, 1, 1, 1, 1, 1, 1, 0, 0]


def test_overlaps(spark):
    v = spark.createDataFrame([("a", T(2024, 1, 1), T(2024, 1, 5)), ("a", T(2024, 1, 4), T(2024, 1, 9)),
                               ("b", T(2024, 1, 1), T(2024, 1, 2)), ("b", T(2024, 1, 2), T(2024, 1, 3))],
                              "robot_id string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    assert scd.overlapping_versions(v, "robot_id").count() == 2  # (a1, a2) and (a2, a1)
    assert [r.robot_id for r in scd.overlaps_by_lead(v, "robot_id").collect()] == ["a"]


def test_dedup_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("x", 3), ("x", 1)], "k string, v int")
    out = R.deduplicate(df, ["k"], [F.col("v").desc()]).orderBy("v").collect()
    assert [(r.k, r.v) for r in out] == [(None, 2), ("x", 3)]


def test_pivot_options(spark):
    df = spark.createDataFrame([("S", "red"), ("S", "blue"), ("M", "red")], "size string, color string")
    out = {r["size"]: r for r in R.pivot(df, ["size"], "color", ["red", "blue"]).collect()}
    assert (out["S"]["red"], out["S"]["blue"], out["M"]["blue"]) == (1, 1, 0)
    neq = R.pivot(df, ["size"], "color", ["red"], cmp="!=", agg="max", prefix="not_", else_value=None)
    assert {r["size"]: r["not_red"] for r in neq.collect()} == {"S": 1, "M": None}
    slug = R.pivot(df, ["size"], "color", ["Red Color"], quote_identifiers=False)
    assert "red_color" in slug.columns


def test_unpivot_keeps_nulls_and_booleans(spark):
    df = spark.createDataFrame([(1, None, True)], "id int, name string, ok boolean")
    out = {r.field_name: r.value for r in R.unpivot(df, exclude=["id"]).collect()}
    assert out == {"name": None, "ok": "true"}


def test_union_relations(spark):
    a = spark.createDataFrame([(1, "x")], "id int, name string")
    b = spark.createDataFrame([(2, 3.5)], "ID int, score double")
    u = R.union_relations({"a": a, "b": b})
    assert u.columns == ["_dbt_source_relation", "id", "name", "score"]
    assert sorted((r.id, r.name, r.score) for r in u.collect()) == [(1, "x", None), (2, None, 3.5)]
    assert R.union_relations({"a": a, "b": b}, include=["id"], source_column_name=None).columns == ["id"]
    with pytest.raises(ValueError):
        R.union_relations({"a": a}, include=["id"], exclude=["name"])


def test_date_spine_end_excluded(spark):
    days = R.date_spine(spark, "day", D(2018, 1, 1), D(2018, 1, 10))
    assert days.count() == 9
    months = R.date_spine(spark, "month", D(2018, 1, 1), D(2018, 4, 1)).collect()
    assert [r[0] for r in months] == [D(2018, 1, 1), D(2018, 2, 1), D(2018, 3, 1)]
    hours = R.date_spine(spark, "hour", T(2018, 1, 1), T(2018, 1, 1, 5))
    assert hours.count() == 5


def test_generate_series_and_star(spark):
    assert [r[0] for r in R.generate_series(spark, 5).collect()] == [1, 2, 3, 4, 5]
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert R.star(df, ["B"], prefix="p_").columns == ["p_a", "p_c"]
    with pytest.raises(ValueError):
        R.star(df, ["a", "b", "c"])


def test_single_value_default(spark):
    empty = spark.createDataFrame([], "x int")
    assert R.single_value(empty, default=7).first()[0] == 7


def test_column_values_are_not_capped(spark):
    df = spark.range(1500).select(F.col("id").cast("string").alias("v"))
    assert len(R.column_values_list(df, "v")) == 1500
    assert len(R.column_values_list(df, "v", max_records=3)) == 3
    assert R.column_values(df, "v", max_records=0).count() == 0


def test_except_both_ways_strict(spark):
    a = spark.createDataFrame([(1,), (1,)], "x int")
    b = spark.createDataFrame([(1,)], "x int")
    assert R.except_both_ways(a, b).count() == 0
    assert R.except_both_ways(a, b, strict=True).count() == 1


def test_mutually_exclusive_ranges_gap_modes(spark):
    df = spark.createDataFrame([(0, 1), (1, 3), (4, 5)], "lo int, hi int")
    assert Q.mutually_exclusive_ranges(df, "lo", "hi", gaps="allowed").count() == 0
    assert Q.mutually_exclusive_ranges(df, "lo", "hi", gaps="not_allowed").count() == 1
    assert Q.mutually_exclusive_ranges(df, "lo", "hi", gaps="required").count() == 1
    zero = spark.createDataFrame([(0, 0)], "lo int, hi int")
    assert Q.mutually_exclusive_ranges(zero, "lo", "hi").count() == 1
    assert Q.mutually_exclusive_ranges(zero, "lo", "hi", zero_length_range_allowed=True).count() == 0
    with pytest.raises(ValueError):
        Q.mutually_exclusive_ranges(df, "lo", "hi", gaps="sometimes")


def test_rowcount_comparisons(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "g string")
    b = spark.createDataFrame([("x",), ("z",)], "g string")
    eq = {(r.g_a, r.g_b): r.diff_count for r in Q.equal_rowcount(a, b, ["g"]).collect()}
    assert eq[("x", "x")] == 1 and eq[("y", None)] is None and eq[(None, "z")] is None
    fewer = Q.fewer_rows_than(b, b)
    assert fewer.first().row_count_delta == 1
    assert Q.fewer_rows_than(b, a).first().row_count_delta == 0


def test_column_assertions(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (2, None, 50.0), (2, "  ", None)], "id int, s string, v double")
    assert Q.not_null(df, "s").count() == 1
    assert Q.unique(df, "id").first().unique_field == 2
    assert Q.accepted_range(df, "v", 0, 10).count() == 1          # NULL passes
    assert Q.accepted_range(df, "v", 0, 50, inclusive=False).count() == 1
    assert Q.not_empty_string(df, "s").count() == 1
    assert Q.not_empty_string(df, "s", trim_whitespace=False).count() == 0
    assert Q.accepted_values(df, "s", ["a"]).count() == 1        # NULL passes, '  ' fails
    assert Q.not_constant(df, F.lit(1)).count() == 1
    assert Q.at_least_one(df, "s", ["id"]).count() == 0
    assert Q.not_null_proportion(df, "v", at_least=0.9).count() == 1


def test_windows_over_a_whole_table(spark):
    """Ungrouped sequences and ranges, cut into value ranges, equal the plain windows; ties, NULLs and hot values included."""
    import random
    rng = random.Random(5)
    vals = [None] * 20 + [7] * 300 + [rng.randrange(-4000, 9000) for _ in range(6000)]
    df = spark.createDataFrame([(v, None if v is None else v + rng.randrange(-1, 4)) for v in vals], "lo int, hi int").repartition(7)
    plain = df.select("lo", F.lag("lo").over(W.ordered([], ["lo"])).alias("previous_lo")).filter("NOT (lo = previous_lo + 1)")
    got = Q.sequential_values(df, "lo")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))
    one = df.withColumn("k", F.lit(1))
    key = str
    assert sorted(map(tuple, Q.ranges_with_next(df, "lo", "hi").collect()), key=key) == \
        sorted(map(tuple, Q.ranges_with_next(one, "lo", "hi", "k").drop("partition_by_col").collect()), key=key)
    for empty in (df.limit(0), df.filter("lo IS NULL")):
        assert Q.sequential_values(empty, "lo").count() == 0
    days = spark.createDataFrame([(D(2024, 1, 1),), (D(2024, 1, 2),), (D(2024, 1, 5),), (None,)], "d date")
    assert [r.d for r in Q.sequential_values(days, "d", 1, "day").collect()] == [D(2024, 1, 5)]
    words = spark.createDataFrame([("a", "b"), ("b", "c")], "lo string, hi string")  # no quantiles: the plain form
    assert Q.ranges_with_next(words, "lo", "hi").count() == 2


def test_sequential_and_recency(spark):
    df = spark.createDataFrame([("u", D(2024, 1, 1)), ("u", D(2024, 1, 2)), ("u", D(2024, 1, 4))], "u string, d date")
    bad = Q.sequential_values(df, "d", 1, "day", ["u"]).collect()
    assert [r.d for r in bad] == [D(2024, 1, 4)]
    nums = spark.createDataFrame([(1,), (2,), (4,)], "n int")
    assert Q.sequential_values(nums, "n").count() == 1
    ev = spark.createDataFrame([("u", T(2024, 1, 1, 1))], "u string, ts timestamp_ntz")
    assert Q.recency(ev, "ts", "hour", 23, "2024-01-02 00:00:00").count() == 0
    assert Q.recency(ev, "ts", "hour", 22, "2024-01-02 00:00:00").count() == 1


def test_equality_precision(spark):
    a = spark.createDataFrame([(1, 1.04)], "k int, x double")
    b = spark.createDataFrame([(1, 1.0)], "k int, x double")
    assert Q.equality(a, b).count() == 2
    assert Q.equality(a, b, precision=1).count() == 0
    with pytest.raises(ValueError):
        Q.equality(a, spark.createDataFrame([(1,)], "k int"))


def test_order_and_lifecycle(spark):
    df = spark.createDataFrame([
        ("ok", T(2024, 1, 1), T(2024, 1, 2), None, None),
        ("gap", T(2024, 1, 1), None, T(2024, 1, 3), None),
        ("order", T(2024, 1, 3), T(2024, 1, 2), None, None)],
        "id string, a timestamp_ntz, b timestamp_ntz, c timestamp_ntz, d timestamp_ntz")
    assert [r.id for r in Q.timestamps_out_of_order(df, ["a", "b", "c", "d"]).collect()] == ["order"]
    assert sorted(r.id for r in Q.lifecycle_violations(df, ["a", "b", "c", "d"]).collect()) == ["gap", "order"]


def test_report_thresholds(spark):
    fail = spark.createDataFrame([(1,), (2,)], "x int")
    ok = spark.createDataFrame([], "x int")
    out = {r.test: (r.failures, r.status) for r in Q.report({"f": (fail, None), "o": (ok, None)}).collect()}
    assert out == {"f": (2, "ERROR"), "o": (0, "PASS")}
    warn = Q.report({"f": (fail, None)}, warn_if="> 1", error_if="> 5").first()
    assert warn.status == "WARN"


def test_scd2_chunked_equals_plain(spark):
    # one hot key with changes over several days, ties, a NULL start and an unknown attribute
    base = spark.createDataFrame([("hot", "z0", "f0", D(2024, 1, 1)), ("cold", "z1", "f1", None)],
                                 "robot_id string, zone_id string, fw string, since date")
    rows = []
    for i in range(200):
        ts = T(2024, 1, 1 + i % 9, (i * 7) % 24, i % 60)
        attr = ["ZONE", "FIRMWARE", "COLOR"][i % 3]
        rows.append((f"c{i:03d}", "hot", ts, attr, f"v{i % 13}"))
    rows.append(("c900", "hot", T(2024, 1, 3, 5, 5), "ZONE", "tie-a"))
    rows.append(("c901", "hot", T(2024, 1, 3, 5, 5), "ZONE", "tie-b"))
    rows.append(("c902", "cold", T(2024, 1, 4), "ZONE", "zc"))
    ch = spark.createDataFrame(rows, "change_id string, robot_id string, changed_at timestamp_ntz, "
                                     "attribute string, new_value string")
    args = dict(key="robot_id", attributes={"ZONE": "zone_id", "FIRMWARE": "fw"}, base_valid_from="since")
    for mode in ("latest", "running_max"):
        plain = scd.build_scd2(base, ch, mode=mode, **args)
        for chunk in ("day", "hour", "month"):
            chunked = scd.build_scd2(base, ch, chunk=chunk, mode=mode, **args)
            assert plain.exceptAll(chunked).count() == 0 and chunked.exceptAll(plain).count() == 0


def test_overlap_pairs_equal_selfjoin(spark):
    rows = [("h", T(2024, 1, 1 + i % 5, i % 24), T(2024, 1, 1 + (i * 3) % 7, (i * 5) % 24)) for i in range(120)]
    rows += [("h", T(2024, 1, 2), None), ("h", T(2024, 1, 2), T(2024, 1, 2)), ("c", T(2024, 1, 1), T(9999, 12, 31)),
             ("c", T(2024, 1, 3), T(2024, 1, 3, 0, 0, 0, 1)), ("c", T(2024, 1, 3), T(2024, 1, 4)),
             ("c", T(2024, 1, 3, 12), T(2024, 1, 5)), ("c", T(2024, 1, 3, 12), T(2024, 1, 5)),
             ("c", T(2024, 1, 3, 12), T(2024, 1, 5))]
    v = spark.createDataFrame(rows, "robot_id string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    fast = scd.overlapping_versions(v, "robot_id")
    slow = scd.overlapping_versions_selfjoin(v, "robot_id")
    assert slow.count() > 100
    assert fast.exceptAll(slow).count() == 0 and slow.exceptAll(fast).count() == 0


def test_scd2_chunks_equal_plain_windows_on_a_hot_key(spark):
    base = spark.createDataFrame([("hot", "z0", D(2024, 1, 1))], "robot_id string, zone_id string, since date")
    ch = spark.createDataFrame([(f"c{i:03d}", "hot", T(2024, 1, 1 + i % 5, i % 24), "ZONE", f"z{i}") for i in range(50)],
                               "change_id string, robot_id string, changed_at timestamp_ntz, attribute string, "
                               "new_value string")
    args = dict(key="robot_id", attributes={"ZONE": "zone_id"}, base_valid_from="since")
    plain = scd.build_scd2(base, ch, chunk=None, **args)
    auto = scd.build_scd2(base, ch, **args)
    assert "_chunk" in auto._jdf.queryExecution().analyzed().toString()
    assert plain.exceptAll(auto).count() == 0 and auto.exceptAll(plain).count() == 0


def test_mutually_exclusive_ranges_chunked_equals_plain(spark):
    rows = [("k", T(2024, 1, 1 + i % 6, i % 24), T(2024, 1, 1 + (i * 5) % 8, (i * 7) % 24)) for i in range(80)]
    rows += [("k", None, T(2024, 1, 3)), ("k", T(2024, 1, 9), None), ("j", T(2024, 1, 1), T(2024, 1, 2))]
    df = spark.createDataFrame(rows, "p string, lo timestamp_ntz, hi timestamp_ntz")
    for gaps in ("allowed", "not_allowed", "required"):
        plain = Q.mutually_exclusive_ranges(df, "lo", "hi", "p", gaps=gaps)
        ch = Q.mutually_exclusive_ranges(df, "lo", "hi", "p", gaps=gaps, chunk=F.date_trunc("day", "lo"))
        assert plain.count() > 0
        assert plain.exceptAll(ch).count() == 0 and ch.exceptAll(plain).count() == 0


def test_pit_merge_equals_join(spark):
    base = spark.createDataFrame([(f"r{i}", f"z{i}", D(2024, 1, 1 + i)) for i in range(3)],
                                 "robot_id string, zone_id string, since date")
    ch = spark.createDataFrame(
        [(f"c{i:03d}", f"r{i % 3}", T(2024, 1, 1 + i % 9, (i * 5) % 24), "ZONE", f"z{i}") for i in range(90)]
        + [("c900", "r0", T(2024, 1, 4, 6), "ZONE", "tie-a"), ("c901", "r0", T(2024, 1, 4, 6), "ZONE", "tie-b")],
        "change_id string, robot_id string, changed_at timestamp_ntz, attribute string, new_value string")
    dim = scd.build_scd2(base, ch, "robot_id", {"ZONE": "zone_id"}, "since", sk_name="robot_sk") \
        .select(F.col("robot_id").alias("_rid"), "robot_sk", "zone_id", "valid_from", "valid_to")
    facts = [(f"f{i}", f"r{i % 4}", T(2023, 12, 31) + dt.timedelta(hours=7 * i)) for i in range(80)]
    facts += [("fb", "r0", T(2024, 1, 4, 6)), ("fn", "r1", None), ("fk", None, T(2024, 1, 5))]
    fact = spark.createDataFrame(facts, "reading_id string, robot_id string, reading_ts timestamp_ntz")
    joined = pit_join(fact, dim, "robot_id", "reading_ts", dim_key="_rid")
    merged = pit_merge(fact, dim, "robot_id", "reading_ts", "valid_from", "valid_to", "_rid")
    assert joined.columns == merged.columns
    assert joined.count() == len(facts)
    assert joined.exceptAll(merged).count() == 0 and merged.exceptAll(joined).count() == 0


def test_date_spine_other_parts(spark):
    weeks = [r[0] for r in R.date_spine(spark, "week", D(2018, 1, 1), D(2018, 1, 29)).collect()]
    assert weeks == [D(2018, 1, 1), D(2018, 1, 8), D(2018, 1, 15), D(2018, 1, 22)]
    assert R.date_spine(spark, "week", D(2018, 1, 1), D(2018, 1, 30)).count() == 4
    assert R.date_spine(spark, "month", D(2024, 1, 1), D(2024, 4, 15)).count() == 3
    assert R.date_spine(spark, "hour", T(2024, 1, 1, 10, 15), T(2024, 1, 1, 12, 45)).count() == 2
    quarters = [r[0] for r in R.date_spine(spark, "quarter", D(2018, 1, 1), D(2019, 1, 1)).collect()]
    assert quarters == [D(2018, 1, 1), D(2018, 4, 1), D(2018, 7, 1), D(2018, 10, 1)]
    assert R.date_spine(spark, "year", D(2018, 1, 1), D(2021, 1, 1)).count() == 3
    assert R.date_spine(spark, "minute", T(2018, 1, 1), T(2018, 1, 1, 1)).count() == 60
    assert R.date_spine(spark, "day", D(2018, 1, 5), D(2018, 1, 1)).count() == 0
    with pytest.raises(ValueError):
        R.date_spine(spark, "fortnight", D(2018, 1, 1), D(2018, 2, 1))


def test_union_relations_override_and_where(spark):
    a = spark.createDataFrame([(1, "x")], "id int, name string")
    b = spark.createDataFrame([(2, "y")], "id bigint, name string")
    u = R.union_relations({"a": a, "b": b}, column_override={"ID": "string"}, exclude=["name"], where="id != '2'")
    assert dict(u.dtypes)["id"] == "string" and [r.id for r in u.collect()] == ["1"]


def test_option_branches(spark):
    ev = spark.createDataFrame([("u", T(2024, 1, 1, 23)), ("v", T(2024, 1, 2, 1))], "u string, ts timestamp_ntz")
    # date-only: latest day 2024-01-02 vs threshold date(2024-01-02 12:00 - 12 h) = 2024-01-02 -> passes
    assert Q.recency(ev, "ts", "hour", 12, "2024-01-02 12:00:00", ignore_time_component=True).count() == 0
    assert [r.most_recent for r in Q.recency(ev, "ts", "day", 1, "2024-01-03 00:00:00",
                                             group_by=["u"], ignore_time_component=True).collect()] == [D(2024, 1, 1)]
    df = spark.createDataFrame([("S", "red", 1), ("S", "red", 1), ("S", "blue", 2)], "size string, color string, n int")
    distinct = R.pivot(df, ["size"], "color", ["red"], agg="count", then_value=F.col("n"), else_value=None,
                       distinct=True).first()
    assert distinct["red"] == 1
    vals = R.column_values(df, "color", order_by="value").collect()
    assert [r.value for r in vals] == ["blue", "red"] and [r.n for r in vals] == [1, 2]


def test_pit_join_meets_versions_by_day(spark):
    dim = spark.createDataFrame([("a", T(2024, 1, 1), T(9999, 12, 31), 1), ("a", T(2024, 1, 3), T(2024, 1, 2), 2), ("a", None, T(2024, 2, 1), 3),
                                 ("a", T(2024, 1, 1), None, 4), ("a", T(2023, 1, 1), T(2024, 1, 2, 12), 5), (None, T(2024, 1, 1), T(2024, 3, 1), 6)],
                                "k string, valid_from timestamp_ntz, valid_to timestamp_ntz, v int")
    fact = spark.createDataFrame([("a", T(2024, 1, 2, 11)), ("a", T(2024, 1, 2, 12)), ("a", T(2022, 1, 1)), ("a", None), (None, T(2024, 1, 5))],
                                 "key string, ts timestamp_ntz")
    plain = (fact.key == dim.k) & (fact.ts >= dim.valid_from) & (fact.ts < dim.valid_to)
    for how in ("inner", "left", "left_semi", "left_anti"):
        got, want = pit_join(fact, dim, "key", "ts", dim_key="k", how=how), fact.join(dim, plain, how)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    with pytest.raises(ValueError):
        pit_join(fact, dim, "key", "ts", dim_key="k", how="full")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = pit_join(fact, dim, "key", "ts", dim_key="k")._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = next(line for line in plan.splitlines() if "SortMergeJoin" in line)
    assert "_cell" in join and "cast(ts" in join  # the day is one of the join's keys


def test_medians_of_a_hot_key_and_odd_values(spark):
    from telemetra.operators import faults as X
    hot = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"),
                                     (F.rand(9) * 40 - F.when(F.col("id") % 2 == 0, 45).otherwise(0)).alias("x"))
    odd = spark.createDataFrame([("z", 0.0), ("z", -0.0), ("z", 0.0), ("s", 1e-320), ("s", -1e-320), ("s", 5e-324), ("n", float("nan")), ("n", 1.0),
                                 ("n", float("inf")), ("i", float("-inf")), ("i", float("-inf")), ("i", 2.0), ("e", None), ("e", 7.0), ("o", None)],
                                "k string, x double")
    rows = hot.unionByName(odd)
    by = {}
    for r in rows.filter("x is not null").collect():
        by.setdefault(r.k, []).append(r.x)
    order = lambda v: (1, 0.0) if v != v else (0, v)
    want = {k: sorted(v, key=order)[(len(v) + 1) // 2 - 1] for k, v in by.items()}
    med = X.exact_median(rows, "k", "x", "m")
    assert {r.k: str(r.m + 0.0) for r in med.collect()} == {k: str(v + 0.0) for k, v in want.items()}
    # windows order cells, or the distinct values of the one cell that is joined in; never a key's rows
    plan = med._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 3 and "Join" in plan.split("Window [")[1]


def test_report_counts_rows_and_groups_in_shared_passes(spark):
    t = spark.createDataFrame([(1, "a", 5), (2, "a", None), (3, "b", 7), (4, None, 9)], "id int, g string, v int")
    tests = {"null v": Q.Rows(t, F.col("v").isNull()), "big": Q.Rows(t, F.col("v") > 6),
             "alone": Q.Groups(t, ("g",), {"n": F.count(F.lit(1))}, lambda c: c["n"] == 1),
             "spread": Q.Groups(t, ("g",), {"lo": F.min("v"), "hi": F.max("v")}, lambda c: c["g"].isNotNull(), lambda c: c["hi"] - c["lo"] + 1),
             "kinds": Q.Groups(t, ("g",), {}, lambda c: c["g"] == "a"), "plain": (t.filter("id > 2"), None)}
    got = {r.test: (r.failures, r.status) for r in Q.report(tests).collect()}
    assert got == {"null v": (1, "ERROR"), "big": (2, "ERROR"), "alone": (2, "ERROR"), "spread": (2, "ERROR"), "kinds": (1, "ERROR"), "plain": (2, "ERROR")}
    assert len(Q.counted({k: v for k, v in tests.items() if k != "plain"})) == 2  # one pass of rows, one grouping


def test_equality_measure_counts_rows_and_the_excess(spark):
    a, b = spark.range(10).toDF("x"), spark.range(4, 11).toDF("x")
    assert Q.failure_count(Q.equality(a, b), Q.EQUALITY_MEASURE).first()[0] == 5 + 3
    assert Q.failure_count(Q.equality(a, a), Q.EQUALITY_MEASURE).first()[0] == 0


def test_cardinality_equality_groups_both_tables_once(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,), (5,), (5,)], "x int")
    b = spark.createDataFrame([(1,), (2,), (2,), (3,), (None,), (None,), (7,)], "y int")
    out = Q.cardinality_equality(a, "x", b, "y")
    assert sorted(out.collect(), key=str) == sorted([(1, 2), (1, 1), (2, 1), (2, 2), (None, 1), (None, 2), (5, 2), (7, 1)], key=str)
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
