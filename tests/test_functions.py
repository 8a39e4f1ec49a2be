"""Column helpers on literal rows (edge cases of the cleaning, key, web and math helpers)."""

from __future__ import annotations

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from telemetra.functions import columns as C
from telemetra.operators.relational import slugify
from telemetra.sources.ingest import clean_header


def one(spark, expr, rows, schema="x string"):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr.alias("y")).collect()]


def test_trim_nullif_and_upper(spark):
    assert one(spark, C.trim_nullif("x"), [("  a ",), ("",), ("   ",), (None,)]) == ["a", None, None, None]
    assert one(spark, C.upper_trim("x"), [(" active ",)]) == ["ACTIVE"]


def test_null_tokens(spark):
    exact = [("N/A",), ("n/a",), ("none",), ("None",), (" NA ",), ("NA",), ("Na",), ("",)]
    assert one(spark, C.null_token("x"), exact) == [None, "n/a", "none", None, " NA ", None, "Na", None]
    toks = [("N/A",), ("n/a",), ("NaN",), ("#N/A",), (" null ",), ("-",), ("",), ("ok",), ("None",)]
    assert one(spark, C.null_token("x", C.WIDE_NULL_TOKENS, exact=False), toks) == [None] * 7 + ["ok", None]


def test_safe_casts(spark):
    assert one(spark, C.safe_double("x"), [("1.5",), ("abc",), ("",)]) == [1.5, None, None]
    assert one(spark, C.safe_number("x"), [("1.7",), ("2",), ("x",), ("-1.5",)]) == [2, 2, None, -2]
    assert one(spark, C.safe_date("x"), [("2024-01-05",), ("2024-02-30",), ("nope",)]) == [dt.date(2024, 1, 5), None, None]


def test_parse_ts_layouts_and_flag(spark):
    rows = [("2024-01-15 08:30:00",), ("01/15/2024 08:30:00",), ("01/15/2024 08:30:00 PM",),
            ("2024-01-15T08:30:00",), ("garbage",), (None,)]
    ts = C.parse_ts("x", C.TS_FORMATS_WITH_T)
    got = one(spark, ts, rows)
    assert got[:2] == [dt.datetime(2024, 1, 15, 8, 30)] * 2
    assert got[2] == dt.datetime(2024, 1, 15, 20, 30)
    assert got[3] == dt.datetime(2024, 1, 15, 8, 30)
    assert got[4] is None and got[5] is None
    assert one(spark, C.parse_failed("x", ts), rows) == [False, False, False, False, True, False]


def test_parse_ts_extended_and_epoch(spark):
    rows = [("15-01-2024 08:30",), ("2024/01/15 08:30:00 PM",), ("1705307400",)]
    got = one(spark, C.parse_ts("x", C.TS_FORMATS_EXTENDED, epoch_digits=True), rows)
    assert got == [dt.datetime(2024, 1, 15, 8, 30), dt.datetime(2024, 1, 15, 20, 30), dt.datetime(2024, 1, 15, 8, 30)]
    # the warehouse's own list does not read epoch digits
    assert one(spark, C.parse_ts("x", C.TS_FORMATS), [("1705307400",), ("12",)]) == [dt.datetime(2024, 1, 15, 8, 30), None]
    assert one(spark, C.parse_ts("x", C.TS_FORMATS, epoch_digits=False), [("1705307400",)]) == [None]


def test_epoch_to_ts(spark):
    assert one(spark, C.epoch_to_ts("x"), [(0,)], "x long") == [dt.datetime(1970, 1, 1)]


def test_bool_words(spark):
    rows = [("true",), (" YES ",), ("y",), ("1",), ("false",), ("No",), ("n",), ("0",), ("maybe",), (None,)]
    assert one(spark, C.bool_words("x"), rows) == [True] * 4 + [False] * 4 + [None, None]


def test_canonical_attribute(spark):
    rows = [("firmware_version",), (" home_zone ",), ("Owner_Team",), ("colour",)]
    assert one(spark, C.canonical_attribute("x"), rows) == ["FIRMWARE", "ZONE", "TEAM", "COLOUR"]


def test_range_helpers(spark):
    rows = [(-1.0,), (0.0,), (100.0,), (101.0,), (None,)]
    assert one(spark, C.keep_between("x", 0.0, 100.0), rows, "x double") == [None, 0.0, 100.0, None, None]
    assert one(spark, C.outside_flag("x", 0.0, 100.0), rows, "x double") == [True, False, False, True, False]
    assert one(spark, C.above_flag("x", 60.0), [(61.0,), (60.0,), (None,)], "x double") == [True, False, False]


def test_surrogate_key_matches_md5(spark):
    got = one(spark, C.surrogate_key("a", "b"), [("x", None)], "a string, b string")[0]
    assert got == hashlib.md5(b"x-_dbt_utils_surrogate_key_null_").hexdigest()
    got2 = one(spark, C.surrogate_key("a", "b", nulls_as_empty=True), [("x", None)], "a string, b string")[0]
    assert got2 == hashlib.md5(b"x-").hexdigest()


def test_date_key(spark):
    assert one(spark, C.date_key("x"), [(dt.date(2024, 3, 9),)], "x date") == [20240309]


URLS = [
    ("https://www.example.com/path/to/page?utm_source=google&page=2", "www.example.com", "path/to/page", "google"),
    ("http://example.com", "example.com", "example.com", None),
    ("android-app://com.example.app/path", "com.example.app", "/com.example.app/path", None),
    ("https://example.com?utm_source=&x=1", "example.com", "", None),
    ("https://example.com/a/b#frag?utm_source=x", "example.com", "a/b#frag", "x"),
]


@pytest.mark.parametrize("url,host,path,src", URLS)
def test_url_parts(spark, url, host, path, src):
    df = spark.createDataFrame([(url,)], "u string")
    r = df.select(C.url_host("u"), C.url_path("u"), C.url_parameter("u", "utm_source")).first()
    assert (r[0], r[1], r[2]) == (host, path, src)


def test_haversine(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 1.0)], "a double, b double, c double, d double")
    mi = df.select(C.haversine("a", "b", "c", "d")).first()[0]
    km = df.select(C.haversine("a", "b", "c", "d", unit="km")).first()[0]
    assert abs(mi - 69.13) < 0.05 and abs(km / mi - 1.60934) < 1e-9
    with pytest.raises(ValueError):
        C.haversine("a", "b", "c", "d", unit="nm")


def test_width_bucket(spark):
    rows = [(10.0,), (-1.0,), (0.0,), (9.99,), (5.0,)]
    assert one(spark, C.width_bucket("x", 0.0, 10.0, 5), rows, "x double") == [6, 0, 1, 5, 3]


def test_safe_math(spark):
    df = spark.createDataFrame([(1, None, 0), (4, 2, 2)], "a int, b int, c int")
    r = df.select(C.safe_add("a", "b").alias("s"), C.safe_subtract("a", "b").alias("d"),
                  C.safe_divide(F.col("a"), F.col("c")).alias("q")).collect()
    assert [(x.s, x.d, x.q) for x in r] == [(1, 1, None), (6, 2, 2.0)]


def test_clean_header():
    got = clean_header([" reading id", "soc-%", "", "1st", "Reading_ID", "a__b_", "Unnamed: 47"])
    assert got == ["READING_ID", "SOC", "COL_2", "COL_1ST", "READING_ID_2", "A_B", "UNNAMED_47"]


def test_slugify():
    assert slugify("Red Color") == "red_color"
    assert slugify("3-in-1!") == "_3_in_1"
    assert slugify("") == ""


def test_offset_text_keeps_wall_clock(spark):
    # zone-less target: the offset is dropped and the local wall-clock time kept (by decision)
    got = one(spark, C.parse_ts("x"), [("2024-01-15T08:30:00+05:00",), ("2024-01-15 08:30:00",)])
    assert got == [dt.datetime(2024, 1, 15, 8, 30)] * 2
