"""Column -> Column helpers. All built-in expressions: they stay inside whole-stage codegen.

Under ANSI mode (Spark 4 default) plain casts and ``/ 0`` raise, so every cleaning helper uses
the ``try_*`` family and yields NULL on bad input, as the warehouse's ``try_to_*`` functions do.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# Texts that the loader reads as NULL, exactly as written:
NULL_TOKENS = ("", "NULL", "null", "N/A", "NA", "nan", "None", "-", "#N/A")
# Null words of dirty landings, trimmed and in any case (opt-in):
WIDE_NULL_TOKENS = ("", "null", "n/a", "na", "nan", "none", "-", "#n/a")
# Surrogate-key placeholder for a NULL field, and the field separator:
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEP = "-"
# Words read as booleans:
TRUE_WORDS = ("true", "1", "yes", "y")
FALSE_WORDS = ("false", "0", "no", "n")
# Timestamp layouts tried after the automatic ISO parse, in order (Java pattern syntax):
#   MM/DD/YYYY HH24:MI:SS, MM/DD/YYYY HH12:MI:SS AM, YYYY-MM-DD HH24:MI:SS, YYYY-MM-DD"T"HH24:MI:SS
TS_FORMATS = ("MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy hh:mm:ss a", "yyyy-MM-dd HH:mm:ss")
TS_FORMATS_WITH_T = TS_FORMATS + ("yyyy-MM-dd'T'HH:mm:ss",)
# Extra layouts the dirt generator writes but the warehouse does not parse (opt-in):
TS_FORMATS_EXTENDED = TS_FORMATS_WITH_T + ("dd-MM-yyyy HH:mm", "yyyy/MM/dd hh:mm:ss a")
# Attribute synonyms of the change log -> canonical attribute:
ATTRIBUTE_SYNONYMS = {
    "FIRMWARE": ("FIRMWARE", "INITIAL_FIRMWARE", "FIRMWARE_VERSION"),
    "ZONE": ("ZONE", "HOME_ZONE_ID", "HOME_ZONE", "ZONE_ID"),
    "TEAM": ("TEAM", "OWNER_TEAM"),
}
# Earth radius in miles and the km conversion of the distance helper:
EARTH_RADIUS_MI = 3961.0
KM_PER_MI = 1.60934
# Open end of a validity range:
OPEN_END = "9999-12-31 00:00:00"
# ---------------------------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_nullif(c) -> Column:
    """nullif(trim(c), '')"""
    return F.nullif(F.trim(_c(c)), F.lit(""))


def upper_trim(c) -> Column:
    return F.upper(F.trim(_c(c)))


def null_token(c, tokens: Sequence[str] = NULL_TOKENS, exact: bool = True) -> Column:
    """NULL when the text is one of the null tokens, else the text. ``exact=False`` compares the trimmed,
    lower-cased text with lower-case tokens."""
    c = _c(c)
    seen = c if exact else F.lower(F.trim(c))
    return F.when(seen.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def safe_double(c) -> Column:
    return _c(c).try_cast("double")


def safe_number(c) -> Column:
    """Text -> integer, rounding like a NUMBER(38,0) parse ('1.7' -> 2); bad text -> NULL."""
    return F.round(_c(c).try_cast("decimal(38,9)"), 0).try_cast("bigint")


def safe_date(c) -> Column:
    return _c(c).try_cast("date")


def parse_ts(c, formats: Sequence[str] = TS_FORMATS, epoch_digits: bool = True) -> Column:
    """First successful parse over: ISO auto-detect, each explicit layout in order, then 9 to 11 digits as Unix
    seconds (unless ``epoch_digits`` is off)."""
    c = _c(c)
    tries = [c.try_cast("timestamp_ntz")]
    tries += [F.try_to_timestamp(c, F.lit(f)).cast("timestamp_ntz") for f in formats]
    if epoch_digits:
        tries.append(F.when(F.trim(c).rlike("^[0-9]{9,11}$"),
                            F.timestamp_seconds(F.trim(c).try_cast("bigint")).cast("timestamp_ntz")))
    return F.coalesce(*tries)


def parse_failed(raw, parsed: Column) -> Column:
    """True when there was text but no layout parsed it."""
    return F.coalesce(_c(raw).isNotNull() & parsed.isNull(), F.lit(False))


def epoch_to_ts(c) -> Column:
    """Unix seconds -> zone-less timestamp (session time zone is UTC)."""
    return F.timestamp_seconds(_c(c)).cast("timestamp_ntz")


def bool_words(c) -> Column:
    w = F.lower(F.trim(_c(c)))
    return (F.when(w.isin(*TRUE_WORDS), F.lit(True))
            .when(w.isin(*FALSE_WORDS), F.lit(False))
            .otherwise(F.lit(None).cast("boolean")))


def canonical_attribute(c, synonyms: dict[str, Iterable[str]] = ATTRIBUTE_SYNONYMS) -> Column:
    u = upper_trim(c)
    out = None
    for canon, words in synonyms.items():
        out = (F.when(u.isin(*words), F.lit(canon)) if out is None
               else out.when(u.isin(*words), F.lit(canon)))
    return out.otherwise(u)


def keep_between(c, lo: float | None, hi: float | None) -> Column:
    """The value when inside [lo, hi] (either bound optional), else NULL."""
    c = _c(c)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (c >= F.lit(lo))
    if hi is not None:
        cond = cond & (c <= F.lit(hi))
    return F.when(cond, c)


def outside_flag(c, lo: float | None, hi: float | None) -> Column:
    """True when a non-null value lies outside [lo, hi]; never NULL."""
    c = _c(c)
    cond = F.lit(False)
    if lo is not None:
        cond = cond | (c < F.lit(lo))
    if hi is not None:
        cond = cond | (c > F.lit(hi))
    return F.coalesce(cond, F.lit(False))


def above_flag(c, threshold: float) -> Column:
    return F.coalesce(_c(c) > F.lit(threshold), F.lit(False))


def surrogate_key(*cols, nulls_as_empty: bool = False) -> Column:
    """md5 over the fields cast to text, NULL -> placeholder, joined with '-'."""
    null_value = "" if nulls_as_empty else SURROGATE_NULL
    parts = [F.coalesce(_c(c).cast("string"), F.lit(null_value)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEP, *parts))


def date_key(c) -> Column:
    """YYYYMMDD integer key of a date / timestamp."""
    d = _c(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def open_end() -> Column:
    return F.lit(OPEN_END).cast("timestamp_ntz")


# ---- web ------------------------------------------------------------------------------------

def url_host(c) -> Column:
    s = F.replace(F.replace(F.replace(_c(c), F.lit("android-app://"), F.lit("")),
                            F.lit("http://"), F.lit("")), F.lit("https://"), F.lit(""))
    return F.split_part(F.split_part(s, F.lit("/"), F.lit(1)), F.lit("?"), F.lit(1))


def url_path(c) -> Column:
    s = F.replace(F.replace(_c(c), F.lit("http://"), F.lit("")), F.lit("https://"), F.lit(""))
    first = F.coalesce(F.nullif(F.instr(s, "/"), F.lit(0)), F.instr(s, "?") - 1)
    return F.split_part(F.right(s, F.length(s) - first), F.lit("?"), F.lit(1))


def url_parameter(c, name: str) -> Column:
    v = F.split_part(F.split_part(_c(c), F.lit(name + "="), F.lit(2)), F.lit("&"), F.lit(1))
    return F.nullif(v, F.lit(""))


# ---- math -----------------------------------------------------------------------------------

def haversine(lat1, lon1, lat2, lon2, unit: str = "mi") -> Column:
    if unit == "mi":
        rate = 1.0
    elif unit == "km":
        rate = KM_PER_MI
    else:
        raise ValueError(f"distance unit {unit!r} is neither miles (mi) nor kilometres (km)")
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    a = (F.pow(F.sin(F.radians((lat2 - lat1) / 2)), 2)
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians((lon2 - lon1) / 2)), 2))
    return F.lit(2 * EARTH_RADIUS_MI) * F.asin(F.sqrt(a)) * F.lit(rate)


def width_bucket(c, lo: float, hi: float, n: int) -> Column:
    """Equi-width bucket: below lo -> 0, at/above hi -> n + 1."""
    return F.width_bucket(_c(c), F.lit(float(lo)), F.lit(float(hi)), F.lit(int(n)))


def safe_add(*cols) -> Column:
    return sum((F.coalesce(_c(c), F.lit(0)) for c in cols[1:]), F.coalesce(_c(cols[0]), F.lit(0)))


def safe_subtract(*cols) -> Column:
    out = F.coalesce(_c(cols[0]), F.lit(0))
    for c in cols[1:]:
        out = out - F.coalesce(_c(c), F.lit(0))
    return out


def safe_divide(num, den) -> Column:
    """x / 0 -> NULL (instead of an error under ANSI)."""
    return F.try_divide(_c(num), _c(den))
