"""URL filter: rules first, then an empirical-Bayes reputation of the host.

Outcomes are 0/1 labels of pages (1: to block). Each level's rate is shrunk toward the level
above through a beta-binomial prior: host -> registered domain -> suffix -> all pages. The prior
weight of a level is the moment estimate of the spread of its groups' rates. A page without a
rule is blocked when the lower posterior bound of its host's block rate is over ``cut``.

Null urls and urls without ``://`` have empty host and path and form one "empty" host. Empty
tables give empty results; repeated rows are judged one by one, each counting as an outcome.
Columns besides the id and the url are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetra.llm.common import ascii_lower, stored

#: (verdict, host and path prefix)
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/"))
#: Public suffixes of two labels that are told apart from registered domains.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "net.au", "co.jp", "co.nz", "com.br", "co.in", "co.za")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/ ? #``, A-Z lower-cased; path: then up to ``? #``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(url, "://", 1))
    after = F.when(rest.isNotNull(), url.substr(F.length(rest) + 4, F.length(url)))
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    path = F.regexp_extract(after.substr(F.length(host) + 1, F.length(after)), r"^[^?#]*", 0)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule (of equally long ones the longer host), or nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, r in sorted(rules, key=lambda x: (len(x[1]), x[1].index("/"))):
        h, p = r[:r.index("/")], r[r.index("/"):]
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(r)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def suffix_and_domain(host: Column) -> tuple[Column, Column]:
    """Public suffix (last label, or two if listed) and the registered domain (one label more)."""
    two = F.substring_index(host, ".", -2)
    long = two.isin(*TWO_LABEL_SUFFIXES)
    return (F.when(long, two).otherwise(F.substring_index(host, ".", -1)),
            F.when(long, F.substring_index(host, ".", -3)).otherwise(two))


def _spread(level: DataFrame, names: tuple[str, ...]) -> list[float]:
    """Prior weight of each level from the groups' counts: one row per level, summed by Spark."""
    out = []
    for name in names:
        g = level.groupBy(name).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
        s = g.agg(F.count("*").alias("m"), F.sum("n").alias("n"), F.sum("k").alias("k"),
                  F.sum(F.col("n") * F.col("n")).alias("n2"),
                  F.sum(F.col("k") * F.col("k") / F.col("n")).alias("k2")).first()
        out.append(prior_weight(s["m"], s["n"], s["k"], s["n2"], s["k2"]))
    return out


def prior_weight(m, n, k, n2, k2, least: float = 1.0, most: float = 10_000.0) -> float:
    """Moment estimate of a beta-binomial's weight a+b from sums over m groups with outcomes."""
    if not n or not m or m < 2:
        return least
    p = k / n
    if p <= 0 or p >= 1:
        return most
    within = p * (1 - p)
    between = k2 - n * p * p          # sum of n_i (p_i - p)^2
    room = within * (n - n2 / n - (m - 1))
    if room <= 0:
        return least
    rho = (between - within * (m - 1)) / room
    return most if rho <= 1 / (most + 1) else max(least, (1 - rho) / rho)


def reputation(hosts: DataFrame, weights: list[float], base: float, z: float) -> DataFrame:
    """Posterior of every host's block rate. ``hosts``: host, domain, suffix, n, k."""
    ms, md, mh = weights
    suffix = hosts.groupBy("suffix").agg(F.sum("n").alias("n_s"), F.sum("k").alias("k_s"))
    domain = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n_d"), F.sum("k").alias("k_d"))
    p_s = (F.col("k_s") + ms * base) / (F.col("n_s") + ms)
    p_d = (F.col("k_d") + md * p_s) / (F.col("n_d") + md)
    a, b = F.col("k") + mh * p_d, (F.col("n") - F.col("k")) + mh * (1 - p_d)
    mean = a / (a + b)
    sd = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return (hosts.join(domain, ["suffix", "domain"]).join(suffix, "suffix")
            .select("host", mean.alias("block_rate"), (mean - z * sd).alias("block_rate_low")))


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES,
          outcome: Column | None = None, z: float = 1.28, cut: float = 0.5) -> DataFrame:
    """``pages`` -> id, host, path, rule, verdict, block_rate, block_rate_low.

    ``outcome``: the 0/1 label of a page (null: none) over columns id, url, host, path, rule and
    rule_verdict; by default a page that a rule judges is labelled by that rule."""
    host, path = host_and_path(F.col("url"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    cut_urls = (pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
                .withColumns({"host": host, "path": path}).withColumns({"rule": rule, "rule_verdict": verdict}))
    if outcome is None:
        outcome = F.when(F.col("rule_verdict").isNotNull(), (F.col("rule_verdict") == "block").cast("int"))
    suffix, domain = suffix_and_domain(F.col("host"))
    hosts = stored(cut_urls.select("host", outcome.alias("y")).groupBy("host")
                   .agg(F.count("y").alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("k"))
                   .withColumns({"suffix": suffix, "domain": domain}), "hosts")
    seen = hosts.filter("n > 0")
    total = seen.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    base = (total["k"] + 1) / (total["n"] + 2) if total["n"] else 0.5
    scored = reputation(hosts, _spread(seen, ("suffix", "domain", "host")), base, z)
    return (cut_urls.join(scored, "host")
            .select(F.col("id").alias(id_col), "host", "path", "rule",
                    F.coalesce("rule_verdict", F.when(F.col("block_rate_low") > cut, "block").otherwise("allow"))
                    .alias("verdict"), "block_rate", "block_rate_low"))
