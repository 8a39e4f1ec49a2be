"""DuckDB SQL of the queries that SQL can express, written from their contracts."""

from __future__ import annotations

from telemetra.llm.url_filters import RULES, TWO_LABEL_SUFFIXES

_LOWER = "translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _rule_case(value) -> str:
    by_length = sorted(RULES, key=lambda r: (len(r[1]), r[1].index("/")), reverse=True)
    whens = "".join(f" WHEN (host = '{r.split('/')[0]}' OR ends_with(host, '.{r.split('/')[0]}')) AND starts_with(path, '{r[r.index('/'):]}') "
                    f"THEN '{value(what, r)}'" for what, r in by_length)
    return f"CASE{whens} END"


def _weight(level: str) -> str:
    """Moment estimate of the prior weight of a level's groups."""
    return f"""
SELECT CASE WHEN n IS NULL OR n = 0 OR m < 2 THEN 1.0::DOUBLE WHEN p <= 0 OR p >= 1 THEN 10000.0::DOUBLE
  WHEN room <= 0 THEN 1.0::DOUBLE WHEN (k2 - n * p * p - within * (m - 1)) / room <= 1.0::DOUBLE / 10001 THEN 10000.0::DOUBLE
  ELSE greatest(1.0::DOUBLE, (1 - (k2 - n * p * p - within * (m - 1)) / room) / ((k2 - n * p * p - within * (m - 1)) / room)) END
FROM (SELECT *, p * (1 - p) AS within, p * (1 - p) * (n - n2 / n - (m - 1)) AS room FROM (
  SELECT CAST(count(*) AS DOUBLE) AS m, CAST(sum(n) AS DOUBLE) AS n, CAST(sum(k) AS DOUBLE) / sum(n) AS p,
    CAST(sum(n * n) AS DOUBLE) AS n2, sum(CAST(k * k AS DOUBLE) / n) AS k2
  FROM (SELECT {level}, CAST(sum(n) AS BIGINT) AS n, CAST(sum(k) AS BIGINT) AS k FROM hosts WHERE n > 0 GROUP BY 1)))"""


_TWO = "array_to_string(string_split(host, '.')[-2:], '.')"
_IS_TWO = f"{_TWO} IN ({', '.join(repr(s) for s in TWO_LABEL_SUFFIXES)})"

URL_FILTERS = f"""
WITH rests AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM rests),
cut AS (SELECT page_id, {_LOWER.format(x='raw')} AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM parts),
judged AS (SELECT *, {_rule_case(lambda what, r: r)} AS rule, {_rule_case(lambda what, r: what)} AS told FROM cut),
hosts AS (SELECT host, CASE WHEN {_IS_TWO} THEN {_TWO} ELSE string_split(host, '.')[-1] END AS suffix,
  CASE WHEN {_IS_TWO} THEN array_to_string(string_split(host, '.')[-3:], '.') ELSE {_TWO} END AS domain,
  count(told) AS n, count_if(told = 'block') AS k FROM judged GROUP BY host),
w AS (SELECT ({_weight('suffix')}) AS ms, ({_weight('domain')}) AS md, ({_weight('host')}) AS mh,
  (SELECT CASE WHEN sum(n) > 0 THEN (sum(k) + 1.0::DOUBLE) / (sum(n) + 2) ELSE 0.5::DOUBLE END FROM hosts) AS base),
shrunk AS (SELECT host, n, k, mh, (k_d + md * ((k_s + ms * base) / (n_s + ms))) / (n_d + md) AS p FROM (
  SELECT *, sum(n) OVER (PARTITION BY suffix) AS n_s, sum(k) OVER (PARTITION BY suffix) AS k_s,
    sum(n) OVER (PARTITION BY suffix, domain) AS n_d, sum(k) OVER (PARTITION BY suffix, domain) AS k_d FROM hosts), w),
post AS (SELECT host, k + mh * p AS a, (n - k) + mh * (1 - p) AS b FROM shrunk)
SELECT page_id, host, path, rule, coalesce(told, CASE WHEN a / (a + b) - 1.28::DOUBLE * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > 0.5
  THEN 'block' ELSE 'allow' END) AS verdict
FROM judged JOIN post USING (host)"""

SUBSTRINGS = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n FROM documents),
w AS (SELECT doc_id, s, substr(x, 2 * s + 1, 100) AS v FROM d, unnest(range(0, n - 49)) AS t(s) WHERE n >= 50),
f AS (SELECT v, min(doc_id) AS lo FROM w GROUP BY v),
hit AS (SELECT w.doc_id, s FROM w JOIN f USING (v) WHERE lo < w.doc_id),
marks AS (SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 50 THEN 0 ELSE 1 END AS new FROM hit),
numbered AS (SELECT doc_id, s, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM marks),
runs AS (SELECT doc_id, min(s) AS a, max(s) + 50 AS b FROM numbered GROUP BY doc_id, run),
pieces AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM runs),
cuts AS (SELECT p.doc_id, count(*) AS n_spans, sum(b - a) AS n_removed,
  string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(x), 2 * max(b) + 1) AS kept
  FROM pieces p JOIN d USING (doc_id) GROUP BY p.doc_id)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM d LEFT JOIN cuts USING (doc_id)"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER.format(x="coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[s:s + 3], ' ') AS run FROM d, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS t(s) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.run = b.run AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
sym AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS r FROM d UNION SELECT reach.doc_id, sym.b FROM reach JOIN sym ON sym.a = reach.r)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)"""

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format(x="coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER.format(x="coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(w), 10) AS size, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS run
  FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(s) WHERE len(w) > 0),
dw AS (SELECT doc_id, s, size, array_to_string(w[s:s + size - 1], ' ') AS run
  FROM d, (SELECT DISTINCT size FROM bw), unnest(range(1, len(w) - size + 2)) AS t(s) WHERE len(w) >= size),
h AS (SELECT doc_id, s, size, item FROM dw JOIN bw USING (size, run)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, s, size FROM h), unnest(range(s, s + size)) AS t(p) GROUP BY 1),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN named USING (doc_id)"""


#: One row: the table of the crc32 polynomial, from its rule.
_CRC_TABLE = """SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t"""


def _crc(text: str) -> str:
    """Unsigned crc32 of a text's UTF-8 bytes; ``t`` is the table."""
    code = f"list_transform(range(octet_length(encode({text}))), lambda i: CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {code}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


PERIODIC_RUNS = f"""
WITH crc AS ({_CRC_TABLE}),
d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {_crc('CAST(doc_id AS VARCHAR)')} AS h FROM documents, crc),
p AS (SELECT doc_id, w, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a, h // 10 AS g FROM d),
e AS (SELECT doc_id, i, CASE WHEN a IS NULL OR i < a THEN w[i + 1] ELSE w[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1] END AS x
  FROM p, unnest(range(n)) AS u(i)),
pairs AS (SELECT l.doc_id, r.i - l.i AS q, l.i AS i FROM e l JOIN e r ON l.doc_id = r.doc_id AND l.x = r.x AND l.i < r.i),
isles AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS isle FROM pairs),
cand AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS size FROM isles GROUP BY doc_id, q, isle HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT * FROM cand c WHERE NOT EXISTS (SELECT 1 FROM cand b WHERE b.doc_id = c.doc_id AND b.q < c.q AND b.s <= c.s AND b.s + b.size >= c.s + c.size)),
told AS (SELECT doc_id, count(*) AS n_runs, arg_min(struct_pack(s, size, q), (-size, s, q)) AS best,
  string_agg(s || ',' || size || ',' || q || chr(10), '' ORDER BY s, q) AS list FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, i FROM runs, unnest(range(s + q, s + size)) AS u(i)),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS text FROM e ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, best.s AS start, CAST(best.size AS BIGINT) AS length, best.q AS period,
  CAST(1000 * best.size // best.q AS BIGINT) AS exponent_milli, sha256(coalesce(list, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM d LEFT JOIN told USING (doc_id) LEFT JOIN kept USING (doc_id)"""

SPELLING = f"""
WITH RECURSIVE crc AS ({_CRC_TABLE}),
r AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER.format(x="coalesce(text, '')")}, '[a-zÀ-ÿ]+')) AS run FROM documents),
own AS (SELECT doc_id, run, count(*) AS k FROM r WHERE length(run) >= 6 GROUP BY ALL),
coded AS (SELECT run, k, {_crc("doc_id || ':' || run")} AS h FROM own, crc),
made AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM coded),
words AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM made WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
cuts AS (SELECT word, n, length(word) AS len, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM words, unnest(range(1, length(word) + 1)) AS u(i)),
near AS (SELECT a.word, b.word AS other, b.n AS n_other FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.len = b.len AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cuts c JOIN words w ON c.rest = w.word UNION SELECT w.word, c.word, c.n FROM cuts c JOIN words w ON c.rest = w.word),
best AS (SELECT word, count(*) AS n_near, arg_min(struct_pack(other, n_other), (-n_other, other)) AS o FROM near GROUP BY word),
formed AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN o.n_other >= 5 * n THEN o.other END AS form, CASE WHEN o.n_other >= 5 * n THEN o.n_other END AS form_n
  FROM words LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS here, 0 AS step FROM formed UNION ALL SELECT walk.word, f.form, step + 1 FROM walk JOIN formed f ON f.word = walk.here WHERE f.form IS NOT NULL)
SELECT f.word, form, root, n, n_near, form_n FROM formed f JOIN (SELECT word, arg_max(here, step) AS root FROM walk GROUP BY word) USING (word)"""

BLOCKS = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS v FROM d, unnest(range(1, len(w) - 18)) AS u(s)),
hit AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY v ORDER BY doc_id, s) AS k FROM win) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, i FROM hit, unnest(range(s, s + 20)) AS u(i)),
word AS (SELECT doc_id, i, w[i] AS x FROM d, unnest(range(1, len(w) + 1)) AS u(i)),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY i) AS text FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""
