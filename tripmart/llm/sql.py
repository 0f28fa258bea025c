"""The queries' results in DuckDB SQL, written from the contracts alone (no sketches, bitmaps or suffix arrays)."""

from __future__ import annotations

from tripmart.llm.quality_rules import LEVEL, RISK, RULES

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

MINHASH_DEDUP = f"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORDS}') AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i + 1:i + 3], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(0, greatest(1, len(w) - 2))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
    JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a AS id, a AS r FROM edges UNION SELECT e.b, reach.r FROM reach JOIN edges e ON e.a = reach.id),
component AS (SELECT id, least(id, min(r)) AS c FROM reach GROUP BY id)
SELECT w.doc_id, coalesce(z.n, 0) AS n_shingles, coalesce(c.c, w.doc_id) AS component_id,
    w.doc_id = coalesce(c.c, w.doc_id) AS kept
FROM words w LEFT JOIN sizes z ON z.doc_id = w.doc_id LEFT JOIN component c ON c.id = w.doc_id"""

DECONTAMINATE = f"""
WITH docs AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM benchmark),
item_windows AS (
    SELECT DISTINCT item_id, n, array_to_string(w[i + 1:i + n], ' ') AS g
    FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(0, len(w) - least(10, len(w)) + 1)) AS i
          FROM items WHERE len(w) > 0)),
doc_windows AS (
    SELECT doc_id, n, i, array_to_string(w[i + 1:i + n], ' ') AS g
    FROM (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS i
          FROM docs, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)),
hits AS (SELECT d.doc_id, d.i, d.n, b.item_id FROM doc_windows d JOIN item_windows b ON d.n = b.n AND d.g = b.g),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
              FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
              FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit_words h ON h.doc_id = d.doc_id LEFT JOIN hit_items i ON i.doc_id = d.doc_id"""

_METRICS = " UNION ALL ".join(f"SELECT doc_id, lang, base_failed, '{rule}' AS rule, {num} AS num, {den} AS den FROM stats"
                              for rule, (num, den, _) in RULES.items())
_LADDER = ", ".join(f"('{rule}', {step}, {cut})" for rule, (_, _, ladder) in RULES.items() for step, cut in enumerate(ladder))
_RISK = RISK / len(RULES)

QUALITY_RULES = rf"""
WITH docs AS (SELECT doc_id, lang, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i + 1:i + 5], ' ') AS g
            FROM (SELECT doc_id, w, unnest(range(0, len(w) - 4)) AS i FROM docs WHERE len(w) >= 5)),
repeats AS (
    SELECT doc_id, count(DISTINCT p) AS n FROM (
        SELECT doc_id, unnest(range(i, i + 5)) AS p FROM windows JOIN (
            SELECT doc_id, g FROM windows GROUP BY doc_id, g HAVING count(*) > 1) USING (doc_id, g)) GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT x) AS d
          FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM docs)
          WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY doc_id),
stats AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM (
        SELECT docs.doc_id, lang, CAST(len(w) AS BIGINT) AS n_words, length(array_to_string(w, '')) AS word_chars,
            length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(lines.d, 0) AS n_dup_lines,
            coalesce(repeats.n, 0) AS n_repeat_words, coalesce(lines.n, 0) AS n_lines,
            length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals
        FROM docs LEFT JOIN lines ON lines.doc_id = docs.doc_id LEFT JOIN repeats ON repeats.doc_id = docs.doc_id)),
metrics AS ({_METRICS}),
ladder AS (SELECT * FROM (VALUES {_LADDER}) AS t(rule, step, cut)),
good AS (SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1 AND max(quality) = 1),
holdout AS (
    SELECT coalesce(lang, '') AS stratum, m.rule, step, cut, count(*) AS n, count(*) FILTER (100 * num > cut * den) AS k
    FROM metrics m JOIN good ON good.doc_id = m.doc_id JOIN ladder l ON l.rule = m.rule
    WHERE NOT base_failed GROUP BY ALL),
tested AS (
    SELECT *, (SELECT count(DISTINCT stratum) FROM holdout) AS strata,
        (SELECT sum(exp(lgamma(n + 1) - CASE WHEN i = 0 THEN 0 ELSE lgamma(i + 1) END
            - CASE WHEN i = n THEN 0 ELSE lgamma(n - i + 1) END + i * ln({_RISK}) + (n - i) * ln(1 - {_RISK})))
         FROM (SELECT unnest(range(0, k + 1)) AS i)) AS p
    FROM holdout),
failed AS (SELECT stratum, rule, min(step) AS step FROM tested WHERE p > {LEVEL} / (strata * {len(RULES)}) GROUP BY ALL),
cutoffs AS (
    SELECT t.stratum, t.rule, min(t.cut) AS cut FROM tested t LEFT JOIN failed f ON f.stratum = t.stratum AND f.rule = t.rule
    WHERE f.step IS NULL OR t.step < f.step GROUP BY ALL),
rejected AS (SELECT DISTINCT doc_id FROM metrics m JOIN cutoffs c ON c.rule = m.rule AND c.stratum = coalesce(m.lang, '')
             WHERE 100 * num > cut * den)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM rejected) AS kept FROM stats"""

SUBSTRING_DEDUP = """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
strings AS (SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s
            FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS p FROM docs WHERE length(h) >= 100)),
firsts AS (SELECT s, min(doc_id) AS d FROM strings GROUP BY s HAVING count(*) > 1),
gone AS (SELECT doc_id, p, p - coalesce(lag(p) OVER (PARTITION BY doc_id ORDER BY p), -100) > 50 AS fresh
         FROM strings JOIN firsts USING (s) WHERE d < doc_id),
runs AS (SELECT doc_id, min(p) AS a, max(p) + 50 AS b FROM (
            SELECT doc_id, p, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM gone) GROUP BY doc_id, run),
pieces AS (SELECT r.doc_id, a, b, h, coalesce(lag(b) OVER (PARTITION BY r.doc_id ORDER BY a), 0) AS start
           FROM runs r JOIN docs d ON d.doc_id = r.doc_id),
kept AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans,
            string_agg(substr(h, 2 * start + 1, 2 * (a - start)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS rest
         FROM pieces GROUP BY doc_id)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
    coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(rest, h))) AS kept_sha256
FROM docs d LEFT JOIN kept k ON k.doc_id = d.doc_id"""

# CRC-32 of a list of bytes: its table by the polynomial's rule, then one fold over the bytes.
_CRC_TABLE = """SELECT list_transform(range(256), lambda i: list_reduce(range(8),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS crc_table"""


def _crc(text: str) -> str:
    digits = f"hex(encode({text}))"
    numbers = f"list_transform(range(length({digits}) // 2), lambda k: CAST('0x' || substr({digits}, 2 * k + 1, 2) AS BIGINT))"
    return f"xor(list_reduce({numbers}, lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"


IMPORTANCE_RESAMPLING = f"""
WITH crc AS ({_CRC_TABLE}),
bags AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM documents),
doc_words AS (SELECT doc_id, unnest(w) AS x FROM bags),
item_words AS (SELECT unnest(regexp_extract_all({_LOWER}, '{_ALNUM}')) AS x FROM benchmark),
hashed AS (SELECT x, {_crc('x')} % 10000 AS b FROM (SELECT x FROM doc_words UNION SELECT x FROM item_words), crc),
raw AS (SELECT b, count(*) AS s FROM doc_words JOIN hashed USING (x) GROUP BY b),
target AS (SELECT b, count(*) AS t FROM item_words JOIN hashed USING (x) GROUP BY b),
sizes AS (SELECT (SELECT count(*) FROM doc_words) AS n_s, (SELECT count(*) FROM item_words) AS n_t),
gains AS (
    SELECT b, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * (n_s + 10000) / (CAST(s + 1 AS DOUBLE) * (n_t + 10000)))) AS BIGINT) AS gain
    FROM raw LEFT JOIN target USING (b), sizes),
sums AS (SELECT doc_id, sum(gain) AS total FROM doc_words JOIN hashed USING (x) JOIN gains USING (b) GROUP BY doc_id),
weights AS (
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n,
        CASE WHEN len(w) = 0 THEN 0 ELSE CAST(total // len(w) - CAST(total % len(w) < 0 AS INTEGER) AS BIGINT) END AS weight,
        CAST('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) AS BIGINT) AS h
    FROM bags d LEFT JOIN sums USING (doc_id)),
scored AS (SELECT doc_id, n, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS score FROM weights),
ordered AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, 10 * count(*) OVER () // 100 AS drawn FROM scored WHERE n >= 20)
SELECT s.doc_id, n AS n_features, weight, score, CASE WHEN r <= drawn THEN r END AS rank
FROM scored s LEFT JOIN ordered o ON o.doc_id = s.doc_id"""

WARC = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS p, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
answers AS (SELECT p, max(page_id) AS answer FROM payloads WHERE n >= 1000 GROUP BY p),
told AS (SELECT page_id, n, payloads.p, CASE WHEN page_id < answer THEN answer END AS refers_to FROM payloads LEFT JOIN answers USING (p))
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(p) AS payload_digest,
    CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to FROM told"""

# Runs by islands of equal words, for periods at which some window of 5, 15, 45... words comes again: a run of
# period q, with four periods or more, holds each window of q to 3q words again after q, and not before.
_WIDTHS = [5 * 3 ** k for k in range(9)]
_LEVELS = ",\n".join(
    f"""l{w} AS (SELECT doc_id, i, CASE WHEN lead(h, {2 * w // 3}) OVER o IS NOT NULL THEN
        hash(h, lead(h, {w // 3}) OVER o, lead(h, {2 * w // 3}) OVER o) END AS h FROM l{w // 3} WINDOW o AS (PARTITION BY doc_id ORDER BY i))"""
    for w in _WIDTHS[1:])
_PERIODS = " UNION ".join(
    f"SELECT doc_id, q FROM (SELECT doc_id, lead(i) OVER (PARTITION BY doc_id, h ORDER BY i) - i AS q FROM l{w} WHERE h IS NOT NULL) WHERE q <= {w}"
    for w in _WIDTHS)

PERIODIC_RUNS = f"""
WITH crc AS ({_CRC_TABLE}),
bags AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w, {_crc('CAST(doc_id AS VARCHAR)')} AS h FROM documents, crc),
planted AS (SELECT *, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM bags),
periodic AS (SELECT *, 1 + (len(w) - a) // (3 + (h // 10) % 8) AS p FROM planted),
texts AS (SELECT doc_id, CASE WHEN a IS NULL THEN w ELSE
    list_transform(range(len(w)), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS w FROM periodic),
words AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) - 1 AS i FROM texts),
l5 AS (SELECT doc_id, i, CASE WHEN lead(x, 4) OVER o IS NOT NULL THEN
        hash(x, lead(x, 1) OVER o, lead(x, 2) OVER o, lead(x, 3) OVER o, lead(x, 4) OVER o) END AS h
    FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
{_LEVELS},
periods AS ({_PERIODS}),
equal AS (
    SELECT doc_id, q, a.i, a.i - row_number() OVER (PARTITION BY doc_id, q ORDER BY a.i) AS island
    FROM periods JOIN words a USING (doc_id) JOIN words b USING (doc_id) WHERE b.i = a.i + q AND a.x = b.x),
stretches AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM equal GROUP BY doc_id, q, island
              HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY doc_id, start, length),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
top AS (SELECT doc_id, count(*) AS n, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS t,
        min(ROW(-length, start, period)) AS best FROM runs GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_runs, best[2] AS start, -best[1] AS length, best[3] AS period,
    1000 * -best[1] // best[3] AS exponent_milli, sha256(coalesce(top.t, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM texts d LEFT JOIN top ON top.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id"""

#: Lines of each pair of neighbouring lines that occurs earlier go, and blank lines left between such lines or a border.
LINE_DEDUP = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
l AS MATERIALIZED (
  SELECT r, doc_id, i, line, regexp_full_match(line, '[ \t\r\x0b\x0c]*') AS blank FROM (
    SELECT r, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM d)),
p AS (SELECT r, doc_id, i, line, blank, lead(line) OVER w AS other, lead(blank) OVER w AS other_blank
      FROM l WHERE doc_id IS NOT NULL WINDOW w AS (PARTITION BY r ORDER BY i)),
f AS (SELECT r, i, doc_id, min({'d': doc_id, 'i': i}) OVER (PARTITION BY line, other) AS least
      FROM p WHERE other IS NOT NULL AND NOT (blank AND other_blank)),
g AS (SELECT DISTINCT r, i + k AS i FROM f, (VALUES (0), (1)) AS v(k) WHERE {'d': doc_id, 'i': f.i} > least),
s AS (SELECT l.*, CASE WHEN g.i IS NOT NULL THEN 1 WHEN blank THEN NULL ELSE 0 END AS state FROM l LEFT JOIN g ON l.r = g.r AND l.i = g.i),
e AS (SELECT *, coalesce(last_value(state IGNORE NULLS) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 1) = 1
             AND coalesce(first_value(state IGNORE NULLS) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 1) = 1
             AND max(coalesce(state, 0)) OVER (PARTITION BY r) = 1 AS gone FROM s),
a AS (SELECT r, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed, string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone) AS kept FROM e GROUP BY r)
SELECT doc_id, CASE WHEN n_removed = 0 THEN text ELSE kept END AS text, n_lines, n_removed FROM d JOIN a USING (r)
"""
