"""Parameters that queries and their SQL share, and the SQL (DuckDB) of those that SQL can express."""

from __future__ import annotations

from vardelta.llm.line_dedup import BREAKS, UNSEEN
from vardelta.llm.mixing import GRID
from vardelta.llm.sharding import MASK, MIX_A, MIX_B, ROUNDS, round_keys

SEED, SHARDS = 20240229, 40
#: Target shares of sources; the rest of the mix goes to the others by their sizes.
MIX_WEIGHTS = {"src0": 0.12, "src1": 0.10, "src2": 0.08, "src3": 0.06, "src4": 0.05, "src5": 0.05}
#: Verdict, host, path.
URL_RULES = [
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LINE_DEDUP_SQL = rf"""
WITH page AS (
  SELECT row_number() OVER () AS rid, page_id,
    translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host0,
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
      '{UNSEEN}', ' ', 'g'),
      '[\t-\r ]+', ' ', 'g'), '(?i)</?({BREAKS})\b[^>]*>', chr(10), 'g'), '<[^>]*>', '', 'g') AS body
  FROM pages),
lined AS (
  SELECT rid, page_id, coalesce(host0, '') AS host,
    list_filter(list_transform(string_split(coalesce(body, ''), chr(10)),
      lambda x: trim(regexp_replace(x, '[ \t\r]+', ' ', 'g'))), lambda x: length(x) > 0) AS lines
  FROM page),
per_line AS (
  SELECT host, line, count(*) AS n
  FROM (SELECT DISTINCT rid, host, unnest(lines) AS line FROM lined) GROUP BY host, line),
per_host AS (SELECT host, count(*) AS pages FROM lined GROUP BY host),
boiler AS (
  SELECT l.host, list(l.line) AS gone FROM per_line l JOIN per_host h ON l.host = h.host
  WHERE l.n >= 2 AND l.n > CAST(0.3 AS DOUBLE) * h.pages GROUP BY l.host),
kept AS (
  SELECT p.page_id, p.host, p.lines,
    list_filter(p.lines, lambda x: NOT list_contains(coalesce(b.gone, []), x)) AS stays
  FROM lined p LEFT JOIN boiler b ON p.host = b.host)
SELECT page_id, host, CAST(len(lines) AS BIGINT) AS n_lines,
  CAST(len(lines) - len(stays) AS BIGINT) AS n_dropped,
  coalesce(array_to_string(stays, chr(10)), '') AS kept_text
FROM kept
"""

_MIXED = f"xor(r, keys[k % {ROUNDS} + 1]) & {MASK}"
_STEP1 = f"((({_MIXED}) * {MIX_A}) & {MASK})"
_STEP2 = f"((xor({_STEP1}, {_STEP1} >> 13) * {MIX_B}) & {MASK})"

#: The numbering, permutation and placing of rows of ``numbered`` (row_no from 0), for any row count.
FEISTEL_CTES = f"""
size AS (SELECT CAST(count(*) AS UBIGINT) AS n FROM numbered),
shape AS (
  SELECT n, CAST(greatest(1, (length(bin(greatest(n, 2) - 1)) + 1) // 2) AS UBIGINT) AS b,
    {round_keys(SEED)}::UBIGINT[] AS keys FROM size),
walk AS (
  SELECT row_no, row_no >> b AS l, row_no & ((1::UBIGINT << b) - 1) AS r, 0 AS k, n, b, keys
  FROM numbered, shape
  UNION ALL
  SELECT row_no, r AS l, xor(l, xor({_STEP2}, {_STEP2} >> 16) & ((1::UBIGINT << b) - 1)) AS r,
    k % {ROUNDS} + 1 AS k, n, b, keys
  FROM walk WHERE NOT (k = {ROUNDS} AND ((l << b) | r) < n)),
moved AS (
  SELECT row_no, CAST((l << b) | r AS BIGINT) AS p FROM walk WHERE k = {ROUNDS} AND ((l << b) | r) < n)
"""

#: The CRC-32 of the UTF-8 bytes of ``text``, by its table of 256 remainders (made from the polynomial).
CRC_TABLE_CTE = """
crc AS (
  SELECT list(list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i))
"""
CRC_OF_TEXT = """
  xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
    lambda x: CAST('0x' || x AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)
"""

SHARDING_SQL = f"""
WITH RECURSIVE numbered AS (
  SELECT doc_id, text, CAST(row_number() OVER (ORDER BY doc_id NULLS FIRST) - 1 AS UBIGINT) AS row_no
  FROM documents),
{FEISTEL_CTES}, {CRC_TABLE_CTE}
SELECT doc_id, CAST(strlen(coalesce(text, '')) + 16 AS BIGINT) AS size, {CRC_OF_TEXT} AS text_crc32,
  'rows' AS law, CAST(p % {SHARDS} AS INTEGER) AS shard, p // {SHARDS} AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM numbered JOIN moved USING (row_no), crc
"""


def _draw(purpose: str, keys: str) -> str:
    return f"CAST('0x' || substr(md5('{SEED}|{purpose}|' || {keys}), 1, 13) AS BIGINT)"


_WEIGHTS = ", ".join(f"('{s}', CAST({w!r} AS DOUBLE))" for s, w in MIX_WEIGHTS.items())
_REST = repr(1.0 - sum(MIX_WEIGHTS.values()))

MIXING_SQL = f"""
WITH RECURSIVE weight(s, w) AS (VALUES {_WEIGHTS}),
doc AS (
  SELECT d.*, coalesce(w.s, 'rest') AS s, coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, ''))) AS name
  FROM documents d LEFT JOIN weight w ON d.source = w.s),
counts AS (SELECT s, CAST(count(*) AS DOUBLE) AS n FROM doc GROUP BY s),
present AS (SELECT c.s, coalesce(w.w, {_REST}) AS w, c.n FROM counts c LEFT JOIN weight w ON c.s = w.s),
rate AS (SELECT s, w / (SELECT sum(w) FROM present) * (SELECT sum(n) FROM counts) / n AS rate FROM present),
steps(s, rate, k, term, total) AS (
  SELECT s, rate, 0, exp(-rate), exp(-rate) FROM rate
  UNION ALL
  SELECT s, rate, k + 1, term * rate / (k + 1), total + term * rate / (k + 1) FROM steps
  WHERE k < 60 AND floor(total * {GRID}) < {GRID}),
step AS (SELECT DISTINCT s, k, CAST(floor(total * {GRID}) AS BIGINT) AS step FROM steps WHERE floor(total * {GRID}) < {GRID}),
drawn AS (SELECT *, {_draw("copies", "name")} AS draw FROM doc),
counted AS (
  SELECT d.doc_id, d.source, d.lang, d.n_chars, d.text, d.name, count(t.k) AS n
  FROM drawn d JOIN step t ON d.s = t.s AND d.draw >= t.step GROUP BY ALL),
taken AS (SELECT doc_id, source, lang, n_chars, text, name, CAST(unnest(range(n)) AS INTEGER) AS copy FROM counted)
SELECT doc_id, source, lang, n_chars, text, copy, {_draw("order", "name || '|' || CAST(copy AS VARCHAR)")} AS mix_key
FROM taken
"""

_WORDS = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

#: From ``documents`` and ``benchmark``: the relation ``occurrence`` (rid, item_id, start, n).
OCCURRENCE_CTES = f"""
item AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n,
    array_to_string(list_slice(w, s, s + least(10, len(w)) - 1), ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS s FROM item WHERE len(w) > 0)),
sized AS (SELECT DISTINCT n FROM win),
place AS (
  SELECT rid, w, n, unnest(range(1, greatest(len(w) - n + 2, 1))) AS start FROM worded, sized),
occurrence AS (
  SELECT DISTINCT p.rid, i.item_id, p.start, p.n FROM place p
  JOIN win i ON i.n = p.n AND i.win = array_to_string(list_slice(p.w, p.start, p.start + p.n - 1), ' '))
"""

DECONTAMINATION_SQL = f"""
WITH worded AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
{OCCURRENCE_CTES},
hit AS (
  SELECT rid, count(*) AS n_hit
  FROM (SELECT DISTINCT rid, unnest(range(start, start + n)) AS at FROM occurrence) GROUP BY rid),
named AS (
  SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
  FROM (SELECT DISTINCT rid, item_id FROM occurrence) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM worded LEFT JOIN hit USING (rid) LEFT JOIN named USING (rid)
"""

#: Every order is walked step by step over counts of documents by the letters they fail.
FILTER_AUDIT_SQL = r"""
WITH doc AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
said AS (
  SELECT doc_id, bool_or(coalesce(quality, 0) = 1) AS good, bool_or(coalesce(toxic, 0) = 1) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
first AS (SELECT t, min(doc_id) AS least FROM doc GROUP BY t),
judged AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    concat(
      CASE WHEN len(w) < 50 THEN 'A' END,
      CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' END,
      CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' END,
      CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END,
      CASE WHEN doc.doc_id > least THEN 'E' END) AS fails
  FROM doc JOIN first USING (t) LEFT JOIN said ON doc.doc_id = said.doc_id),
hist AS (SELECT part, good, toxic, fails, count(*) AS n FROM judged GROUP BY ALL),
letter(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS o FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT o, k, substr(o, k, 1) AS f, substr(o, 1, k - 1) AS past FROM orders, range(1, 6) r(k)),
walked AS (
  SELECT part, o, k, f, n, good, toxic, fails = f AS lone,
    contains(fails, f) AS fails_it, translate(fails, past, '') <> fails AS gone
  FROM hist, steps),
counted AS (
  SELECT part, o, k, f,
    coalesce(sum(n) FILTER (NOT gone AND NOT fails_it), 0) AS kept,
    coalesce(sum(n) FILTER (fails_it AND NOT gone), 0) AS removed,
    coalesce(sum(n) FILTER (fails_it AND gone), 0) AS redundant,
    coalesce(sum(n) FILTER (lone), 0) AS unique_fails,
    coalesce(sum(n) FILTER (fails_it AND NOT gone AND good), 0) AS good_lost,
    coalesce(sum(n) FILTER (fails_it AND NOT gone AND toxic), 0) AS toxic_lost
  FROM walked GROUP BY part, o, k, f)
SELECT part, o AS filter_order, CAST(k AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
  CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted
"""

FILL_MIDDLE_SQL = r"""
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x
  FROM documents),
drawn AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, list_transform(range(4), lambda k: CAST('0x' || substr(x, 8 * k + 1, 8) AS BIGINT)) AS h
  FROM doc),
cut AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS one, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS two,
    CASE WHEN t = '' OR regexp_matches(t, '<[PSM]>') OR h[3] % 100 >= 90 THEN 'plain'
      WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
piece AS (
  SELECT *, coalesce(array_to_string(u[1:one], ''), '') AS p, coalesce(array_to_string(u[one + 1:two], ''), '') AS m,
    coalesce(array_to_string(u[two + 1:], ''), '') AS s
  FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM piece
"""

ORACLE_SQL = {
    "op1_line_dedup": LINE_DEDUP_SQL,
    "op2_sharding": SHARDING_SQL,
    "op4_mix_sources": MIXING_SQL,
    "op5_decontaminate": DECONTAMINATION_SQL,
    "op12_filter_audit": FILTER_AUDIT_SQL,
    "op13_fill_middle": FILL_MIDDLE_SQL,
}
