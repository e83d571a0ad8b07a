"""DuckDB SQL for those queries that SQL can express."""

from __future__ import annotations

from waveband.llm import license_scan, quality_rules

_PHRASES = "|".join(quality_rules.BOILERPLATE).replace("'", "''")
_BARS = ", ".join(f"'{bar}'" for bar in quality_rules.BARS)
_BLANK = r"[\x20\x09-\x0D]+"
_RULES = quality_rules.Rules()

OP9 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
win AS (
  SELECT rid, i, array_to_string(ws[i:i + 7], ' ') AS k
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM win) WHERE c > 1),
hit AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 8)) AS p FROM rep) GROUP BY rid),
l AS (
  SELECT rid, generate_subscripts(ls, 1) AS pos, unnest(ls) AS s
  FROM (SELECT rid, string_split(t, chr(10)) AS ls FROM d)),
m AS (
  SELECT rid, pos, s, regexp_extract_all(s, '[^\x20\x09-\x0D]+') AS ws,
    length(s) - length(regexp_replace(s, '[#*$%&|<>!]', '', 'g')) AS marks,
    length(regexp_replace(s, '{_BLANK}', '', 'g')) AS chars,
    row_number() OVER (PARTITION BY rid, s ORDER BY pos) > 1 AS again
  FROM l),
menu AS (
  SELECT *, sum(CASE WHEN item AND before THEN 0 ELSE 1 END) OVER (PARTITION BY rid ORDER BY pos) AS run
  FROM (SELECT *, coalesce(lag(item) OVER (PARTITION BY rid ORDER BY pos), false) AS before
        FROM (SELECT *, len(ws) <= {_RULES.menu_words} AND regexp_matches(ws[-1], '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]$') AS item
              FROM m WHERE len(ws) > 0))),
v AS (
  SELECT *, len(ws) AS n, (
      (marks >= {_RULES.min_marks} AND 100 * marks >= {_RULES.marks_percent} * len(ws))
      OR len(list_filter(ws, lambda x: x IN ({_BARS}))) >= {_RULES.min_bars}
      OR (item AND count(*) OVER (PARTITION BY rid, run) >= {_RULES.menu_lines})
      OR (again AND len(ws) >= {_RULES.min_repeat_words})
      OR (len(ws) <= {_RULES.max_phrase_words}
          AND regexp_matches(translate(s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_PHRASES}'))
    ) AS fails
  FROM menu),
per AS (
  SELECT rid, count(*) AS n_lines, count(*) FILTER (fails) AS n_lines_removed, count(*) FILTER (again) AS n_dup_lines,
    sum(chars) FILTER (NOT fails) AS chars_left
  FROM v GROUP BY rid),
f AS (
  SELECT d.doc_id, len(w.ws) AS n_words, length(regexp_replace(t, '{_BLANK}', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(hit.n, 0) AS n_repeat_words,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_lines_removed, 0) AS n_lines_removed,
    CAST(coalesce(chars_left, 0) AS BIGINT) AS chars_left
  FROM d JOIN w USING (rid) LEFT JOIN hit USING (rid) LEFT JOIN per USING (rid)),
b AS (SELECT *, n_words < {_RULES.min_words} OR 100 * n_repeat_words > {_RULES.repeat_percent} * n_words AS base_failed FROM f)
SELECT *, NOT base_failed AND 100 * chars_left >= {_RULES.keep_percent} * word_chars AS kept FROM b
"""

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS ws FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all({_LOWER}, '{_WORD}') AS ws FROM benchmark),
bw AS (
  SELECT DISTINCT item, least(len(ws), 10) AS m, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS k
  FROM (SELECT item, ws, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i FROM b WHERE len(ws) > 0)),
dw AS (
  SELECT rid, i, m, array_to_string(ws[i:i + m - 1], ' ') AS k
  FROM (
    SELECT rid, ws, m, unnest(range(1, len(ws) - m + 2)) AS i
    FROM d CROSS JOIN (SELECT DISTINCT m FROM bw) WHERE len(ws) >= m)),
occ AS (SELECT rid, i, m, item FROM dw JOIN bw USING (m, k)),
hit AS (
  SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT rid, i, m FROM occ))
  GROUP BY rid),
it AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM occ)
  GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN it USING (rid)
"""

OP7 = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT rid, CASE WHEN len(ws) < 3 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + 2], ' ') END AS k
  FROM (SELECT rid, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
p AS (SELECT x.rid AS a, y.rid AS b, count(*) AS common FROM s AS x JOIN s AS y ON x.k = y.k AND x.rid < y.rid GROUP BY ALL),
l AS (
  SELECT a, b FROM p JOIN n AS x ON x.rid = a JOIN n AS y ON y.rid = b WHERE 100 * common >= 90 * (x.n + y.n - common)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(a, b) AS (SELECT rid, rid FROM d UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(o.doc_id) AS component_id
FROM d LEFT JOIN n USING (rid) JOIN r ON r.a = d.rid JOIN d AS o ON o.rid = r.b GROUP BY d.rid, d.doc_id
"""

_IP_PART = "CAST(substr(regexp_replace(p, '^0+([0-9])', '\\1'), 1, 3) AS INT) <= 255 AND length(regexp_replace(p, '^0+([0-9])', '\\1')) <= 3"
_DIGITS = "regexp_replace(v, '[^0-9]', '', 'g')"
_NEAR = "regexp_matches(lower(right(pre, 40)), '(^|[^a-z])({0})')"
_CONFIRMED = rf"""CASE kind
  WHEN 'ip' THEN len(list_filter(string_split(v, '.'), lambda p: NOT ({_IP_PART}))) = 0
  WHEN 'card' THEN length({_DIGITS}) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, length({_DIGITS}) + 1),
    lambda i: CASE WHEN i % 2 = 1 THEN CAST(substr(reverse({_DIGITS}), i, 1) AS INT)
      ELSE (CAST(substr(reverse({_DIGITS}), i, 1) AS INT) * 2) // 10 + (CAST(substr(reverse({_DIGITS}), i, 1) AS INT) * 2) % 10 END)) % 10 = 0
  WHEN 'phone' THEN length({_DIGITS}) BETWEEN 9 AND 15
  WHEN 'iban' THEN length(replace(v, ' ', '')) BETWEEN 15 AND 34
    AND list_reduce(list_prepend(0, list_transform(string_split(substr(replace(v, ' ', ''), 5) || left(v, 4), ''),
      lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN CAST(ascii(c) - 48 AS BIGINT) ELSE CAST(ascii(c) - 55 AS BIGINT) END)),
      lambda r, x: (r * CASE WHEN x > 9 THEN 100 ELSE 10 END + x) % 97) = 1
  WHEN 'secret' THEN regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]') AND {_NEAR.format("key|token|secret|password|passwd|bearer")}
  ELSE true END"""
#: plain patterns; for IBAN and secret the neighbours are taken into the match and left out again
_PLAIN = (
    ("email", r"([A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)"),
    ("ip", r"([0-9]+\.[0-9]+\.[0-9]+\.[0-9]+)"),
    ("card", r"([0-9](?:[\x20-]?[0-9])+)"),
    ("phone", r"(\+[0-9][\x20().0-9-]+[0-9])"),
    ("iban", r"\b([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)\b"),
    ("secret", r"([A-Za-z0-9+/_-]{32,})"),
)

OP10 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, replace(coalesce(text, ''), chr(1), chr(2)) AS t FROM documents),
parts AS ({" UNION ALL ".join(
    f"SELECT rid, {r} AS rank, '{k}' AS kind, string_split(regexp_replace(t, '{p}', chr(1) || '\\1' || chr(1), 'g'), chr(1)) AS ps FROM d"
    for r, (k, p) in enumerate(_PLAIN))}),
one AS (
  SELECT rid, rank, kind, ps[i] AS v, ps[i - 1] AS pre, list_sum(list_transform(ps[:i - 1], lambda x: length(x))) AS s
  FROM (SELECT *, unnest(range(2, len(ps) + 1, 2)) AS i FROM parts)),
ok AS (
  SELECT rid, rank, kind, CAST(s AS BIGINT) AS s, CAST(s + length(v) AS BIGINT) AS e FROM one
  WHERE {_CONFIRMED} AND (kind <> 'secret' OR length(v) <= 64)),
per AS (
  SELECT rid, count(*) FILTER (rank = 0) AS n_email, count(*) FILTER (rank = 1) AS n_ip, count(*) FILTER (rank = 2) AS n_card,
    count(*) FILTER (rank = 3) AS n_phone,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (rank < 4) AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans
  FROM ok GROUP BY rid)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
  coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per USING (rid)
"""

OP6 = """
WITH p AS (SELECT row_number() OVER () AS rid, page_id, coalesce(html, '') AS h FROM pages),
b AS (
  SELECT *, strlen(h) AS payload_bytes, array_to_string(list_transform(string_split(sha1(h), ''), lambda c:
    substr('0000000100100011010001010110011110001001101010111100110111101111', 4 * (position(c IN '0123456789abcdef') - 1) + 1, 4)), '') AS bits
  FROM p),
d AS (
  SELECT *, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(list_sum(
    list_transform(range(1, 6), lambda k: CAST(substr(bits, 5 * i + k, 1) AS INT) * (1 << (5 - k)))) AS BIGINT), 1)), '') AS payload_digest
  FROM b),
m AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS original FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id <> original THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> original THEN original END AS refers_to
FROM m
"""

_KNOWN = ", ".join(f"('{s}', '{i}')" for s, i in license_scan.ALL_SENTENCES.items())
_LICENSE = "CASE r " + " ".join(f"WHEN '{','.join(r)},' THEN '{n}'" for r, n in license_scan.ALL_RULES) + " END"
_SEQUENCES = "|".join(sorted((",".join(r) + "," for r, _ in license_scan.ALL_RULES), key=lambda x: (-x.count(","), x))) + "|[a-z0-9-]+,"
_RESTRICTED = ", ".join(f"'{n}'" for n in license_scan.ALL_RESTRICTED)
_NAMED = license_scan.NAMED + license_scan.HOLDER + license_scan.NAMED_BY

OP8 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
u AS (
  SELECT rid, generate_subscripts(us, 1) AS unit, unnest(us) AS u FROM (
    SELECT rid, string_split(regexp_replace(regexp_replace(regexp_replace(t, '[.;:]([\x20\t\r\n])', chr(11) || '\1', 'g'), '[.;:]$', ''),
      '\n([^0-9A-Za-z\x{{80}}-\x{{10FFFF}}\n]*\n)+', chr(11), 'g'), chr(11)) AS us FROM d)),
l AS (
  SELECT rid, unit, list_filter(list_transform(string_split(u, chr(10)),
      lambda x: translate(trim(regexp_replace(x, '[^0-9A-Za-z\x{{80}}-\x{{10FFFF}}]+', ' ', 'g'), ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')),
    lambda x: x <> '') AS ls FROM u),
p AS (
  SELECT rid, unit, regexp_extract_all(chr(10) || array_to_string(ls, chr(10) || chr(10)) || chr(10), '{license_scan.parts_pattern(license_scan.ALL_SENTENCES)}') AS ps
  FROM l WHERE len(ls) > 0),
s AS (
  SELECT rid, unit, generate_subscripts(ps, 1) AS pos,
    regexp_replace(trim(replace(unnest(ps), chr(10) || chr(10), ' '), chr(10)), '^{license_scan.GAP.pattern}', '{_NAMED}') AS s FROM p),
k(s, id) AS (VALUES {_KNOWN}),
i AS (
  SELECT rid, count(*) AS n_sentences, coalesce(list(id ORDER BY unit, pos) FILTER (id IS NOT NULL), []) AS ids
  FROM s LEFT JOIN k USING (s) GROUP BY rid),
m AS (
  SELECT d.doc_id, coalesce(n_sentences, 0) AS n_sentences, coalesce(ids, []) AS ids,
    list_filter(list_transform(regexp_extract_all(array_to_string(coalesce(ids, []), ',') || ',', '{_SEQUENCES}'), lambda r: {_LICENSE}), lambda x: x IS NOT NULL) AS found
  FROM d LEFT JOIN i USING (rid))
SELECT doc_id, n_sentences, CAST(len(found) AS BIGINT) AS n_matches, array_to_string(ids, ',') AS sentence_ids,
  array_to_string(list_sort(list_distinct(found)), ',') AS licenses,
  len(list_filter(found, lambda x: x IN ({_RESTRICTED}))) > 0 AS restricted
FROM m
"""

_FROM = "".join(map(chr, range(0xC0, 0x100)))
#: DuckDB's levenshtein counts bytes, so each letter beyond ASCII stands as one ASCII character of its own
_TO = "".join(c for c in map(chr, range(0x21, 0x7F)) if not c.islower() and c not in "'")[: len(_FROM)]

OP11 = rf"""
WITH RECURSIVE bits AS (
  SELECT list(c ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, _: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)) AS c
    FROM (SELECT unnest(range(256)) AS i))),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents),
each_run AS (SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= 5 GROUP BY ALL),
hexed AS (SELECT run, n, hex(encode(id || ':' || run)) AS x FROM each_run),
summed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(length(x) // 2), lambda i: ('0x' || x[2 * i + 1:2 * i + 2])::BIGINT)),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]))) AS h
  FROM hexed, bits),
cut AS (
  SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word
  FROM summed),
v AS (
  SELECT word, n, translate(word, '{_FROM}', '{_TO}') AS flat FROM (
    SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3)),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM v a JOIN v b
  ON abs(length(a.word) - length(b.word)) <= 1 AND a.word <> b.word AND levenshtein(a.flat, b.flat) = 1),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n FROM near GROUP BY word),
formed AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * v.n THEN other END AS form,
    CASE WHEN other_n >= 2 * v.n THEN other_n END AS form_n
  FROM v LEFT JOIN best USING (word)),
led AS (
  SELECT word, word AS spot, 0 AS step FROM formed
  UNION ALL SELECT led.word, formed.form, step + 1 FROM led JOIN formed ON formed.word = led.spot WHERE formed.form IS NOT NULL)
SELECT f.word, f.form, ended.root, f.n, f.n_near, f.form_n
FROM formed f JOIN (SELECT word, arg_max(spot, step) AS root FROM led GROUP BY word) ended USING (word)
"""

ORACLE_SQL: dict[str, str] = {
    "op3_decontamination": OP3,
    "op6_warc": OP6,
    "op7_jaccard_join": OP7,
    "op8_license_scan": OP8,
    "op9_quality_rules": OP9,
    "op10_personal_data": OP10,
    "op11_spelling_variants": OP11,
}
