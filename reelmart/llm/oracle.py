"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

from reelmart.llm.filter_audit import CAPITAL_PERCENT, DISTINCT_PERCENT
from reelmart.llm.filter_audit import MIN_WORDS as MIN_AUDIT_WORDS
from reelmart.llm.jaccard import GRAM, SIMILARITY
from reelmart.llm.line_dedup import MIN_DOCS, MIN_POINTS, UPPER
from reelmart.llm.repetition import (
    BASE_LENGTH, BASE_PERCENT, DUPLICATE_LIMITS, LINE_CHAR_LIMIT, LINE_LIMIT, MIN_WORDS)
from reelmart.llm.url_rules import RULES

WORD = r"[^\x20\x09-\x0D]+"

OP6 = rf"""
WITH d AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size,
         -ln((CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5::DOUBLE)
             / 4503599627370496::DOUBLE)
         / coalesce(greatest(0.05::DOUBLE, 1::DOUBLE - 2::DOUBLE * (len(regexp_extract_all(text, '[!-@\[-`{{-~]'))::DOUBLE
                                            / greatest(len(text), 1)::DOUBLE)), 1::DOUBLE) AS k
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT)] AS wt,
             row_number() OVER (ORDER BY source NULLS LAST) AS i FROM s),
l AS (SELECT *, row_number() OVER o AS pos,
             (1.5::DOUBLE * sum(source_size) OVER ()
              - 2.0::DOUBLE * coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / (sum(wt) OVER () - coalesce(sum(wt) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
      FROM w WINDOW o AS (ORDER BY source_size / wt, i)),
f AS (SELECT min(pos) AS pos, arg_min(level, pos) AS level FROM l WHERE level * wt <= 2.0::DOUBLE * source_size),
t AS (SELECT l.source, l.source_size,
             CASE WHEN f.pos IS NULL OR l.pos < f.pos THEN 2.0::DOUBLE * l.source_size ELSE f.level * l.wt END AS target
      FROM l, f),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM t),
p AS (SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs,
             e.target - e.epochs * e.source_size AS rest,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id NULLS FIRST) AS upto,
             sum(d.size) OVER (PARTITION BY d.source, d.k, d.doc_id) AS own
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (epochs + CASE WHEN upto - own / 2.0 <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM p"""

_rules = ",\n  ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
OP10 = rf"""
WITH r(verdict, host, path) AS (VALUES
  {_rules}),
u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
      FROM pages),
s AS (SELECT page_id, row_number() OVER () AS n,
             translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
b AS (SELECT s.n, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
             arg_max(r.verdict, length(r.host || r.path)) AS verdict
      FROM s JOIN r ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path)
      GROUP BY s.n)
SELECT s.page_id, s.host, s.path, b.rule, coalesce(b.verdict, 'allow') AS verdict
FROM s LEFT JOIN b ON s.n = b.n"""

_lengths = sorted({BASE_LENGTH, *DUPLICATE_LIMITS})


def _gram(n: int) -> str:
    parts = ["w", *(f"lead(w, {k}) OVER o" for k in range(1, n))]
    return f"CASE WHEN n - i >= {n - 1} THEN " + " || ' ' || ".join(parts) + f" END AS g{n}"


_limits = " OR ".join(f"share_{n} > {limit}" for n, limit in DUPLICATE_LIMITS.items())
OP8 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
t AS (SELECT r, regexp_extract_all(text, '{WORD}') AS ws FROM d),
w AS (SELECT r, len(ws) AS n, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM t),
g AS (SELECT r, i, length(w) AS size, {", ".join(_gram(n) for n in _lengths)}
      FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
f AS (SELECT r, i, size, {", ".join(
    f"CAST(g{n} IS NOT NULL AND count(g{n}) OVER (PARTITION BY r, g{n}) > 1 AS INTEGER) AS f{n}" for n in _lengths)}
      FROM g),
c AS (SELECT r, size, {", ".join(
    f"max(f{n}) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS c{n}" for n in _lengths)}
      FROM f),
s AS (SELECT r, count(*) AS n_words, sum(size) AS word_chars, sum(c{BASE_LENGTH}) AS n_repeat_words,
             {", ".join(f"sum(c{n} * size)::DOUBLE AS dup_{n}" for n in DUPLICATE_LIMITS)}
      FROM c GROUP BY r),
l AS (SELECT r, line, idx, length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS size,
             row_number() OVER (PARTITION BY r, line ORDER BY idx) > 1 AS dup
      FROM (SELECT r, unnest(string_split(text, chr(10))) AS line,
                   generate_subscripts(string_split(text, chr(10)), 1) AS idx FROM d)
      WHERE regexp_matches(line, '{WORD}')),
x AS (SELECT r, sum(dup::INTEGER) AS n_dup, sum(dup::INTEGER)::DOUBLE / count(*) AS line_share,
             sum(CASE WHEN dup THEN size ELSE 0 END)::DOUBLE / sum(size) AS line_char_share FROM l GROUP BY r),
a AS (SELECT doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words,
             CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
             coalesce(line_share, 0::DOUBLE) AS line_share, coalesce(line_char_share, 0::DOUBLE) AS line_char_share,
             {", ".join(f"coalesce(dup_{n} / word_chars, 0::DOUBLE) AS share_{n}" for n in DUPLICATE_LIMITS)}
      FROM d LEFT JOIN s USING (r) LEFT JOIN x USING (r)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {BASE_PERCENT} * n_words AS base_failed FROM a)
SELECT *, NOT base_failed AND NOT (line_share > {LINE_LIMIT} OR line_char_share > {LINE_CHAR_LIMIT}
                                   OR {_limits}) AS kept
FROM b"""

OP7 = rf"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
sets AS (SELECT DISTINCT r, unnest(CASE
    WHEN len(ws) >= {GRAM} THEN list_transform(range(1, len(ws) - {GRAM - 2}), lambda i: array_to_string(ws[i:i + {GRAM - 1}], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
size AS (SELECT r, count(*) AS n FROM sets GROUP BY r),
pairs AS (SELECT a.r AS x, b.r AS y, count(*) AS n FROM sets a JOIN sets b ON a.g = b.g AND a.r <> b.r GROUP BY 1, 2),
link AS (SELECT x, y FROM pairs JOIN size p ON p.r = x JOIN size q ON q.r = y
         WHERE pairs.n >= {SIMILARITY} * (p.n + q.n - pairs.n) - 1e-9),
near AS (SELECT r, r AS m FROM w UNION SELECT near.r, link.y FROM near JOIN link ON link.x = near.m)
SELECT any_value(w.doc_id) AS doc_id, min(o.doc_id) AS class_id,
       (SELECT count(*) FROM link WHERE link.x = w.r) AS n_links
FROM near JOIN w ON w.r = near.r JOIN w o ON o.r = near.m
GROUP BY w.r"""

# conversations: the states of the grammar as structs (cost, edits, text), one step a row
_CRC = ("xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({0}, ''), lambda x: ascii(x)::BIGINT)),"
        " lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295)")


def _plus(state: str, edits: str, cost: str, text: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{edits}', 't': {state}.t || {text}}}"


def _least(*states: str) -> str:
    return f"list_min([{', '.join(states)}])"


_U, _A = "'user:' || chr(10)", "'assistant:' || chr(10)"
_INSERTED = {
    "p0": "s0", "p1": "s1",
    "p2": _least("s2", *[_plus(s, "I", "3", _U) for s in ("s0", "s1", "s3")]),
    "p3": _least("s3", _plus("s2", "I", "3", _A), *[_plus(s, "II", "6", f"{_U} || {_A}") for s in ("s0", "s1")])}
_NEVER = "{'c': 1000000000::BIGINT, 'a': '', 't': ''}"


def _reach(state: str, initial: str, role: str | None) -> str:
    keep = f"WHEN initial = '{initial}' THEN {_plus(state, 'K', 'more', "role || ':' || text || chr(10)")}"
    other = _plus(state, "R", "3 + more", f"'{role}:' || text || chr(10)") if role else _NEVER
    return f"CASE WHEN lost THEN {_NEVER} {keep} ELSE {other} END"


_D = {q: _plus(f"p{q}", "D", "4", "''") for q in range(4)}
OP11 = rf"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
      lambda c, z: xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END))) AS crc),
d AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             {_CRC.format("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS lot
      FROM conversations, crc),
r AS (SELECT conv_id, turn, CASE lot WHEN 4 THEN 'user' ELSE role END AS role,
             CASE lot WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(CASE lot WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
      FROM d WHERE lot <> 0),
f AS (SELECT *, left(role, 1) AS initial, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
             rtrim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS cut FROM r),
a AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again FROM f),
o AS (SELECT *, cut = '' AS blank, cut <> '' AND again AS duplicate, cut = '' OR again AS lost,
             cut <> '' AND NOT again AND right(cut, 1) NOT IN ('.', '!', '?') AS truncated,
             i > 1 AND lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS illegal,
             CASE WHEN truncated THEN 3 ELSE 0 END AS more FROM a),
walk AS (SELECT DISTINCT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS s0, {_NEVER} AS s1,
                {_NEVER} AS s2, {_NEVER} AS s3 FROM conversations
  UNION ALL
  SELECT conv_id, i, {_D[0]}, {_least(_D[1], _reach("p0", "s", None))},
         {_least(_D[2], *[_reach(p, "u", "user") for p in ("p0", "p1", "p3")])},
         {_least(_D[3], _reach("p2", "a", "assistant"))}
  FROM (SELECT w.conv_id, o.i, role, text, initial, lost, more, {", ".join(f"{e} AS {p}" for p, e in _INSERTED.items())}
        FROM walk w JOIN o ON o.conv_id IS NOT DISTINCT FROM w.conv_id AND o.i = w.i + 1)),
e AS (SELECT conv_id, arg_max({_least("s0", "s3", _plus("s2", "I", "3", _A), _plus("s1", "II", "6", f"{_U} || {_A}"))}, i) AS b
      FROM walk GROUP BY conv_id),
n AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank,
             count_if(duplicate) AS duplicate, count_if(truncated) AS truncated, count_if(illegal) AS illegal
      FROM o GROUP BY conv_id)
SELECT e.conv_id, coalesce(n.gaps, 0)::BIGINT AS gaps, coalesce(n.blank, 0)::BIGINT AS blank,
       coalesce(n.duplicate, 0)::BIGINT AS duplicate, coalesce(n.truncated, 0)::BIGINT AS truncated,
       coalesce(n.illegal, 0)::BIGINT AS illegal, e.b.c::BIGINT AS cost, e.b.a AS audit,
       sha256(left(e.b.t, greatest(length(e.b.t) - 1, 0))) AS repaired_sha256
FROM e LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM e.conv_id"""

OP12 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d),
k AS (SELECT *, translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '),
                          '{UPPER}', '{UPPER.lower()}') AS key FROM l),
h AS (SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= {MIN_POINTS} GROUP BY key
      HAVING count(DISTINCT doc_id) + max((doc_id IS NULL)::INTEGER) >= {MIN_DOCS}),
x AS (SELECT k.*, h.key IS NOT NULL AND k.doc_id IS DISTINCT FROM h.holder AS gone FROM k LEFT JOIN h ON k.key = h.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count_if(gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM x GROUP BY r"""

_f = {"A": f"len(words) < {MIN_AUDIT_WORDS}", "B": f"100 * len(list_distinct(words)) < {DISTINCT_PERCENT} * len(words)",
      "C": f"100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > {CAPITAL_PERCENT} * length(text)",
      "D": "regexp_matches(text, '[#$%&*|]')", "E": "coalesce(t.doc_id > first, false)"}
OP13 = rf"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
                  min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first,
                  coalesce(regexp_extract_all(text, '{WORD}'), []) AS words FROM documents),
l AS (SELECT doc_id, coalesce(max((quality = 1)::INTEGER), 0) AS good, coalesce(max((toxic = 1)::INTEGER), 0) AS bad
      FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
g AS (SELECT part, {" || ".join(f"CASE WHEN {c} THEN '{x}' ELSE '' END" for x, c in _f.items())} AS fails,
             count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(bad), 0) AS bad
      FROM t LEFT JOIN l ON t.doc_id = l.doc_id GROUP BY 1, 2),
f AS (SELECT unnest(string_split('ABCDE', '')) AS f),
o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM f a, f b, f c, f d, f e
      WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
s AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM o),
x AS (SELECT part, filter_order, step, substr(filter_order, step, 1) AS f, n, good, bad, fails,
             translate(left(filter_order, step - 1), fails, '') = left(filter_order, step - 1) AS here,
             contains(fails, substr(filter_order, step, 1)) AS failed
      FROM s, g),
y AS (SELECT part, filter_order, step, any_value(f) AS f,
             coalesce(sum(n) FILTER (here AND NOT failed), 0)::BIGINT AS kept,
             coalesce(sum(n) FILTER (here AND failed), 0)::BIGINT AS removed,
             coalesce(sum(n) FILTER (failed AND NOT here), 0)::BIGINT AS redundant,
             coalesce(sum(n) FILTER (failed AND length(fails) = 1), 0)::BIGINT AS unique_fails,
             coalesce(sum(good) FILTER (here AND failed), 0)::BIGINT AS good_lost,
             coalesce(sum(bad) FILTER (here AND failed), 0)::BIGINT AS toxic_lost
      FROM x GROUP BY part, filter_order, step)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM y"""
