"""DuckDB SQL of the queries that SQL can express, on views named like the tables."""

from __future__ import annotations

from .licenses import PHRASES, TEMPLATES

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Letters of the keyword in either case, spelled out: RE2 folds further letters.
KEYWORDS = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word) for word in ("password", "passwd", "secret", "token", "api_?key"))
ASSIGN = rf"""({KEYWORDS})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


def _rule(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
    return f"""
    SELECT n, kind, rank, start, start + length(m) AS stop FROM (
      SELECT n, '{kind}' AS kind, {rank} AS rank, m[i] AS m, v[i] AS v,
        (list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::BIGINT AS start
      FROM (SELECT n, string_split_regex(text, '{pattern}') AS p, regexp_extract_all(text, '{pattern}', 0) AS m, regexp_extract_all(text, '{pattern}', {group}) AS v FROM docs)
      CROSS JOIN LATERAL (SELECT unnest(range(1, len(m) + 1)) AS i)
    ) WHERE length(v) >= {least}"""


OP2 = f"""
WITH docs AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS text FROM documents),
found AS ({" UNION ALL ".join((
    _rule("assign", 0, ASSIGN, 2, 6),
    _rule("access", 1, "AKIA[A-Z0-9]+", 0, 20),
    _rule("hex", 2, "[0-9a-f]+", 0, 24),
    _rule("private", 3, "-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", 0, 0),
    _rule("github", 4, "gh[pousr]_[A-Za-z0-9]+", 0, 40),
))}),
spans AS (SELECT n, kind, rank, start, kind || ':' || start || ':' || stop AS span FROM found)
SELECT d.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg(span, ',' ORDER BY start, rank) FILTER (rank < 3), '')) AS base_sha256,
  coalesce(string_agg(span, ',' ORDER BY start, rank), '') AS spans
FROM docs d LEFT JOIN spans s ON d.n = s.n GROUP BY d.n, d.doc_id"""

_GROUPS = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (((('0x' || substr(x, {1 + 5 * i}, 5))::INTEGER) >> {shift}) & 31), 1)" for i in range(8) for shift in (15, 10, 5, 0)
)
OP4 = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS x FROM pages),
q AS (SELECT page_id, payload_bytes, {_GROUPS} AS payload_digest, max(page_id) OVER (PARTITION BY x) AS last FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM q"""

#: Compares all pairs; finds what the operator may miss with a chance of about one in a hundred at the threshold.
OP5 = """
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
good AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS size FROM v WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_dot_product(a.e, b.e) / a.size / b.size >= 0.95),
reach(vec_id, other) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a),
least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
degree AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN least USING (vec_id) LEFT JOIN degree USING (vec_id)"""

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _starts(words: tuple[str, ...]) -> str:
    test = " AND ".join(f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(words))
    return f"list_filter(range(0, len(w)), lambda i: coalesce({test}, false))"


_VALUES = ", ".join(f"({i}, '{label}', string_split('{text}', ' '))" for i, (label, text) in enumerate(TEMPLATES))
#: The best block of a text for a template: of the runs of at most half as many words again, the first that holds most of its different words.
OP6 = f"""
WITH templates AS (SELECT t, label, list_distinct(words) AS tokens, ((3 * len(words) + 1) // 2)::BIGINT AS longest, ceil(0.8 * len(list_distinct(words)) - 1e-9) AS need FROM (VALUES {_VALUES}) v(t, label, words)),
docs AS (SELECT row_number() OVER () AS n, doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS low FROM documents),
base AS (SELECT n, doc_id, regexp_extract_all(low, '{_WORD}') AS w FROM docs),
places AS (SELECT n, doc_id, len(w) AS n_words, {", ".join(f"{_starts(p)} AS p{i}" for i, p in enumerate(PHRASES.values()))} FROM base),
texts AS (SELECT n, b, regexp_extract_all(block, '{_WORD}') AS w
  FROM (SELECT n, unnest(string_split_regex(low, '[.!?;][\\x20\\x09-\\x0D]+|\\n[ \\t\\r]*\\n')) AS block, generate_subscripts(string_split_regex(low, '[.!?;][\\x20\\x09-\\x0D]+|\\n[ \\t\\r]*\\n'), 1) AS b FROM docs WHERE low ~ 'licen|creative|redistribution|permission|gnu|apache|mozilla|cc')),
near AS (SELECT n, b, t, label, tokens, longest, need, w FROM texts, templates WHERE len(list_intersect(w, tokens)) >= need),
runs AS (SELECT n, b, t, label, tokens, need, i, list_distinct(list_filter(w[i:i + longest - 1], lambda x: list_contains(tokens, x))) AS own
  FROM (SELECT *, unnest(list_filter(range(1, len(w) + 1), lambda i: list_contains(tokens, w[i]))) AS i FROM near)),
met AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY n, b, t ORDER BY len(own) DESC, i) = 1 AND len(own) >= need),
plain AS (SELECT * FROM met x WHERE NOT EXISTS (SELECT 1 FROM met y WHERE y.n = x.n AND y.b = x.b AND y.label <> x.label AND len(list_intersect(x.tokens, y.tokens)) >= x.need AND (
  (len(y.own) * len(x.tokens) > len(x.own) * len(y.tokens) AND list_has_all(y.tokens, x.own))
  OR (len(y.own) * len(x.tokens) = len(x.own) * len(y.tokens) AND len(y.tokens) > len(x.tokens) AND list_has_all(y.tokens, x.tokens))))),
labels AS (SELECT n, list_distinct(list(label)) AS found FROM plain GROUP BY n),
shares AS (SELECT n, max(len(own) / len(tokens)) AS share FROM met GROUP BY n),
flat AS (SELECT *, {" || ".join(f"p{i}" for i in range(len(PHRASES)))} AS places,
  list_filter([{", ".join(f"CASE WHEN len(p{i}) > 0 THEN '{label}' END" for i, label in enumerate(PHRASES))}], lambda x: x IS NOT NULL) AS base_found FROM places)
SELECT doc_id, n_words, len(places) AS n_base, list_min(places) AS first_word, list_max(places) AS last_word,
  array_to_string(list_sort(base_found), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(base_found || coalesce(found, []))), ',') AS labels,
  greatest(coalesce(share, 0), (len(places) > 0)::INTEGER)::DOUBLE AS score
FROM flat LEFT JOIN labels USING (n) LEFT JOIN shares USING (n)"""

OP13 = f"""
WITH docs AS (SELECT row_number() OVER () AS n, doc_id, string_split(coalesce(text, ''), chr(10)) AS all_lines FROM documents),
lines AS (SELECT n, doc_id, unnest(all_lines) AS line, generate_subscripts(all_lines, 1) AS nr FROM docs),
keyed AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key FROM lines),
often AS (SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT k.*, keeper IS NOT NULL AND k.doc_id IS DISTINCT FROM keeper AS gone FROM keyed k LEFT JOIN often USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY nr) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY n, doc_id"""

_CRC = "xor(list_reduce([4294967295::UBIGINT] || list_transform(string_split(id, ''), lambda c: ord(c)::UBIGINT), lambda a, b: list_reduce([xor(a, b), 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT], lambda x, i: xor(x >> 1, 3988292384::UBIGINT * (x & 1::UBIGINT)))), 4294967295::UBIGINT)"
_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
#: States 0 to 3: nothing yet, after the system turn, after a user, after an assistant. A step is one row's edit and up to two inserted turns behind it.
OP11 = f"""
WITH RECURSIVE ids AS (SELECT *, row_number() OVER () AS nr, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS id FROM conversations),
hit AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, nr, {_CRC} % 20 AS k FROM ids),
damaged AS (SELECT conv_id, turn, CASE k WHEN 4 THEN 'user' ELSE role END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, nr, unnest(range(0, CASE k WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM hit WHERE k <> 0),
turns AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, nr, copy) AS i, trim(text, {_BLANKS}) AS body FROM damaged),
rows AS (SELECT *, left(role, 1) AS ch, CASE WHEN body = '' THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2 WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
  lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS former FROM turns),
tails(q, r, letters, more, cost) AS (VALUES (0, 0, '', '', 0), (0, 2, 'I', '|user:', 5), (0, 3, 'II', '|user:|assistant:', 10), (1, 1, '', '', 0), (1, 2, 'I', '|user:', 5), (1, 3, 'II', '|user:|assistant:', 10),
  (2, 2, '', '', 0), (2, 3, 'I', '|assistant:', 5), (3, 3, '', '', 0), (3, 2, 'I', '|user:', 5)),
keeps(q, ch, r) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
nexts(q, r, role) AS (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')),
edits AS (
  SELECT conv_id, i, q, q AS r, 'D' AS letter, '' AS line, 2 AS cost FROM rows, (SELECT unnest(range(0, 4))::INTEGER AS q)
  UNION ALL SELECT conv_id, i, q, r, 'K', chr(10) || role || ':' || text, CASE fault WHEN 3 THEN 5 ELSE 0 END FROM rows JOIN keeps USING (ch) WHERE fault IN (0, 3)
  UNION ALL SELECT conv_id, i, q, r, 'R', chr(10) || n.role || ':' || text, CASE fault WHEN 3 THEN 6 ELSE 1 END FROM rows, nexts n WHERE fault IN (0, 3)),
steps AS (SELECT e.conv_id, e.i, e.q, t.r, e.letter || t.letters AS letters, e.line || replace(t.more, '|', chr(10)) AS line, e.cost + t.cost AS cost FROM edits e JOIN tails t ON e.r = t.q),
best(conv_id, i, q, cost, audit, out) AS (
  SELECT c.conv_id, 0::BIGINT, t.r, t.cost, t.letters, replace(t.more, '|', chr(10)) FROM (SELECT DISTINCT conv_id FROM conversations) c, tails t WHERE t.q = 0
  UNION ALL
  SELECT * FROM (SELECT b.conv_id, s.i, s.r, b.cost + s.cost AS cost, b.audit || s.letters AS audit, b.out || s.line AS out FROM best b JOIN steps s ON s.conv_id IS NOT DISTINCT FROM b.conv_id AND s.i = b.i + 1 AND s.q = b.q)
  QUALIFY row_number() OVER (PARTITION BY conv_id, i, r ORDER BY cost, audit) = 1),
last AS (SELECT conv_id, max(i) AS n FROM best GROUP BY conv_id),
chosen AS (SELECT b.* FROM best b JOIN last l ON b.conv_id IS NOT DISTINCT FROM l.conv_id AND b.i = l.n WHERE q IN (0, 3) QUALIFY row_number() OVER (PARTITION BY b.conv_id ORDER BY cost, audit) = 1),
figures AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
  count(*) FILTER (former IS NOT NULL AND former || ch NOT IN ('su', 'ua', 'au')) AS illegal FROM rows GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  c.cost::BIGINT AS cost, c.audit, sha256(substr(c.out, 2)) AS repaired_sha256
FROM chosen c LEFT JOIN figures f ON f.conv_id IS NOT DISTINCT FROM c.conv_id"""

_GRAM = "list_transform(range(1, len(w) - {m} + 2), lambda i: w[i:i + {m} - 1])"
OP12 = f"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\n\x0B\x0C\r]')), '[^ \t]+') AS w FROM documents),
grams AS (SELECT lang, unnest(flatten([{", ".join(_GRAM.format(m=m) for m in range(1, 6))}])) AS g FROM pieces),
f AS (SELECT lang, g, count(*)::BIGINT AS a FROM grams GROUP BY lang, g),
totals AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE len(g) = 1 GROUP BY lang),
often AS (SELECT * FROM f WHERE a >= 100 AND len(g) > 1),
parts AS (SELECT lang, max(a) AS a, part FROM (SELECT lang, a, unnest([g[1:len(g) - 1], g[2:]]) AS part FROM often) GROUP BY lang, part),
free AS (SELECT o.* FROM often o LEFT JOIN parts p ON o.lang = p.lang AND o.g = p.part WHERE p.a IS NULL OR 100 * p.a < 100 * o.a),
cuts AS (SELECT lang, g, a, unnest(range(1, len(g))) AS k FROM free),
scored AS (SELECT c.lang, c.g, c.a, c.k, x.a AS l, y.a AS r, n, ((1000::HUGEINT * c.a * n) // (x.a::HUGEINT * y.a))::BIGINT AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.g = c.g[1:k] JOIN f y ON y.lang = c.lang AND y.g = c.g[k + 1:] JOIN totals t ON t.lang = c.lang),
lowest AS (SELECT *, array_to_string(g, ' ') AS phrase FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM lowest
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000"""

ORACLES = {"op12_collocations": OP12, "op11_conversations": OP11, "op2_secrets": OP2, "op4_warc": OP4, "op5_embeddings": OP5, "op6_licenses": OP6, "op13_lines": OP13}
