"""DuckDB twins of the registered queries that SQL can express."""

from __future__ import annotations

SQL: dict[str, str] = {}

#: Words of a text column ``t``: runs of anything but the six blanks.
_BLANK = r"[\x20\x09-\x0D]+"

SQL["op8_source_mixing"] = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '{_BLANK}'), lambda x: x <> '') AS w
  FROM documents),
n AS (
  SELECT doc_id, source, len(w)::BIGINT AS size,
         CASE WHEN len(w) = 0 THEN 1.0::DOUBLE ELSE
           0.5::DOUBLE + 0.5::DOUBLE * (length(array_to_string(w, ''))
           - (length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g'))))::DOUBLE
           / length(array_to_string(w, ''))::DOUBLE END AS quality,
         (('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(t)), 1, 12))
          ::BIGINT::DOUBLE + 0.5::DOUBLE) / 281474976710656.0::DOUBLE AS u
  FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM n GROUP BY source),
w AS (
  SELECT *, [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3]
           ::DOUBLE AS weight, 2.0::DOUBLE * source_size AS cap
  FROM s),
b AS (SELECT 1.5::DOUBLE * sum(source_size) AS budget FROM s),
-- the level by halving would be inexact: it is the only one that fits its own set of capped sources
l AS (
  SELECT a.cap / a.weight AS stop,
         (SELECT sum(cap) FROM w x WHERE x.cap / x.weight < a.cap / a.weight) AS capped,
         (SELECT sum(weight) FROM w x WHERE x.cap / x.weight >= a.cap / a.weight) AS open_weight
  FROM w a),
lev AS (
  SELECT min(((SELECT budget FROM b) - coalesce(capped, 0.0)) / open_weight) AS level
  FROM (SELECT *, lag(stop) OVER (ORDER BY stop) AS last FROM (SELECT DISTINCT * FROM l))
  WHERE ((SELECT budget FROM b) - coalesce(capped, 0.0)) / open_weight <= stop
    AND ((SELECT budget FROM b) - coalesce(capped, 0.0)) / open_weight >= coalesce(last, 0.0)),
t AS (
  SELECT source, source_size,
         least(cap, coalesce((SELECT level FROM lev) * weight, cap))::DOUBLE AS target FROM w),
p AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs
  FROM t),
r AS (
  SELECT n.*, p.source_size, p.target, p.epochs,
         floor(p.target)::BIGINT - p.epochs * p.source_size AS rest,
         coalesce(sum(size) OVER (PARTITION BY n.source ORDER BY -ln(u) / quality, doc_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM n JOIN p ON n.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, source, size, source_size, target,
       (epochs * size + greatest(0, least(size, rest - ahead)))::BIGINT AS taken
FROM r
"""

SQL["op2_warc_chunks"] = """
WITH p AS (
  SELECT page_id, coalesce(url, '') AS url, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest, coalesce(html, '') AS body
  FROM pages),
g AS (
  SELECT body, max(page_id) AS last, count(*) AS copies FROM p WHERE payload_bytes >= 1000
  GROUP BY body),
r AS (
  SELECT p.*, CASE WHEN copies > 1 AND (page_id IS NULL OR page_id < last) THEN last END AS refers_to
  FROM p LEFT JOIN g USING (body))
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to, url,
       CASE WHEN refers_to IS NULL THEN greatest(1, ceil(payload_bytes / 65536.0)) ELSE 1 END::BIGINT
         AS n_chunks
FROM r
"""

SQL["op3_nn_descent"] = """
WITH RECURSIVE e AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
g AS (
  SELECT * FROM e WHERE label IS NOT NULL AND v IS NOT NULL AND len(v) > 0
    AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0),
p AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM g a JOIN g b
    ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
r AS (
  SELECT u, u AS w FROM (SELECT DISTINCT u FROM p)
  UNION SELECT r.u, p.w FROM r JOIN p ON r.w = p.u),
c AS (SELECT u, min(w) AS component_id FROM r GROUP BY u),
n AS (SELECT u, count(*) AS n_links FROM p GROUP BY u)
SELECT e.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links,
       coalesce(c.component_id, e.vec_id)::BIGINT AS component_id,
       coalesce(c.component_id, e.vec_id) = e.vec_id AS kept
FROM e LEFT JOIN n ON n.u = e.vec_id LEFT JOIN c ON c.u = e.vec_id
"""

#: CRC-32 (unsigned) of an ASCII string, bit by bit.
_CRC32 = """xor(list_reduce(flatten([[4294967295]] || list_transform(string_split({0}, ''),
    lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x)
      ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)"""


def _framed(*fields: str) -> str:
    return " || ".join(f"coalesce(strlen({f}::VARCHAR) || ':' || {f}::VARCHAR, '-')"
                       for f in fields)


SQL["op12_merkle_manifest"] = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, coalesce('=' || lang, '-') AS part,
    sha256({_framed("doc_id", "source", "lang", "n_chars", "text")}) AS leaf,
    sha256({_framed("doc_id", "source", "lang", "more", "text")}) AS claim
  FROM (SELECT *, n_chars::HUGEINT + CASE WHEN {_CRC32.format("doc_id::VARCHAR")} % 7 = 0
                  THEN 1 ELSE 0 END AS more FROM documents)),
num AS (
  SELECT *, row_number() OVER (PARTITION BY part ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY part) AS n FROM d),
-- every level of every tree
lev(part, level, pos, n, node) AS (
  SELECT part, 0, pos, n, leaf FROM num
  UNION ALL
  SELECT part, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY pos))
  FROM lev WHERE n > 1 GROUP BY part, level, pos // 2, n),
subs AS (
  SELECT part, node AS subroot, row_number() OVER (ORDER BY part) - 1 AS pos, count(*) OVER () AS n
  FROM lev WHERE n = 1),
glev(level, pos, n, node) AS (
  SELECT 0, pos, n, subroot FROM subs
  UNION ALL
  SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY pos))
  FROM glev WHERE n > 1 GROUP BY level, pos // 2, n),
-- leaves climb, first in their group, then with it
up(part, leaf_pos, level, pos, n, sibs, fold) AS (
  SELECT part, pos, 0, pos, n, '', claim FROM num
  UNION ALL
  SELECT u.part, u.leaf_pos, u.level + 1, u.pos // 2, (u.n + 1) // 2, u.sibs || coalesce(s.node, ''),
         sha256(CASE WHEN u.pos % 2 = 1 THEN coalesce(s.node, '') || u.fold
                     ELSE u.fold || coalesce(s.node, '') END)
  FROM up u LEFT JOIN lev s ON s.part = u.part AND s.level = u.level AND s.pos = xor(u.pos, 1)
  WHERE u.n > 1),
gup(part, leaf_pos, subroot, level, pos, n, sibs, fold) AS (
  SELECT u.part, u.leaf_pos, g.subroot, 0, g.pos, g.n, u.sibs, u.fold
  FROM up u JOIN subs g USING (part) WHERE u.n = 1
  UNION ALL
  SELECT u.part, u.leaf_pos, u.subroot, u.level + 1, u.pos // 2, (u.n + 1) // 2,
         u.sibs || coalesce(s.node, ''),
         sha256(CASE WHEN u.pos % 2 = 1 THEN coalesce(s.node, '') || u.fold
                     ELSE u.fold || coalesce(s.node, '') END)
  FROM gup u LEFT JOIN glev s ON s.level = u.level AND s.pos = xor(u.pos, 1)
  WHERE u.n > 1)
SELECT num.doc_id, num.leaf, g.subroot, r.node AS root, sha256(g.sibs) AS proof_sha256,
       g.fold AS folded_root, g.fold = r.node AS verified
FROM num JOIN gup g ON g.part = num.part AND g.leaf_pos = num.pos AND g.n = 1
JOIN (SELECT node FROM glev WHERE n = 1) r ON true
"""


def _least_edits() -> str:
    """One step of the backward search: options as (cost, audit, repaired lines),
    compared in this order."""
    def opt(cost: str, letter: str, to: str, lines: str) -> str:
        return f"{{'c': {cost} + {to}.c, 'a': '{letter}' || {to}.a, 'r': {lines} || {to}.r}}"

    def row(state: int, to: int, role: str) -> str:
        keep = {0: "ini IN ('s', 'u')", 2: "ini = 'a'"}.get(state, "ini = 'u'")
        kept = f"CASE ini WHEN 's' THEN {opt('cut', 'K', 't.v1', 'line')} ELSE " \
               f"{opt('cut', 'K', f't.v{to}', 'line')} END"
        named = "'\n" + role + ":' || text"
        return f"""least({opt('3', 'D', f't.v{state}', "''")},
      CASE WHEN NOT gone AND {keep} THEN {kept} END,
      CASE WHEN NOT gone THEN {opt('2 + cut', 'R', f't.v{to}', named)} END)"""

    def ins(frm: str, to: str, role: str) -> str:
        return f"least({frm}, {opt('2', 'I', to, chr(39) + chr(92) + 'n' + role + ':' + chr(39))})"

    return f"""
  SELECT conv_id, i, {ins('w0', 'x2', 'user')} AS v0, {ins('w1', 'x2', 'user')} AS v1, x2 AS v2, x3 AS v3
  FROM (SELECT *, {ins('w2', 'w3', 'assistant')} AS x2, {ins('w3', 'w2', 'user')} AS x3 FROM (
    SELECT f.conv_id, f.i, {row(0, 2, 'user')} AS w0, {row(1, 2, 'user')} AS w1,
      {row(2, 3, 'assistant')} AS w2, {row(3, 2, 'user')} AS w3
    FROM t JOIN f ON f.conv_id IS NOT DISTINCT FROM t.conv_id AND f.i = t.i - 1))"""


SQL["op11_conversation_repair"] = f"""
WITH RECURSIVE x AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_CRC32.format("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS hit
  FROM conversations),
y AS (
  SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
    CASE hit WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE hit WHEN 3 THEN [1, 2] WHEN 0 THEN [] ELSE [1] END) AS copy
  FROM x),
z AS (
  SELECT *, row_number() OVER o AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
    left(role, 1) AS ini, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS solid
  FROM y WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy)),
f AS (
  SELECT *, solid = '' AS blank, solid <> '' AND nth > 1 AS duplicate,
    solid <> '' AND nth = 1 AND right(solid, 1) NOT IN ('.', '!', '?') AS truncated,
    CASE WHEN solid <> '' AND nth = 1 AND right(solid, 1) NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS cut,
    solid = '' OR nth > 1 AS gone, '\n' || role || ':' || text AS line,
    lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini AS pair
  FROM z),
n AS (
  SELECT conv_id, count(*) AS n, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
    count(*) FILTER (truncated) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv_id),
t(conv_id, i, v0, v1, v2, v3) AS (
  SELECT conv_id, n + 1, {{'c': 0::BIGINT, 'a': '', 'r': ''}},
    {{'c': 4::BIGINT, 'a': 'II', 'r': '\nuser:\nassistant:'}},
    {{'c': 2::BIGINT, 'a': 'I', 'r': '\nassistant:'}}, {{'c': 0::BIGINT, 'a': '', 'r': ''}}
  FROM n
  UNION ALL {_least_edits()})
SELECT o.conv_id, coalesce(n.gaps, 0)::BIGINT AS gaps, coalesce(n.blank, 0)::BIGINT AS blank,
  coalesce(n.duplicate, 0)::BIGINT AS duplicate, coalesce(n.truncated, 0)::BIGINT AS truncated,
  coalesce(n.illegal, 0)::BIGINT AS illegal, coalesce(t.v0.c, 0)::BIGINT AS cost,
  coalesce(t.v0.a, '') AS audit, sha256(coalesce(substr(t.v0.r, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM o.conv_id AND t.i = 1
""".replace("'\\n", "E'\\n")
