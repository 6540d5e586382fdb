"""SQL twins of the queries of this folder, where SQL can express them."""

from __future__ import annotations

from windrow.llm.licences import TEMPLATES

# Pieces between matches and the matches give the offsets.
_KIND = """
{kind}_m AS (SELECT doc_id, regexp_extract_all(t, '{pattern}') m, string_split_regex(t, '{pattern}') p FROM docs),
{kind} AS (
  SELECT doc_id, '{kind}' AS kind, {place} AS place, m[i] AS hit,
    list_sum([length(x) for x in p[1:i]]) + coalesce(list_sum([length(x) for x in m[1:i - 1]]), 0) AS s
  FROM (SELECT doc_id, m, p, unnest(range(1, len(m) + 1)) AS i FROM {kind}_m WHERE len(m) > 0)
)"""

_PATTERNS = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""",
    "access": "AKIA[A-Z0-9]+",
    "hex": "[0-9a-f]+",
}

SECRETS = (
    "WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),"
    + ",".join(
        _KIND.format(kind=k, pattern=p, place=i) for i, (k, p) in enumerate(_PATTERNS.items())
    )
    + rf""",
hits AS (
  SELECT doc_id, kind, place, s::BIGINT AS s, (s + length(hit))::BIGINT AS e FROM (
    SELECT * FROM assign WHERE length(regexp_extract(hit, '{_PATTERNS["assign"]}', 2)) >= 8
    UNION ALL SELECT * FROM access WHERE length(hit) >= 16
    UNION ALL SELECT * FROM hex WHERE length(hit) >= 32)
),
found AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place) AS spans
  FROM hits GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs d LEFT JOIN found USING (doc_id)"""
)

_SHARES = """
  [{'m': 'symbols', 'v': coalesce((1000000 * n_symbols) // nullif(word_chars, 0), 0)},
   {'m': 'dup_lines', 'v': coalesce((1000000 * n_dup_lines) // nullif(n_lines, 0), 0)},
   {'m': 'repeats', 'v': coalesce((1000000 * n_repeat_words) // nullif(n_words, 0), 0)},
   {'m': 'word_length', 'v': coalesce((1000000 * word_chars) // nullif(n_words, 0), 0)}]"""


def _limits(name: str, by: str) -> str:
    keys = by + ", " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""
{name}_b AS (SELECT {keys}m, b, count(*) AS n FROM sketched GROUP BY {keys}m, b),
{name}_w AS (
  SELECT *, sum(n) OVER (PARTITION BY {keys}m ORDER BY b) AS below, sum(n) OVER (PARTITION BY {keys}m) AS total
  FROM {name}_b),
{name}_q AS (
  SELECT {keys}m, max(total) AS size, min(b) FILTER (100 * below >= 50 * total) AS mid,
    min(b) FILTER (100 * below >= CASE WHEN m IN ('symbols', 'word_length') THEN 75 ELSE 95 END * total) AS high,
    min(b) FILTER (100 * below >= 25 * total) AS low
  FROM {name}_w GROUP BY {keys}m),
{name} AS (
  SELECT {keys}max(size)::BIGINT AS size,
    max(high + greatest(3 * (high - mid), 20000)) FILTER (m = 'symbols') AS symbols,
    max(high + greatest(3 * (high - mid), 300000)) FILTER (m = 'dup_lines') AS dup_lines,
    max(high + greatest(3 * (high - mid), 200000)) FILTER (m = 'repeats') AS repeats,
    max(high + greatest(3 * (high - mid), 700000)) FILTER (m = 'word_length') AS longest,
    max(greatest(mid - greatest(3 * (mid - low), 1200000), 0)) FILTER (m = 'word_length') AS shortest
  FROM {name}_q {group})"""


def _drawn(limit: str) -> str:
    """A group's limit drawn towards its language's, and that one towards the limit of all."""
    return (
        f"(a.size * a.{limit} + 100 * ((b.size * b.{limit} + 100 * c.{limit}) // (b.size + 100))) // (a.size + 100)"
    )


QUALITY = (
    r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM docs),
starts AS (SELECT r, i, w[i:i + 7] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM split)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM starts) WHERE c > 1),
covered AS (
  SELECT r, sum(least(8, coalesce(nxt - i, 8))) AS n
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM again) GROUP BY r),
measured AS (
  SELECT s.r, doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l) AS n_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM split s LEFT JOIN covered c ON s.r = c.r),
shares AS (SELECT *, """
    + _SHARES
    + """ AS v FROM measured),
sketched AS (
  SELECT r, lang, source, x.m AS m, ((x.v >> greatest(length(bin(x.v)) - 5, 0)) << greatest(length(bin(x.v)) - 5, 0)) AS b
  FROM (SELECT r, lang, source, unnest(v) AS x FROM shares)),"""
    + _limits("by_source", "lang, source")
    + ","
    + _limits("by_lang", "lang")
    + ","
    + _limits("overall", "")
    + """,
judged AS (
  SELECT m.*, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    v[1].v <= """
    + _drawn("symbols")
    + " AND v[2].v <= "
    + _drawn("dup_lines")
    + " AND v[3].v <= "
    + _drawn("repeats")
    + " AND v[4].v <= "
    + _drawn("longest")
    + " AND v[4].v >= "
    + _drawn("shortest")
    + """ AS usual
  FROM shares m
  LEFT JOIN by_source a ON m.lang IS NOT DISTINCT FROM a.lang AND m.source IS NOT DISTINCT FROM a.source
  LEFT JOIN by_lang b ON m.lang IS NOT DISTINCT FROM b.lang
  CROSS JOIN overall c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND usual AS kept
FROM judged"""
)


WARC = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
largest AS (SELECT b, max(page_id) AS m FROM p WHERE octet_length(b) >= 1000 GROUP BY b)
SELECT page_id, octet_length(p.b)::BIGINT AS payload_bytes, sha1(p.b) AS payload_digest,
  CASE WHEN m <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN m <> page_id THEN m END AS refers_to
FROM p LEFT JOIN largest ON p.b = largest.b"""


# All lines of all documents, without the operator's choice of candidates.
_TERM = "[a-z0-9]+(?:[.][0-9]+)*"
LICENCES = f"""
WITH templates(licence, t) AS (VALUES {", ".join(f"('{k}', '{v}')" for k, v in TEMPLATES.items())}),
tc AS (
  SELECT licence, term, count(*) AS n
  FROM (SELECT licence, unnest(regexp_extract_all(lower(t), '{_TERM}')) AS term FROM templates) GROUP BY ALL),
idf AS (SELECT term, ln((1 + {len(TEMPLATES)}) / (1 + count(*))) + 1 AS idf FROM tc GROUP BY term),
tw AS (SELECT licence, term, n * idf AS w, sqrt(sum((n * idf) ** 2) OVER (PARTITION BY licence)) AS size
  FROM tc JOIN idf USING (term)),
docs AS (
  SELECT doc_id, text, source, length(abs(doc_id)::VARCHAR) AS k, coalesce(source, 'none') || '/' || array_to_string(
    [substr(abs(doc_id)::VARCHAR, 1, i) for i in range(1, length(abs(doc_id)::VARCHAR) + 1)], '/') AS path
  FROM documents),
lines AS (SELECT DISTINCT path, unnest(string_split(text, chr(10))) AS line FROM docs),
lc AS (
  SELECT path, line, term, count(*) AS n
  FROM (SELECT path, line, unnest(regexp_extract_all(lower(line), '{_TERM}')) AS term FROM lines) GROUP BY ALL),
lw AS (
  SELECT path, line, term, n * coalesce(idf, ln(1 + {len(TEMPLATES)}) + 1) AS w
  FROM lc LEFT JOIN idf USING (term)),
ln AS (SELECT path, line, sqrt(sum(w * w)) AS size FROM lw GROUP BY path, line),
near AS (
  SELECT path, licence, round(sum(lw.w / ln.size * tw.w / tw.size), 6) AS similarity
  FROM lw JOIN ln USING (path, line) JOIN tw USING (term) GROUP BY path, line, licence),
own AS (
  SELECT path, licence, similarity FROM near WHERE similarity >= 0.6
  QUALIFY row_number() OVER (PARTITION BY path ORDER BY similarity DESC, licence) = 1),
declared AS (
  SELECT regexp_replace(path, '/?[^/]*$', '') AS directory, path AS declared_by, licence, similarity FROM own
  QUALIFY row_number() OVER (
    PARTITION BY regexp_replace(path, '/?[^/]*$', '') ORDER BY similarity DESC, path) = 1),
heirs AS (
  SELECT h.home, d.* FROM (SELECT DISTINCT regexp_replace(path, '/?[^/]*$', '') AS home FROM docs) h
  JOIN declared d ON starts_with(h.home || '/', d.directory || '/')
  QUALIFY row_number() OVER (PARTITION BY h.home ORDER BY length(d.directory) DESC) = 1)
SELECT doc_id, coalesce(o.licence, h.licence) AS licence, coalesce(o.similarity, h.similarity) AS similarity,
  string_split(CASE WHEN o.path IS NOT NULL THEN o.path ELSE h.declared_by END, '/')[-1]::BIGINT AS declared_by,
  o.path IS NULL AND h.home IS NOT NULL AS inherited
FROM docs d LEFT JOIN own o ON d.path = o.path
LEFT JOIN heirs h ON regexp_replace(d.path, '/?[^/]*$', '') = h.home"""

# The search is approximate; at this size it finds all of the nearest.
NEAREST = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 20"""


def _crc32(text: str) -> str:
    """Bit by bit: a byte is mixed in, then eight shifts."""
    step = "CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"
    return (
        f"xor(4294967295, list_reduce(flatten([[4294967295::BIGINT]] || [[ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] "
        f"for ch in string_split({text}, '')]), lambda a, x: {step}))"
    )


# Every prefix of every conversation, and each node handed to all nodes above it.
TRIE = f"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, c - c % 5 AS base, {_crc32("c::VARCHAR")} % 9 AS h FROM (SELECT DISTINCT c FROM t)),
rebuilt AS (
  SELECT convs.c, 0 AS part, p, role, text FROM convs JOIN t ON t.c = base AND p <= h
  UNION ALL SELECT t.c, 1, p, role, text FROM t JOIN convs ON t.c = convs.c AND p > h),
lists AS (
  SELECT convs.c, coalesce(list(sha256(length(role) || ':' || role || text) ORDER BY part, p) FILTER (role IS NOT NULL), []) AS l,
    coalesce(list(strlen(text) ORDER BY part, p) FILTER (role IS NOT NULL), []) AS b
  FROM convs LEFT JOIN rebuilt ON rebuilt.c = convs.c GROUP BY convs.c),
members AS (SELECT c, len(l) AS n, d, l[1:d] AS k, coalesce(b[d], 0) AS bytes FROM (SELECT *, unnest(range(0, len(l) + 1)) AS d FROM lists)),
nodes AS (
  SELECT k, d AS depth, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS saved,
    max(n) = d AS leaf, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d), '')) AS ends_sha256
  FROM members GROUP BY k, d),
sums AS (
  SELECT k, count(*) FILTER (leaf) AS n_leaves, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (depth = a + 1) AS n_children
  FROM (SELECT k[1:a] AS k, a, depth, leaf, saved FROM (SELECT *, unnest(range(0, depth + 1)) AS a FROM nodes)) GROUP BY k)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n_children, n_leaves, saved_tokens, n.ends_sha256
FROM nodes n JOIN sums USING (k) LEFT JOIN nodes p ON n.depth > 0 AND p.k = n.k[1:n.depth - 1]"""


# A row's edits with up to two inserts in front, and the least (cost, letters) for each state.
REPAIR = rf"""
WITH RECURSIVE drawn AS (
  SELECT coalesce(conv_id::VARCHAR, ' ') AS c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS w
  FROM conversations),
damaged AS (
  SELECT c, turn, CASE WHEN w = 4 THEN 'user' ELSE role END AS role,
    CASE w WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text), copy) AS i
  FROM (SELECT *, unnest(CASE WHEN w = 3 THEN [0, 1] ELSE [0] END) AS copy FROM drawn WHERE w <> 0)),
rows AS (
  SELECT *, left(role, 1) AS initial,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated'
      ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) AS former
  FROM damaged),
due(q, q2, said) AS (VALUES (0, 2, 'user:'), (1, 2, 'user:'), (2, 3, 'assistant:'), (3, 2, 'user:')),
fronts AS (
  SELECT q, q AS q2, 0 AS cost, '' AS letters, []::VARCHAR[] AS said FROM due
  UNION ALL SELECT q, q2, 5, 'I', [said] FROM due
  UNION ALL SELECT a.q, b.q2, 10, 'II', [a.said, b.said] FROM due a JOIN due b ON a.q2 = b.q),
keeps(q, initial, q2) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
options AS (
  SELECT c, i, f.q, f.q2, f.cost + 2 AS cost, f.letters || 'D' AS letters, f.said FROM rows, fronts f
  UNION ALL
  SELECT c, i, f.q, k.q2, f.cost + CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END, f.letters || 'K', f.said || [role || ':' || text]
  FROM rows JOIN keeps k USING (initial) JOIN fronts f ON f.q2 = k.q WHERE fault NOT IN ('blank', 'duplicate')
  UNION ALL
  SELECT c, i, f.q, d.q2, f.cost + 1 + CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END, f.letters || 'R', f.said || [d.said || text]
  FROM rows, fronts f JOIN due d ON f.q2 = d.q WHERE fault NOT IN ('blank', 'duplicate')),
best AS (
  SELECT c, 0::BIGINT AS i, 0 AS q, {{'cost': 0, 'letters': '', 'said': []::VARCHAR[]}} AS b FROM (SELECT DISTINCT c FROM rows)
  UNION ALL
  SELECT c, o.i, o.q2, min({{'cost': b.cost + o.cost, 'letters': b.letters || o.letters, 'said': b.said || o.said}})
  FROM best JOIN options o USING (c) WHERE o.i = best.i + 1 AND o.q = best.q GROUP BY c, o.i, o.q2),
repaired AS (
  SELECT c, min({{'cost': b.cost + f.cost, 'letters': b.letters || f.letters, 'said': b.said || f.said}}) AS b
  FROM best JOIN fronts f ON f.q = best.q AND f.q2 IN (0, 3)
  WHERE best.i = (SELECT max(i) FROM rows r WHERE r.c = best.c) GROUP BY c),
counted AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (former IS NOT NULL AND former || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows GROUP BY c)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.cost, 0)::BIGINT AS cost,
  coalesce(b.letters, '') AS audit, sha256(coalesce(array_to_string(b.said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(conv_id::VARCHAR, ' ') AS c FROM conversations)
LEFT JOIN counted USING (c) LEFT JOIN repaired USING (c)"""


# Rows of one id are one document; rows without an id are another one, smaller than all.
LINES = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (
  SELECT r, doc_id, i, l[i] AS line,
    translate(regexp_replace(l[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT r, doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM d)),
common AS (
  SELECT k, max(doc_id) AS keeper FROM (SELECT DISTINCT k, doc_id FROM lines WHERE length(k) >= 20)
  GROUP BY k HAVING count(*) >= 3)
SELECT doc_id, n_lines, n_dropped, sha256(coalesce(kept, '')) AS kept_sha256 FROM (
  SELECT r, any_value(doc_id) AS doc_id, count(*) AS n_lines,
    count(*) FILTER (c.k IS NOT NULL AND doc_id IS DISTINCT FROM keeper) AS n_dropped,
    string_agg(line, chr(10) ORDER BY i) FILTER (c.k IS NULL OR doc_id IS NOT DISTINCT FROM keeper) AS kept
  FROM lines LEFT JOIN common c ON lines.k = c.k GROUP BY r)"""


def statements() -> dict[str, str]:
    return {"op1_secret_scan": SECRETS, "op3_nearest": NEAREST, "op4_licences": LICENCES, "op5_quality_rules": QUALITY, "op7_warc": WARC, "op11_prefix_trie": TRIE, "op12_conversation_repair": REPAIR, "op13_line_dedup": LINES}
