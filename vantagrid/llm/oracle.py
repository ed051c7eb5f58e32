"""DuckDB SQL of the corpus queries that SQL can express, over whole tables."""

from __future__ import annotations


def _located(kind: str, rank: int, pattern: str, keep: str, text: str = "text", source: str = "docs", keys: str = "doc_id") -> str:
    """Matches of a pattern with their places: what lies before them is the pieces between, and the matches so far."""
    quoted = pattern.replace("'", "''")
    return f"""SELECT {keys}, {rank} AS k, '{kind}' AS kind, s, s + length(v) AS e, v FROM (
  SELECT {keys}, m[i] AS v, CAST(list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s
  FROM (SELECT {keys}, m, p, unnest(range(1, len(m) + 1)) AS i FROM (
    SELECT {keys}, regexp_extract_all({text}, '{quoted}') AS m, string_split_regex({text}, '{quoted}') AS p FROM {source}))
) WHERE {keep}"""


_DIGITS = "regexp_replace(v, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(range(0, length({_DIGITS})), lambda j:
  CASE WHEN j % 2 = 1 THEN CAST(substr({_DIGITS}, length({_DIGITS}) - j, 1) AS INT) * 2 - CASE WHEN substr({_DIGITS}, length({_DIGITS}) - j, 1) > '4' THEN 9 ELSE 0 END
  ELSE CAST(substr({_DIGITS}, length({_DIGITS}) - j, 1) AS INT) END)) % 10 = 0"""

_PRIVATE = " UNION ALL ".join(
    [
        _located("email", 0, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
        _located("ip", 1, r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", r"regexp_full_match(v, '(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}')"),
        _located("card", 2, r"[0-9](?:[\x20-]?[0-9])+", f"length({_DIGITS}) BETWEEN 14 AND 19 AND {_LUHN}"),
        _located("phone", 3, r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 10 AND 15"),
    ]
)

_KEYWORD = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
_SECRET = " UNION ALL ".join(
    [
        _located("assign", 0, _KEYWORD + "[A-Za-z0-9+/_.=-]+", "length(regexp_replace(v, '^{}', '')) >= 6".format(_KEYWORD.replace("'", "''"))),
        _located("access", 1, "AKIA[A-Z0-9]+", "length(v) >= 20"),
        _located("hex", 2, "[0-9a-f]+", "length(v) >= 24"),
        _located("pem", 3, "-----BEGIN [A-Z ]*PRIVATE KEY-----", "true"),
        _located("git", 4, "gh[pousr]_[A-Za-z0-9]{36,}", "true"),
        _located("chat", 5, "xox[abprs]-[A-Za-z0-9-]{10,}", "true"),
        _located("jwt", 6, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", "true"),
    ]
)


def _places(text: str, source: str, keys: str) -> str:
    """Words of three letters or more with their places, by running sums: for texts of many words."""
    pattern = r"\p{L}{3,}"
    return f"""SELECT {keys}, v, CAST(q + before AS BIGINT) AS s, CAST(q + before + length(v) AS BIGINT) AS e FROM (
  SELECT {keys}, v, sum(length(p)) OVER (PARTITION BY {keys} ORDER BY i) AS q, coalesce(sum(length(v)) OVER (PARTITION BY {keys} ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM (
    SELECT {keys}, unnest(m) AS v, unnest(p[1:len(m)]) AS p, generate_subscripts(m, 1) AS i FROM (
      SELECT {keys}, regexp_extract_all({text}, '{pattern}') AS m, string_split_regex({text}, '{pattern}') AS p FROM {source})))"""


def _digest(kinds: list[str]) -> str:
    """The contract's columns of a table ``spans`` (doc_id, k, kind, s, e)."""
    shown = "kind || ':' || s || ':' || e"
    base = len(kinds)
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in kinds)
    return f"""SELECT d.doc_id, {counts},
  sha256(coalesce(string_agg({shown}, ',' ORDER BY s, k) FILTER (WHERE k < {base}), '')) AS base_sha256, coalesce(string_agg({shown}, ',' ORDER BY s, k), '') AS spans
FROM documents d LEFT JOIN spans USING (doc_id) GROUP BY d.doc_id"""


#: Words that stand within six words of an entity, on its line; documents with word, entity, and both; share of the
#: entity's information; then every place of such a word, and the text without them.
OP1_SQL = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), base AS ({_PRIVATE}),
ents AS (SELECT *, kind || ':' || CASE WHEN kind IN ('card', 'phone') THEN {_DIGITS} ELSE lower(v) END AS ent FROM base),
lines AS (
  SELECT doc_id, line, ln, CAST(coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY ln ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS off
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS ln FROM docs SEMI JOIN base USING (doc_id))
), words AS ({_places("line", "lines", "doc_id, ln, off, line")}),
apart AS (SELECT doc_id, ln, line, lower(v) AS term, off + s AS s, off + e AS e FROM words w WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = w.doc_id AND b.e > off + w.s AND b.s < off + w.e)),
placed AS (SELECT x.doc_id, ln, k, s, e, ent FROM ents x JOIN lines l ON l.doc_id = x.doc_id AND x.s >= off AND x.s < off + length(line)),
sides AS (
  SELECT p.doc_id, p.ent, a.term, a.line, row_number() OVER (PARTITION BY p.doc_id, p.k, p.s ORDER BY a.s DESC) AS nth FROM placed p JOIN apart a ON a.doc_id = p.doc_id AND a.ln = p.ln AND a.e <= p.s
  UNION ALL
  SELECT p.doc_id, p.ent, a.term, a.line, row_number() OVER (PARTITION BY p.doc_id, p.k, p.s ORDER BY a.s) FROM placed p JOIN apart a ON a.doc_id = p.doc_id AND a.ln = p.ln AND a.s >= p.e
), joint AS (SELECT ent, term, count(DISTINCT doc_id) AS j FROM sides WHERE nth <= 6 GROUP BY ALL HAVING j >= 3 OR count(DISTINCT line) >= 2),
entities AS (SELECT ent, count(DISTINCT doc_id) AS ne FROM ents GROUP BY ent),
held AS (SELECT DISTINCT doc_id, unnest(list_transform(string_split_regex(text, '[^\\p{{L}}]+'), lambda x: lower(x))) AS term FROM docs),
terms AS (SELECT term, count(*) AS nt FROM held GROUP BY 1),
told AS (
  SELECT term, max(share) AS share FROM (
    SELECT term, ln(n * j / (nt * ne)) / ln(n / ne) AS share
    FROM joint JOIN entities USING (ent) JOIN terms USING (term) CROSS JOIN (SELECT CAST(greatest(count(*), 2) AS DOUBLE) AS n FROM docs) WHERE ne < n
  ) WHERE share >= 0.75 GROUP BY term
), texts AS (SELECT doc_id, text FROM docs WHERE doc_id IN (SELECT doc_id FROM held JOIN told USING (term))
), every AS ({_places("text", "texts", "doc_id")}
), extra AS (
  SELECT doc_id, CASE WHEN share >= 0.95 THEN 4 ELSE 5 END AS k, CASE WHEN share >= 0.95 THEN 'remove' ELSE 'general' END AS kind, s, e, v
  FROM every w JOIN told ON lower(v) = term WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = w.doc_id AND b.e > w.s AND b.s < w.e)
), spans AS (SELECT doc_id, k, kind, s, e, v FROM base UNION ALL SELECT doc_id, k, kind, s, e, v FROM extra),
digests AS ({_digest(["email", "ip", "card", "phone"])}),
lists AS (
  SELECT doc_id, list({{'s': CAST(s AS BIGINT), 'e': CAST(e AS BIGINT), 'r': CASE WHEN k < 4 THEN '[' || upper(kind) || ']' WHEN k = 4 THEN '' WHEN regexp_matches(v, '^\\p{{Lu}}') THEN '[Name]' ELSE '[word]' END}} ORDER BY s, k) AS l
  FROM spans GROUP BY doc_id
), cut AS (
  SELECT doc_id, text, list_reduce(l, lambda acc, x: CASE WHEN x.s >= acc.e THEN {{'s': acc.s, 'e': x.e, 'r': acc.r || substr(text, acc.e + 1, x.s - acc.e) || x.r}} ELSE acc END, {{'s': 0::BIGINT, 'e': 0::BIGINT, 'r': ''}}) AS z
  FROM docs JOIN lists USING (doc_id)
)
SELECT digests.* EXCLUDE (spans), sha256(CASE WHEN z IS NULL THEN docs.text ELSE z.r || substr(docs.text, z.e + 1) END) AS clean_sha256, digests.spans
FROM digests JOIN docs USING (doc_id) LEFT JOIN cut USING (doc_id)"""

OP2_SQL = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), spans AS ({_SECRET})
{_digest(["assign", "access", "hex"])}"""

#: All pairs that share a shingle, and all that is reachable over links.
OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents WHERE text IS NOT NULL
), s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM w WHERE len(ws) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT u, v FROM pairs JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 80 * (x.n + y.n - c)
), ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links
), reach AS (
  SELECT DISTINCT u AS a, u AS b FROM ways
  UNION
  SELECT a, v FROM reach JOIN ways ON b = u
), root AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(root.c, d.doc_id) AS component_id, coalesce(root.c, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN root ON a = d.doc_id
"""

#: Targets in whole numbers (twice the budget), so that each is rounded once; scales over distinct sizes; the ranks' running sums.
OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    (CAST(CAST('0x' || substr(md5(concat_ws('|', '7', CAST(doc_id AS VARCHAR), md5(text))), 1, 12) AS BIGINT) AS DOUBLE) + 0.5) / 281474976710656.0 AS u
  FROM documents
), src AS (SELECT source, CAST(sum(size) AS BIGINT) AS n FROM d GROUP BY source
), wt AS (SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1] AS w FROM src
), ordered AS (SELECT *, row_number() OVER (ORDER BY n / CAST(w AS DOUBLE), source IS NULL, source) AS k FROM wt
), levels AS (
  SELECT *, 3 * sum(n) OVER () - 4 * coalesce(sum(n) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS num,
    sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws FROM ordered
), open AS (SELECT k AS k0, num, ws FROM levels WHERE num * w < 4 * n * ws ORDER BY k LIMIT 1
), parts AS (
  SELECT source, n, CASE WHEN k >= k0 THEN open.num * w ELSE 4 * n END AS t, CASE WHEN k >= k0 THEN 2 * open.ws ELSE 2 END AS q
  FROM levels LEFT JOIN open ON true
), targets AS (
  SELECT source, n, CAST(t AS DOUBLE) / CAST(q AS DOUBLE) AS target, CASE WHEN n = 0 THEN 0 ELSE t // (q * n) END AS whole,
    CASE WHEN n = 0 THEN 0.0 ELSE CAST(t - t // (q * n) * q * n AS DOUBLE) / CAST(q AS DOUBLE) END AS rest
  FROM parts
), sizes AS (SELECT source, size, count(*) AS c FROM d WHERE size > 0 GROUP BY source, size
), levels2 AS (
  SELECT z.source, size, rest,
    coalesce(sum(c * size) OVER (PARTITION BY z.source ORDER BY size DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above,
    sum(c * size * size) OVER (PARTITION BY z.source ORDER BY size DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS squares
  FROM sizes z JOIN targets t ON z.source IS NOT DISTINCT FROM t.source WHERE rest > 0
), scaled AS (SELECT source, size, (rest - CAST(above AS DOUBLE)) / CAST(squares AS DOUBLE) AS scale FROM levels2
), scales AS (SELECT source AS s, max(size) AS most, max_by(scale, size) AS scale FROM scaled WHERE scale * size < 1 GROUP BY source
), odds AS (
  SELECT doc_id, d.source, size, u, n, target, whole, rest, most, scale, scale * size AS p
  FROM d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN scales ON d.source IS NOT DISTINCT FROM s
), pareto AS (SELECT *, CASE WHEN p > 0 AND p < 1 THEN (u / (1 - u)) / (p / (1 - p)) END AS o FROM odds
), ranked AS (
  SELECT *, CASE WHEN size = 0 OR rest <= 0 THEN NULL WHEN size > most THEN 0 WHEN p > 0 THEN greatest(CAST(floor(o / (1 + o) * 281474976710656.0) AS BIGINT), 1) END AS rnk FROM pareto
), sums AS (SELECT source, rnk, any_value(rest) AS rest, sum(size) AS words, count(*) AS tied FROM ranked WHERE rnk IS NOT NULL GROUP BY source, rnk
), runs AS (
  SELECT *, sum(words) OVER (PARTITION BY source ORDER BY rnk) AS upto, row_number() OVER (PARTITION BY source ORDER BY rnk DESC) AS last FROM sums
), cuts AS (
  SELECT source, rnk AS cut, least(floor((rest - (upto - words)) * tied / words + 0.5), tied) AS take FROM runs
  WHERE upto - words < rest AND (upto >= rest OR last = 1)
), numbered AS (SELECT *, row_number() OVER (PARTITION BY source, rnk ORDER BY doc_id) AS nth FROM ranked
), taken AS (
  SELECT r.*, CASE WHEN size > 0 THEN CAST(whole AS INT) + CASE WHEN coalesce(rnk < cut OR rnk = cut AND nth <= take, false) THEN 1 ELSE 0 END ELSE 0 END AS copies
  FROM numbered r LEFT JOIN cuts c ON r.source IS NOT DISTINCT FROM c.source
)
SELECT doc_id, size, n AS source_size, target, size * copies AS taken, source, copies FROM taken"""

#: Every window of 100 bytes, as text of two digits a byte; a byte goes if a repeated window began at most 99 before.
OP9_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS s FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS i FROM d WHERE length(h) >= 200)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS nth FROM w) WHERE nth > 1),
p AS (SELECT doc_id, p, substr(h, 2 * p + 1, 2) AS c FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2)) AS p FROM d)),
g AS (SELECT p.doc_id, p, c, coalesce(max(r.i) OVER (PARTITION BY p.doc_id ORDER BY p) >= p - 99, false) AS gone FROM p LEFT JOIN r ON r.doc_id = p.doc_id AND r.i = p.p),
e AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY p), false) AS begins FROM g)
SELECT d.doc_id, CAST(length(any_value(d.h)) // 2 AS BIGINT) AS n_bytes, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE begins) AS n_spans,
  sha256(unhex(coalesce(string_agg(c, '' ORDER BY p) FILTER (WHERE NOT gone), ''))) AS kept_sha256
FROM d LEFT JOIN e USING (doc_id) GROUP BY d.doc_id"""

#: Chunks, and each with the one behind it; equal ones are compared as text, so no key is needed here.
OP10_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents
), hashed AS (
  SELECT *, CAST('0x' || substr(md5(line), 1, 8) AS BIGINT) AS h FROM lines
), cuts AS (
  SELECT *, CASE WHEN h % 2 = 0 OR (lead(h) OVER w // 8) % 2 = 0 THEN 1 ELSE 0 END AS ends
  FROM hashed WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), numbered AS (
  SELECT *, coalesce(sum(ends) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c FROM cuts
), chunks AS (
  SELECT doc_id, c, string_agg(line, chr(10) ORDER BY i) AS chunk, count(*) AS n,
         count(*) FILTER (WHERE regexp_matches(line, '[^ \t\r\f\v]')) AS solid
  FROM numbered GROUP BY doc_id, c
), behind AS (
  SELECT *, lead(chunk) OVER w AS next, lead(solid) OVER w AS next_solid FROM chunks WINDOW w AS (PARTITION BY doc_id ORDER BY c)
), units AS (
  SELECT doc_id, c, 0 AS more, chunk AS unit FROM behind WHERE solid >= 2
  UNION ALL SELECT doc_id, c, 1, chunk || chr(10) || next FROM behind WHERE next IS NOT NULL AND solid + next_solid >= 2
), again AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY doc_id, c) AS nth FROM units) WHERE nth > 1
), gone AS (SELECT DISTINCT doc_id, c + k AS c FROM (SELECT doc_id, c, unnest(range(0, more + 1)) AS k FROM again)
), judged AS (
  SELECT chunks.*, gone.c IS NOT NULL AS gone FROM chunks LEFT JOIN gone USING (doc_id, c)
), kept AS (
  SELECT doc_id, coalesce(string_agg(chunk, chr(10) ORDER BY c) FILTER (WHERE NOT gone), '') AS text,
         count(*) FILTER (WHERE gone) AS nc, coalesce(sum(n) FILTER (WHERE gone), 0) AS nl
  FROM judged GROUP BY doc_id
)
SELECT d.doc_id, sha256(k.text) AS kept_sha256, CAST(length(k.text) AS BIGINT) AS n_chars,
       CAST(coalesce(k.nc, 0) AS BIGINT) AS n_chunks_removed, CAST(coalesce(k.nl, 0) AS BIGINT) AS n_lines_removed
FROM documents d LEFT JOIN kept k USING (doc_id)
"""

ORACLE_SQL: dict[str, str] = {
    "op1_pii": OP1_SQL,
    "op2_secret_scan": OP2_SQL,
    "op5_near_dedup": OP5_SQL,
    "op7_source_mix": OP7_SQL,
    "op9_suffix_dedup": OP9_SQL,
    "op10_line_dedup": OP10_SQL,
}
