"""DuckDB twins of the registered queries that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

# One row per document with the base counts, then both distances against the language's references.
OP4 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS text, row_number() OVER () AS rid FROM documents),
wordlist AS (SELECT rid, doc_id, lang, text, {_WORDS} AS ws FROM d),
wins AS (SELECT rid, i, ws[i] AS a, ws[i+1] AS b, ws[i+2] AS c
         FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM wordlist)),
again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM wins) WHERE n > 1),
covered AS (SELECT rid, count(DISTINCT i + o) AS n FROM again, (VALUES (0), (1), (2)) AS t(o) GROUP BY rid),
linelist AS (SELECT rid, unnest(string_split(text, chr(10))) AS l FROM d),
dups AS (SELECT rid, count(l) - count(DISTINCT l) AS n FROM linelist
         WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY rid),
s AS (
  SELECT w.rid, w.doc_id, w.lang, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    coalesce(dups.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
    length(text) AS chars,
    length(regexp_replace(text, '\P{{Lu}}+', '', 'g')) AS c_upper,
    length(regexp_replace(text, '\P{{L}}+', '', 'g')) AS letters,
    length(regexp_replace(text, '\P{{N}}+', '', 'g')) AS c_digit
  FROM wordlist w LEFT JOIN dups USING (rid) LEFT JOIN covered USING (rid)),
k AS (
  SELECT *, letters - c_upper AS c_letter, n_symbols AS c_symbol,
    word_chars - letters - c_digit - n_symbols AS c_punct, chars - word_chars AS c_space FROM s),
long AS (UNPIVOT (SELECT rid, lang, chars, c_upper, c_letter, c_digit, c_symbol, c_punct, c_space FROM k)
         ON c_upper, c_letter, c_digit, c_symbol, c_punct, c_space INTO NAME cls VALUE c),
ref AS (SELECT lang, cls, sum(c) / sum(sum(c)) OVER (PARTITION BY lang) AS q FROM long GROUP BY lang, cls),
pq AS (SELECT rid, CAST(c AS DOUBLE) / nullif(chars, 0) AS p, q FROM long JOIN ref USING (lang, cls)),
cd AS (SELECT rid, sqrt(sum(CASE WHEN p > 0 THEN p / 2 * log2(2 * p / (p + q)) ELSE 0 END
                          + CASE WHEN q > 0 THEN q / 2 * log2(2 * q / (p + q)) ELSE 0 END)) AS char_distance
       FROM pq GROUP BY rid),
lw AS (SELECT rid, lang, unnest(regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+')) AS w FROM d),
wc AS (SELECT lang, w, count(*) AS c FROM lw GROUP BY lang, w),
wr AS (SELECT lang, w, c / total AS q FROM (
         SELECT *, rank() OVER (PARTITION BY lang ORDER BY c DESC) AS r, sum(c) OVER (PARTITION BY lang) AS total
         FROM wc) WHERE r <= 32),
dw AS (SELECT rid, lang, w, count(*) AS c FROM lw GROUP BY rid, lang, w),
classes AS (
  SELECT k.rid, coalesce(dw.c, 0) / k.n_words AS p, wr.q FROM k JOIN wr USING (lang)
    LEFT JOIN dw ON dw.rid = k.rid AND dw.w = wr.w WHERE k.n_words > 0
  UNION ALL
  SELECT k.rid, 1 - coalesce(h.p, 0), 1 - r.q FROM k JOIN (SELECT lang, sum(q) AS q FROM wr GROUP BY lang) r USING (lang)
    LEFT JOIN (SELECT dw.rid, sum(dw.c / k.n_words) AS p FROM dw JOIN wr ON wr.lang = dw.lang AND wr.w = dw.w
               JOIN k ON k.rid = dw.rid GROUP BY dw.rid) h ON h.rid = k.rid
  WHERE k.n_words > 0),
wd AS (SELECT rid, sqrt(greatest(0, sum(CASE WHEN p > 1e-12 THEN p / 2 * log2(2 * p / (p + q)) ELSE 0 END
                                      + CASE WHEN q > 1e-12 THEN q / 2 * log2(2 * q / (p + q)) ELSE 0 END))) AS word_distance
       FROM classes GROUP BY rid)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
    AND NOT (chars >= 300 AND coalesce(char_distance, 0) > 0.25)
    AND NOT (n_words >= 100 AND coalesce(word_distance, 0) > 0.42) AS kept
FROM k LEFT JOIN cd USING (rid) LEFT JOIN wd USING (rid)
"""

_AZ, _az = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP9 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS rid FROM documents),
l AS (
  SELECT rid, pos, parts[pos] AS line,
    translate(trim(parts[pos], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_AZ}', '{_az}') AS k
  FROM (SELECT rid, parts, unnest(range(1, len(parts) + 1)) AS pos
        FROM (SELECT rid, string_split(text, chr(10)) AS parts FROM d))),
bad AS (SELECT k FROM l WHERE k <> '' GROUP BY k HAVING count(DISTINCT rid) >= 10)
SELECT any_value(d.doc_id) AS doc_id, count(*) AS n_lines,
  count(*) FILTER (WHERE l.k IN (SELECT k FROM bad)) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE l.k NOT IN (SELECT k FROM bad)), ''))
    AS kept_sha256
FROM l JOIN d USING (rid) GROUP BY rid
"""

# Sets of 4-word shingles, links by exact overlap, components by reachability.
OP7 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_AZ}', '{_az}'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i+3], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, least(len(ws), 1)) + 1)) AS i FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id
           GROUP BY a.doc_id, b.doc_id),
link AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
         WHERE 100 * c >= 85 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON l.a = r.b)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(min(reach.b), w.doc_id)) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN reach ON reach.a = w.doc_id
GROUP BY w.doc_id, n.n
"""

# All pairs of a label by cosine in doubles.
OP1 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
u AS (SELECT vec_id, label, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v
      WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id
           AND a.norm > 0 AND b.norm > 0 AND len(a.e) = len(b.e)
         WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.98),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
n AS (SELECT a, count(*) AS n FROM link GROUP BY a),
c AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, least(v.vec_id, coalesce(c.b, v.vec_id)) AS component_id,
  least(v.vec_id, coalesce(c.b, v.vec_id)) = v.vec_id AS kept
FROM v LEFT JOIN n ON n.a = v.vec_id LEFT JOIN c ON c.a = v.vec_id
"""

# The list and captures of the query, and for each capture the best entry in force by a correlated choice.
OP5 = r"""
WITH p AS (SELECT page_id, url, DATE '2024-01-01' + CAST(page_id % 366 AS INTEGER) AS fetched_on,
             regexp_replace(regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.\-]*://([^/?#]*)', 1),
                            '^.*@', ''), '\.?(:[0-9]*)?$', '') AS host,
             regexp_extract(lower(url), '^[a-z][a-z0-9+.\-]*://[^/?#]*([^?#]*)', 1) AS path0 FROM pages),
c AS (SELECT page_id, url, fetched_on, host, CASE WHEN path0 = '' THEN '/' ELSE path0 END AS path FROM p),
h AS (SELECT host, min(page_id) AS m FROM c WHERE host <> '' GROUP BY host),
e AS (SELECT 'host' AS kind, host AS pattern, 'block' AS action, m % 200 AS d FROM h WHERE m % 3 = 0
      UNION ALL SELECT 'host', host, 'remove', m % 200 + 90 FROM h WHERE m % 3 = 0
      UNION ALL SELECT 'domain', regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1), 'block', m % 300 FROM h WHERE m % 5 = 0
      UNION ALL SELECT 'prefix', host || '/en/', 'allow', m % 250 FROM h WHERE m % 2 = 0),
one AS (SELECT kind, pattern, DATE '2024-01-01' + CAST(d AS INTEGER) AS valid_from,
          max(CASE action WHEN 'allow' THEN 3 WHEN 'block' THEN 2 ELSE 1 END) AS a
        FROM e WHERE pattern <> '' GROUP BY ALL),
i AS (SELECT *, lead(valid_from) OVER (PARTITION BY kind, pattern ORDER BY valid_from) AS valid_to FROM one),
m AS (SELECT c.page_id, i.kind, i.pattern, i.valid_from, i.a,
        row_number() OVER (PARTITION BY c.page_id ORDER BY CASE i.kind WHEN 'prefix' THEN 3 WHEN 'host' THEN 2 ELSE 1 END
                           DESC, length(i.pattern) DESC, i.pattern DESC) AS r
      FROM c JOIN i ON i.a > 1 AND c.fetched_on >= i.valid_from AND (i.valid_to IS NULL OR c.fetched_on < i.valid_to)
       AND CASE i.kind WHEN 'host' THEN c.host = i.pattern
                       WHEN 'domain' THEN c.host = i.pattern OR ends_with(c.host, '.' || i.pattern)
                       ELSE starts_with(c.host || c.path, i.pattern) END)
SELECT c.page_id, c.url, CAST(c.fetched_on AS VARCHAR) AS fetched_on, coalesce(m.a = 2, false) AS blocked, m.kind,
  m.pattern, CAST(m.valid_from AS VARCHAR) AS valid_from
FROM c LEFT JOIN m ON m.page_id = c.page_id AND m.r = 1
"""

# crc32 as SQL: its table by rule, then a text's bytes (ASCII here) one after the other.
_CRC_TABLE = """(SELECT list_transform(range(0, 256), lambda i: list_reduce(range(0, 8),
  lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i)) AS tab)"""


def _crc32(text: str) -> str:
    return (f"xor(list_reduce(list_transform(string_split({text}, ''), lambda c: ord(c)::BIGINT), "
            "lambda a, b: xor(a >> 8, tab[1 + (xor(a, b) & 255)]), 4294967295::BIGINT), 4294967295)")


# Every prefix of every rebuilt conversation; a node's subtree by its smallest member's ancestors.
OP12 = rf"""
WITH t AS (
  SELECT conv_id, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list({{'k': k, 'w': w}} ORDER BY turn NULLS FIRST, k) AS ts FROM t GROUP BY conv_id),
h AS (SELECT conv_id, ts, {_crc32("conv_id::VARCHAR")} % 4 AS h FROM c, {_CRC_TABLE}),
r AS (SELECT h.conv_id, list_concat(coalesce(b.ts, [])[1:h], h.ts[h + 1:]) AS ts
      FROM h LEFT JOIN c b ON b.conv_id = h.conv_id - h.conv_id % 20),
p AS (SELECT conv_id, d, len(ts) AS n, array_to_string(list_transform(ts[1:d], lambda x: x.k), '') AS path,
        array_to_string(list_transform(ts[1:d - 1], lambda x: x.k), '') AS up,
        CASE WHEN d > 0 THEN ts[d].w ELSE 0 END AS w
      FROM (SELECT *, unnest(range(0, len(ts) + 1)) AS d FROM r)),
n AS (SELECT path, d, min(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, max(w) AS w,
        coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = d), '') AS ends
      FROM p GROUP BY path, d),
kids AS (SELECT up, count(*) AS n FROM n WHERE d > 0 GROUP BY up),
under AS (SELECT p.path, sum((n.n_convs - 1) * n.w) AS saved, count(*) FILTER (WHERE kids.n IS NULL) AS leaves
          FROM n JOIN p ON p.conv_id = n.conv_id AND p.d <= n.d LEFT JOIN kids ON kids.up = n.path GROUP BY p.path)
SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n, 0) AS n_children,
  under.leaves AS n_leaves, CAST(under.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM n JOIN under USING (path) LEFT JOIN kids ON kids.up = n.path
  LEFT JOIN n u ON n.d > 0 AND u.path = n.up
"""

# Damage, faults, then the least (cost, audit) of every state row by row; a state's value is the
# cost in nine digits before the audit, so that the least text is the cheapest, ASCII-least audit.
_FAR9 = "'900000000'"
_EXTRA = "(CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END)"


def _dearer(value: str, price: str, edit: str) -> str:
    return f"(lpad(CAST(CAST(left({value}, 9) AS INTEGER) + {price} AS VARCHAR), 9, '0') || substr({value}, 10) || '{edit}')"


def _inserted(n: str, s: str, u: str, a: str) -> str:
    """The four states' values after rows may have been inserted."""
    user = f"least({u}, {_dearer(n, '3', 'I')}, {_dearer(s, '3', 'I')}, {_dearer(a, '3', 'I')})"
    return f"SELECT * EXCLUDE (n, s, u, a), {n} AS n, {s} AS s, {user} AS u, least({a}, {_dearer(user, '3', 'I')}) AS a"


def _read(state: str, kept: str, reroled: str) -> str:
    """Value of a state behind a row: the row is deleted, kept or given another role."""
    return f"least({_dearer(state, '4', 'D')}, CASE WHEN stays AND {kept} END, CASE WHEN stays THEN {reroled} END)"


def _keep(initial: str, *states: str) -> str:
    least = ", ".join(_dearer(x, _EXTRA, "K") for x in states)
    return f"initial = '{initial}' THEN least({least})"


def _rerole(*states: str) -> str:
    return "least(" + ", ".join(_dearer(x, f"3 + {_EXTRA}", "R") for x in states) + ")"


OP13 = rf"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS kind
  FROM conversations, {_CRC_TABLE}),
d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(range(0, CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
      FROM k),
o AS (SELECT conv_id, turn, role, text, left(role, 1) AS initial,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text), copy) AS i,
        regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last
      FROM d),
f AS (SELECT *, CASE WHEN last = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1
                  THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
        lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before,
        count(*) OVER (PARTITION BY conv_id) AS rows_in_all
      FROM o),
g AS (SELECT *, fault NOT IN ('blank', 'duplicate') AS stays FROM f),
path AS (
  {_inserted("n", "s", "u", "a")}
  FROM (SELECT conv_id, 0 AS i, '000000000' AS n, {_FAR9} AS s, {_FAR9} AS u, {_FAR9} AS a
        FROM conversations GROUP BY conv_id)
  UNION ALL
  {_inserted("n", "s", "u", "a")}
  FROM (SELECT path.conv_id, g.i,
          {_dearer("n", "4", "D")} AS n,
          least({_dearer("s", "4", "D")}, CASE WHEN stays AND {_keep("s", "n")} END) AS s,
          {_read("u", _keep("u", "n", "s", "a"), _rerole("n", "s", "a"))} AS u,
          {_read("a", _keep("a", "u"), _rerole("u"))} AS a
        FROM path JOIN g ON g.conv_id IS NOT DISTINCT FROM path.conv_id AND g.i = path.i + 1)),
done AS (SELECT conv_id, i, least(n, a) AS best FROM path
         QUALIFY i = max(i) OVER (PARTITION BY conv_id)),
e AS (SELECT conv_id, CAST(left(best, 9) AS BIGINT) AS cost, substr(best, 10) AS audit FROM done),
steps AS (SELECT conv_id, audit, p, audit[p] AS edit,
            p - len(replace(audit[1:p], 'I', '')) AS skipped
          FROM (SELECT *, unnest(range(1, len(audit) + 1)) AS p FROM e)),
lines AS (SELECT steps.conv_id, p, edit, g.role, g.text, g.initial,
            row_number() OVER (PARTITION BY steps.conv_id ORDER BY p) AS pos,
            max(CASE WHEN edit = 'K' AND g.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY steps.conv_id) AS with_s
          FROM steps LEFT JOIN g ON edit <> 'I' AND g.conv_id IS NOT DISTINCT FROM steps.conv_id AND g.i = p - skipped
          WHERE edit <> 'D'),
text AS (SELECT conv_id, string_agg(CASE edit WHEN 'K' THEN role
             ELSE CASE WHEN (pos - with_s) % 2 = 1 THEN 'user' ELSE 'assistant' END END || ':'
             || CASE edit WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS t
         FROM lines GROUP BY conv_id),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
             count(*) FILTER (WHERE fault = 'truncated') AS truncated,
             count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
           FROM g GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost, audit,
  sha256(coalesce(text.t, '')) AS repaired_sha256
FROM e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
  LEFT JOIN text ON text.conv_id IS NOT DISTINCT FROM e.conv_id
"""

ORACLE_SQL: dict[str, str] = {"op5_url_filters": OP5, "op1_embedding_dedup": OP1, "op7_jaccard_join": OP7, "op4_quality_rules": OP4, "op9_line_dedup": OP9,
                              "op12_conversation_trie": OP12, "op13_conversation_repair": OP13}
