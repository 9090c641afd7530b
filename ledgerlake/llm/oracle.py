"""SQL over the given tables, column for column what the registered queries return.

Token files, language identification, page extraction and language-model scores can't be
expressed in SQL; brute-force versions, exact round trips and held-out rows test them.
"""

from __future__ import annotations

import functools

from ledgerlake.llm import licences

ORACLE: dict[str, str] = {}

ORACLE["op2_decontamination"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
i AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, m, array_to_string(w[p:p + m - 1], ' ') AS win
  FROM (SELECT item_id, w, least(13, len(w)) AS m, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS p
        FROM i WHERE len(w) > 0)),
dw AS (
  SELECT r, m, p, array_to_string(w[p:p + m - 1], ' ') AS win
  FROM (SELECT r, w, m, unnest(range(1, greatest(len(w) - m + 2, 1))) AS p
        FROM d CROSS JOIN (SELECT DISTINCT m FROM iw))),
h AS (SELECT r, dw.m, p, item_id FROM dw JOIN iw ON dw.m = iw.m AND dw.win = iw.win),
hit AS (SELECT r, count(DISTINCT q) AS n_hit
        FROM (SELECT r, unnest(range(p, p + m)) AS q FROM h) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
        FROM (SELECT DISTINCT r, coalesce(CAST(item_id AS VARCHAR), '') AS x FROM h) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)
"""

ORACLE["op6_source_mix"] = r"""
WITH d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN 'z' ELSE 's' || source END AS k,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         (CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13)) AS BIGINT) + 0.5::DOUBLE)
           / 4503599627370496::DOUBLE AS u
  FROM documents),
s AS (
  SELECT k, CAST(sum(size) AS DOUBLE) AS s, [3, 1, 2][1 + (row_number() OVER (ORDER BY k) - 1) % 3] AS w
  FROM d GROUP BY k),
f AS (
  SELECT *, 2 * s / w AS full_at,
         (sum(s) OVER () * 3 / 2 - coalesce(sum(2 * s) OVER o, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER o, 0)) AS lev
  FROM s WINDOW o AS (ORDER BY 2 * s / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT k, s, least(2 * s, w * (SELECT arg_min(lev, (full_at, k)) FROM f WHERE lev * w <= 2 * s)) AS target
  FROM f),
p AS (
  SELECT *, CASE WHEN s > 0 THEN floor(target / s) ELSE 0 END AS whole,
         CASE WHEN s > 0 THEN target / s - floor(target / s) ELSE 0 END AS rest FROM t),
v AS (
  SELECT d.*, s, target, whole, target - whole * s AS wanted,
         (u / (1 - u)) / (least(1 - 1e-9, greatest(1e-9, rest)) / (1 - least(1 - 1e-9, greatest(1e-9, rest)))) AS q
  FROM d JOIN p USING (k)),
g AS (
  SELECT k, q, sum(size) AS n, sum(sum(size)) OVER (PARTITION BY k ORDER BY q) - sum(size) AS ahead
  FROM v GROUP BY k, q)
SELECT doc_id, size, CAST(s AS BIGINT) AS source_size, target,
       CAST(size * (whole + CASE WHEN 2 * ahead + n <= 2 * wanted THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM v JOIN g USING (k, q)
"""

ORACLE["op10_exact_top_k"] = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
WHERE rank <= 5
"""

ORACLE["op7_jaccard_join"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') || ' ' || least(len(w), 5) AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id
      GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT doc_id AS x, doc_id AS root FROM d UNION SELECT e.b, root FROM reach JOIN e ON e.a = reach.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(root) AS component_id
FROM d JOIN reach ON reach.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY 1, 2
"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


# Licences in SQL: texts are lists of words, paragraphs lists of such lists. Only the known texts and
# the table of spellings are the operator's.
ORACLE["op9_licence_scan"] = r"""
WITH known AS (SELECT row_number() OVER () AS kid, licence_id, t FROM (VALUES @known) AS v(licence_id, t)),
texts AS (
  SELECT 'k' AS side, kid AS r, NULL AS doc_id, licence_id, t FROM known
  UNION ALL SELECT 'd', row_number() OVER (), doc_id, NULL, text FROM documents),
bare AS (
  SELECT side, r, doc_id, licence_id,
    list_transform(string_split(lower(t), chr(10)), lambda l:
      CASE WHEN regexp_matches(l, '^[ \x09#*;%/<!-]*(©|\(c\)|all rights reserved)')
             OR (regexp_matches(l, '^[ \x09#*;%/<!-]*copyright\b') AND regexp_matches(l, 'copyright\b.*(\(c\)|©|\b[12][0-9]{3}\b)'))
           THEN '' ELSE trim(regexp_replace(l, '[^\p{L}\p{N}]+', ' ', 'g')) END) AS ls
  FROM texts WHERE t IS NOT NULL),
joined AS (
  SELECT side, r, doc_id, licence_id,
    trim(regexp_replace(array_to_string(ls, chr(10)), '\n{3,}', chr(10) || chr(10), 'g'), ' ' || chr(10)) AS t FROM bare),
parts AS (
  SELECT side, r, doc_id, licence_id, t, string_split(t, chr(10) || chr(10)) AS ps FROM joined WHERE t <> ''),
long AS (SELECT max(len(ps)) + 2 AS m FROM parts WHERE side = 'k'),
units AS (
  SELECT side, r, doc_id, licence_id, t, t AS part FROM parts
  UNION SELECT side, r, doc_id, licence_id, t, unnest(regexp_split_to_array(t, '\n+')) FROM parts WHERE side = 'd'
  UNION SELECT side, r, doc_id, licence_id, t, array_to_string(ps[i:i + n - 1], chr(10) || chr(10)) FROM (
    SELECT *, unnest(range(1, least(m, len(ps) - i + 1) + 1)) AS n FROM (
      SELECT *, unnest(range(1, len(ps) + 1)) AS i FROM parts, long WHERE side = 'd'))),
forms AS (
  SELECT *, @form AS form FROM (SELECT *, ' ' || replace(replace(part, chr(10), ' '), ' ', '  ') || ' ' AS p FROM units))
SELECT d.doc_id, k.licence_id, bool_or(d.part = d.t) AS whole, count(*) AS n_texts
FROM forms d JOIN (SELECT DISTINCT licence_id, form FROM forms WHERE side = 'k' AND form <> '') k ON d.form = k.form
WHERE d.side = 'd' GROUP BY d.doc_id, k.licence_id
""".replace("@known", ", ".join(f"({_text(name)}, {_text(t)})" for name, texts in licences.KNOWN.items() for t in texts)).replace("@form", functools.reduce(
        lambda form, pair: "replace({}, ' {} ', ' {} ')".format(form, *(x.replace(" ", "  ") for x in pair)),
        licences.SPELLINGS, "p").join(("trim(regexp_replace(", ", ' +', ' ', 'g'))")))

ORACLE["op12_hard_negatives"] = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         CAST(coalesce(list_sum(list_transform(list_zip(a.e, b.e), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score
  FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

ORACLE["op13_phrases"] = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
o AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3)) AS sizes(k)),
f AS (SELECT lang, k, w[i:i + k - 1] AS gram, count(*) AS f FROM o GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
longer AS (
  SELECT lang, part, max(f) AS f
  FROM (SELECT lang, f, unnest([gram[1:2], gram[2:3]]) AS part FROM f WHERE k = 3 AND f >= 10) GROUP BY ALL),
c AS (
  SELECT f.* FROM f LEFT JOIN longer ON longer.lang = f.lang AND longer.part = f.gram
  WHERE f.k >= 2 AND f.f >= 10 AND (longer.f IS NULL OR 100 * longer.f < 50 * f.f)),
cuts AS (
  SELECT c.lang, c.gram, c.f AS a, cut, x.f AS l, y.f AS r,
         CAST((CAST(1000000 AS HUGEINT) * c.f * c.f) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM c JOIN (VALUES (1), (2)) AS t(cut) ON cut < c.k
  JOIN f x ON x.lang = c.lang AND x.gram = c.gram[1:cut] JOIN f y ON y.lang = c.lang AND y.gram = c.gram[cut + 1:]),
worst AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(gram, ' ')) AS rank,
       array_to_string(gram, ' ') AS phrase, a, l, r, n.n, score
FROM worst JOIN n USING (lang)
QUALIFY rank <= 2000
"""
