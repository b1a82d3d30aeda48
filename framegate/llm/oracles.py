"""DuckDB SQL for the queries that SQL can express."""

WORDS = r"REGEXP_EXTRACT_ALL(COALESCE(text, ''), '[^\x20\x09-\x0D]+')"
LETTERS = r"REGEXP_EXTRACT_ALL(TRANSLATE(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')"

#: Every twentieth document against all of them.
SEARCH = f"""WITH w AS (SELECT doc_id, {LETTERS} AS ws FROM documents),
t AS (SELECT doc_id, term, COUNT(*) AS tf FROM (SELECT doc_id, UNNEST(ws) AS term FROM w) GROUP BY ALL),
s AS (SELECT COUNT(*) AS n, AVG(LEN(ws)) AS mean FROM w),
df AS (SELECT term, LN(1 + ((SELECT n FROM s) - COUNT(*) + 0.5::DOUBLE) / (COUNT(*) + 0.5::DOUBLE)) AS idf FROM t GROUP BY term),
i AS (SELECT t.doc_id, term, idf * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * LEN(ws) / (SELECT mean FROM s))) AS score
  FROM t JOIN df USING (term) JOIN w USING (doc_id)),
r AS (SELECT q.doc_id AS query_id, i.doc_id, SUM(q.tf * i.score) AS score FROM t q JOIN i USING (term) WHERE q.doc_id % 20 = 0 GROUP BY ALL),
k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY ROUND(score, 9) DESC, doc_id) AS rank FROM r)
SELECT query_id, doc_id, ROUND(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM k WHERE rank <= 10"""

REPEATS = f"""WITH w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
p AS (SELECT doc_id, i, ARRAY_TO_STRING(ws[i:i + 19], ' ') AS k FROM (SELECT doc_id, ws, UNNEST(RANGE(1, LEN(ws) - 18)) AS i FROM w)),
f AS (SELECT k, MIN(doc_id * 10000000 + i) AS place FROM p GROUP BY k),
gone AS (SELECT DISTINCT doc_id, UNNEST(RANGE(i, i + 20)) AS j FROM p JOIN f USING (k) WHERE doc_id * 10000000 + i > place),
each AS (SELECT doc_id, UNNEST(RANGE(1, LEN(ws) + 1)) AS j, UNNEST(ws) AS word FROM w),
kept AS (SELECT doc_id, STRING_AGG(word, ' ' ORDER BY j) AS text, COUNT(*) AS n FROM each ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id)
SELECT w.doc_id, LEN(ws) AS n_words, LEN(ws) - COALESCE(n, 0) AS n_removed, SHA256(COALESCE(text, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)"""

DECONTAMINATION = f"""WITH w AS (SELECT doc_id, {LETTERS} AS ws FROM documents),
b AS (SELECT item_id, {LETTERS} AS ws FROM benchmark),
iw AS (SELECT DISTINCT item_id, size, ARRAY_TO_STRING(ws[i:i + size - 1], ' ') AS k
  FROM (SELECT item_id, ws, LEAST(10, LEN(ws)) AS size, UNNEST(RANGE(1, LEN(ws) - LEAST(10, LEN(ws)) + 2)) AS i FROM b WHERE LEN(ws) > 0)),
p AS (SELECT doc_id, size, i, ARRAY_TO_STRING(ws[i:i + size - 1], ' ') AS k
  FROM (SELECT doc_id, ws, size, UNNEST(RANGE(1, LEN(ws) - size + 2)) AS i FROM w, (SELECT DISTINCT size FROM iw))),
m AS (SELECT doc_id, size, i, item_id FROM p JOIN iw USING (size, k)),
h AS (SELECT doc_id, COUNT(DISTINCT j) AS n FROM (SELECT doc_id, UNNEST(RANGE(i, i + size)) AS j FROM m) GROUP BY doc_id),
n AS (SELECT doc_id, COUNT(*) AS n, STRING_AGG(name, ',' ORDER BY name) AS names FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM m) GROUP BY doc_id)
SELECT doc_id, LEN(ws) AS n_words, COALESCE(h.n, 0) AS n_hit, COALESCE(n.n, 0) AS n_items, SHA256(COALESCE(names, '')) AS items_sha256, COALESCE(h.n, 0) > 0 AS contaminated
FROM w LEFT JOIN h USING (doc_id) LEFT JOIN n USING (doc_id)"""


_FIELD = "COALESCE(STRLEN({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
_HEAD = "||".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
_LOWER = "TRANSLATE(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: CRC-32 of a number's decimal digits: a character is xored in, then eight shifts (-1) follow.
_CRC = """XOR(4294967295, LIST_REDUCE(LIST_PREPEND(4294967295, FLATTEN(LIST_TRANSFORM(STRING_SPLIT(doc_id::VARCHAR, ''),
  lambda c: [ASCII(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda c, x: CASE WHEN x >= 0 THEN XOR(c, x) ELSE XOR(c >> 1, 3988292384 * (c & 1)) END))"""

#: Digests of trees of eight, level by level; `step` counts the levels from a row's leaf to the root.
MANIFEST = f"""WITH RECURSIVE l AS (SELECT doc_id, lang, SHA256({_HEAD}||{_FIELD.format("text")}) AS leaf, {_CRC} % 3 = 0 AS hurt,
  SHA256({_HEAD}||{_FIELD.format(_LOWER)}) AS other FROM documents),
p AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS place, COUNT(*) OVER (PARTITION BY lang) AS size FROM l),
n AS (SELECT COALESCE('=' || lang, '-') AS tree, 0 AS height, place, size, leaf AS digest FROM p
  UNION ALL SELECT tree, height + 1, place // 8, (MAX(size) + 7) // 8, SHA256(STRING_AGG(digest, '' ORDER BY place)) FROM n WHERE size > 1 GROUP BY tree, height, place // 8),
t AS (SELECT tree, height AS top, digest AS subroot, ROW_NUMBER() OVER (ORDER BY tree) - 1 AS place, COUNT(*) OVER () AS size FROM n WHERE size = 1),
u AS (SELECT 0 AS height, place, size, subroot AS digest FROM t
  UNION ALL SELECT height + 1, place // 8, (MAX(size) + 7) // 8, SHA256(STRING_AGG(digest, '' ORDER BY place)) FROM u WHERE size > 1 GROUP BY height, place // 8),
d AS (SELECT doc_id, leaf, subroot, CASE WHEN hurt THEN other ELSE leaf END AS own, tree, p.place, top, t.place AS upper FROM p JOIN t ON t.tree = COALESCE('=' || lang, '-')),
s AS (SELECT d.doc_id, n.height AS step, n.place < d.place // POW(8, n.height)::BIGINT AS before, n.place, digest FROM d JOIN n
    ON n.tree = d.tree AND n.place // 8 = d.place // POW(8, n.height + 1)::BIGINT AND n.place <> d.place // POW(8, n.height)::BIGINT AND n.size > 1
  UNION ALL SELECT d.doc_id, top + u.height, u.place < d.upper // POW(8, u.height)::BIGINT, u.place, digest FROM d JOIN u
    ON u.place // 8 = d.upper // POW(8, u.height + 1)::BIGINT AND u.place <> d.upper // POW(8, u.height)::BIGINT AND u.size > 1),
r AS (SELECT doc_id, step, COALESCE(STRING_AGG(digest, '' ORDER BY place) FILTER (before), '') AS lo, COALESCE(STRING_AGG(digest, '' ORDER BY place) FILTER (NOT before), '') AS hi FROM s GROUP BY ALL),
k AS (SELECT doc_id, STRING_AGG(lo || hi, '' ORDER BY step) AS proof FROM r GROUP BY doc_id),
h AS (SELECT (SELECT MAX(height) FROM u) + top AS last, doc_id FROM d),
f AS (SELECT doc_id, 0 AS step, own FROM d UNION ALL SELECT f.doc_id, f.step + 1, SHA256(COALESCE(lo, '') || own || COALESCE(hi, ''))
  FROM f JOIN h ON h.doc_id = f.doc_id LEFT JOIN r ON r.doc_id = f.doc_id AND r.step = f.step WHERE f.step < h.last),
z AS (SELECT f.doc_id, own AS folded_root FROM f JOIN h ON h.doc_id = f.doc_id AND h.last = f.step)
SELECT doc_id, leaf, subroot, (SELECT digest FROM u WHERE size = 1) AS root, SHA256(COALESCE(proof, '')) AS proof_sha256, folded_root,
  folded_root = (SELECT digest FROM u WHERE size = 1) AS verified FROM d LEFT JOIN k USING (doc_id) JOIN z USING (doc_id)"""

#: Pairs that share at least one shingle, by whole sets; then the smallest id in reach.
JACCARD = f"""WITH RECURSIVE w AS (SELECT doc_id, {WORDS.replace("COALESCE(text, '')", _LOWER.replace("text", "COALESCE(text, '')"))} AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, CASE WHEN LEN(ws) < 3 THEN ARRAY_TO_STRING(ws, ' ') ELSE ARRAY_TO_STRING(ws[i:i + 2], ' ') END AS k
  FROM (SELECT doc_id, ws, UNNEST(RANGE(1, GREATEST(LEN(ws) - 1, 2))) AS i FROM w WHERE LEN(ws) > 0)),
s AS (SELECT doc_id, COUNT(*) AS n, SHA256(STRING_AGG(k, chr(10) ORDER BY k)) AS whole FROM g GROUP BY doc_id),
c AS (SELECT whole, MIN(doc_id) AS a, MIN(n) AS n FROM s GROUP BY whole),
h AS (SELECT a, n, k FROM c JOIN g ON g.doc_id = c.a),
o AS (SELECT x.a AS x, y.a AS y, x.n AS nx, y.n AS ny, COUNT(*) AS m FROM h x JOIN h y USING (k) WHERE x.a < y.a AND 10 * x.n >= 9 * y.n AND 10 * y.n >= 9 * x.n GROUP BY ALL),
l AS (SELECT x, y FROM o WHERE 100 * m >= 90 * (nx + ny - m)),
e AS (SELECT x AS a, y AS b FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT a, a AS root FROM c UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.a),
t AS (SELECT a, MIN(root) AS root FROM r GROUP BY a)
SELECT w.doc_id, COALESCE(s.n, 0) AS n_shingles, COALESCE(t.root, w.doc_id) AS component_id
FROM w LEFT JOIN s ON s.doc_id = w.doc_id LEFT JOIN c ON c.whole = s.whole LEFT JOIN t ON t.a = c.a"""

#: Shares in parts of 10^9 of all kept terms, for every source and for the language as a whole.
DIVERGENCE = f"""WITH d AS (SELECT doc_id, COALESCE(lang, '') AS lang, COALESCE(source, '') AS source,
  REGEXP_EXTRACT_ALL({_LOWER.replace("text", "COALESCE(text, '')")}, '[a-z\\x{{80}}-\\x{{10FFFF}}]+') AS ws FROM documents),
o AS (SELECT doc_id, lang, source, UNNEST(ws) AS term FROM d),
k AS (SELECT lang, term FROM o GROUP BY lang, term HAVING COUNT(DISTINCT doc_id) >= 3),
v AS (SELECT lang, COUNT(*) AS v FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, COUNT(*) AS n FROM o JOIN k USING (lang, term) GROUP BY ALL),
a AS (SELECT g.lang, g.source, k.term, COALESCE(c.n, 0) AS n, v FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 1)) // (SUM(n) OVER (PARTITION BY lang, source) + v) AS p FROM a),
l AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 1)) // (SUM(n) OVER (PARTITION BY lang) + v) AS q
  FROM (SELECT lang, term, SUM(n) AS n, MIN(v) AS v FROM a GROUP BY lang, term)),
r AS (SELECT x.lang, x.source, y.source AS item, COALESCE(s.value, 0) AS value FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, SUM((x.p - y.p) * (x.p - y.p) // y.p) AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s
  ON s.lang = x.lang AND s.source = x.source AND s.item = y.source),
t AS (SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM p JOIN l USING (lang, term) WHERE n > 0 AND p > q),
z AS (SELECT lang, source, 'pair' AS part, item, value FROM r UNION ALL SELECT lang, source, 'term', item, value FROM t)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM z) WHERE part = 'pair' OR rank <= 200"""
