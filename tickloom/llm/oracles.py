"""DuckDB SQL that gives the rows of the queries it is named after."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

MINHASH = rf"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM worded
), flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny, count(*) AS common
  FROM flat a JOIN flat b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (SELECT x, y FROM pairs WHERE 100 * common >= 85 * (nx + ny - common)
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON r.other = l.x
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM sets s JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)
"""

_TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

DECONTAMINATE = rf"""
WITH docs AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_TERM}') AS w FROM documents
), items AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER}, '{_TERM}') AS w FROM benchmark
), cut AS (SELECT item, least(10, len(w)) AS n, w FROM items WHERE len(w) > 0
), known AS (
  SELECT DISTINCT item, n, array_to_string(g, ' ') AS g FROM (
    SELECT item, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: w[i:i + n - 1])) AS g FROM cut)
), lengths AS (SELECT DISTINCT n FROM known
), spots AS (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lengths WHERE len(w) >= n
), hits AS (
  SELECT s.doc_id, s.i, s.n, k.item FROM (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM spots) s
  JOIN known k ON k.n = s.n AND k.g = s.g
), places AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names
  FROM hits GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(p.n_hit, 0) AS n_hit, coalesce(m.n_items, 0) AS n_items,
  sha256(coalesce(m.names, '')) AS items_sha256, coalesce(p.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN places p USING (doc_id) LEFT JOIN named m USING (doc_id)
"""

NEIGHBOURS = """
WITH RECURSIVE valid AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM valid a JOIN valid b
  ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95
), reach AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION SELECT r.vec_id, l.y FROM reach r JOIN links l ON r.other = l.x
), least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id
), counts AS (SELECT x AS vec_id, count(*) AS n FROM links GROUP BY x)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM embeddings e JOIN least l USING (vec_id) LEFT JOIN counts c USING (vec_id)
"""

REPEATS = """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), strings AS (
  SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS i FROM docs)
), least AS (SELECT s, min(doc_id) AS first FROM strings GROUP BY s
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM strings JOIN least USING (s) WHERE doc_id > first
), bytes AS (
  SELECT d.doc_id, b.p, substr(d.h, 2 * b.p + 1, 2) AS b, g.p IS NOT NULL AS g
  FROM (SELECT doc_id, unnest(range(0, len(h) // 2)) AS p FROM docs WHERE doc_id IN (SELECT doc_id FROM gone)) b JOIN docs d USING (doc_id)
  LEFT JOIN gone g ON g.doc_id = b.doc_id AND g.p = b.p
), runs AS (
  SELECT doc_id, p, b, g, g AND NOT coalesce(lag(g) OVER (PARTITION BY doc_id ORDER BY p), false) AS begins FROM bytes
), kept AS (
  SELECT doc_id, count(*) FILTER (g) AS n_removed, count(*) FILTER (begins) AS n_spans,
    coalesce(string_agg(b, '' ORDER BY p) FILTER (NOT g), '') AS k FROM runs GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes, coalesce(k.n_removed, 0) AS n_removed,
  coalesce(k.n_spans, 0) AS n_spans, sha256(unhex(coalesce(k.k, d.h))) AS kept_sha256
FROM docs d LEFT JOIN kept k USING (doc_id)
"""

LINES = r"""
WITH split AS (SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS a FROM documents
), filled AS (
  SELECT doc_id, list_filter(list_transform(a, lambda x, i: {'i': i, 'x': x, 'w': len(regexp_extract_all(x, '[^\x09-\x0D\x20]+'))}),
    lambda s: trim(s.x) <> '') AS f FROM split
), places AS (SELECT doc_id, f, unnest(range(1, len(f) + 1)) AS j FROM filled
), runs AS (
  SELECT doc_id, j, n, list_transform(f[j:j + n - 1], lambda s: s.x) AS run FROM places, (VALUES (1), (2), (3)) sizes(n)
  WHERE j + n - 1 <= len(f) AND (n = 3 OR list_sum(list_transform(f[j:j + n - 1], lambda s: s.w)) >= 50)
), later AS (
  SELECT doc_id, j, n FROM (SELECT doc_id, j, n, row_number() OVER (PARTITION BY run ORDER BY doc_id, j) AS k FROM runs) WHERE k > 1
), gone AS (SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(j, j + n)) AS p FROM later) GROUP BY doc_id
), placed AS (SELECT doc_id, list_transform(g.ps, lambda p: f[p].i) AS gone FROM gone g JOIN filled USING (doc_id))
SELECT s.doc_id, CAST(len(f.f) AS BIGINT) AS line_count, CAST(coalesce(len(p.gone), 0) AS BIGINT) AS lines_removed,
  sha256(CASE WHEN p.gone IS NULL THEN s.text ELSE coalesce(array_to_string(
    list_filter(s.a, lambda x, i: NOT list_contains(p.gone, i)), chr(10)), '') END) AS kept_sha256
FROM split s JOIN filled f USING (doc_id) LEFT JOIN placed p USING (doc_id)
"""

URLS = """
WITH split AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM split
), rules(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), judged AS (
  SELECT page_id, host, path, (SELECT max({'n': len(h || p), 'r': h || p, 'v': v}) FROM rules
    WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS rule FROM parts
)
SELECT page_id, host, path, rule.r AS rule, coalesce(rule.v, 'allow') AS verdict FROM judged
"""

PHRASES = r"""
WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), pieces AS (
  SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS ws FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS p FROM docs)
), places AS (
  SELECT lang, unnest(list_transform(ws, lambda w, i: {'x': w, 'y': ws[i + 1], 'z': ws[i + 2]}), recursive := true) FROM pieces
), ones AS (SELECT lang, x, count(*) AS f FROM places GROUP BY ALL
), twos AS (SELECT lang, x, y, count(*) AS f FROM places WHERE y IS NOT NULL GROUP BY ALL
), threes AS (SELECT lang, x, y, z, count(*) AS f FROM places WHERE z IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
), most AS (
  SELECT lang, x, y, max(f) AS f FROM (SELECT lang, x, y, f FROM threes UNION ALL SELECT lang, y, z, f FROM threes) GROUP BY lang, x, y
), cuts AS (
  SELECT t.lang, t.x || ' ' || t.y AS phrase, 1 AS k, t.f AS a, l.f AS l, r.f AS r FROM twos t
  JOIN ones l ON l.lang = t.lang AND l.x = t.x JOIN ones r ON r.lang = t.lang AND r.x = t.y
  LEFT JOIN most m ON m.lang = t.lang AND m.x = t.x AND m.y = t.y WHERE t.f >= 10 AND NOT coalesce(100 * m.f >= 50 * t.f, false)
  UNION ALL
  SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, 1, t.f, l.f, r.f FROM threes t
  JOIN ones l ON l.lang = t.lang AND l.x = t.x JOIN twos r ON r.lang = t.lang AND r.x = t.y AND r.y = t.z
  UNION ALL
  SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, 2, t.f, l.f, r.f FROM threes t
  JOIN twos l ON l.lang = t.lang AND l.x = t.x AND l.y = t.y JOIN ones r ON r.lang = t.lang AND r.x = t.z
), scored AS (
  SELECT *, CAST((1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts
), lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest
), totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM ones GROUP BY lang)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

# The crc32 of a text, four bits at a time; fixed values: the remainders of the 16 nibbles under the polynomial 0xEDB88320.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(len(hex)),
    lambda i: strpos('0123456789ABCDEF', substr(hex, xor(i, 1) + 1, 1)) - 1)), lambda c, b: xor((c >> 4), ([0, 498536548, 997073096,
    651767980, 1994146192, 1802195444, 1303535960, 1342533948, 3988292384, 4027552580, 3604390888, 3412177804, 2607071920,
    2262029012, 2685067896, 3183342108])[1 + (xor(c, b) & 15)])))"""

SPELLING = r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS c FROM (SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents) GROUP BY ALL
), hashed AS (
  SELECT run, c, CRC AS h FROM (SELECT run, c, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS hex FROM runs)
), words AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % len(run)) || substr(run, h % len(run) + 2) ELSE run END AS word, CAST(sum(c) AS BIGINT) AS n
  FROM hashed GROUP BY 1 HAVING len(word) >= 5 AND sum(c) >= 3
), cuts AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, len(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS near FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT c.word, w.word FROM cuts c JOIN words w ON w.word = c.rest
  UNION SELECT w.word, c.word FROM cuts c JOIN words w ON w.word = c.rest
), best AS (
  SELECT x.word, count(*) AS n_near, min({'n': -y.n, 'word': y.word}) AS b FROM near x JOIN words y ON y.word = x.near GROUP BY x.word
), formed AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN -b.b.n >= 2 * w.n THEN b.b.word END AS form,
    CASE WHEN -b.b.n >= 2 * w.n THEN -b.b.n END AS form_n FROM words w LEFT JOIN best b USING (word)
), ways(word, last, step) AS (
  SELECT word, word, 0 FROM formed
  UNION ALL SELECT w.word, f.form, w.step + 1 FROM ways w JOIN formed f ON f.word = w.last WHERE f.form IS NOT NULL
), roots AS (SELECT word, arg_max(last, step) AS root FROM ways GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN roots USING (word)
""".replace("CRC", _CRC)


def sharding(owners: list[str]) -> str:
    """For the shard of each slot, in order."""
    names = ", ".join(f"'{o}'" for o in owners)
    return f"""
WITH lookup AS (SELECT unnest(range({len(owners)})) AS slot, unnest([{names}]) AS shard
), digits AS (SELECT doc_id, source, substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS d FROM documents
), placed AS (SELECT doc_id, source, CAST(CAST('0x' || d AS BIGINT) % {len(owners)} AS INT) AS slot FROM digits
)
SELECT p.doc_id, p.source, p.slot, l.shard FROM placed p JOIN lookup l USING (slot)
"""
