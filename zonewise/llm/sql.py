"""DuckDB SQL for the results of those queries that SQL can express."""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{}')"

_OP1 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, %s AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s FROM words
), rows_ AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), keyed AS (
  SELECT doc_id, any_value(n) AS n, md5(string_agg(g, chr(10) ORDER BY g)) AS k FROM rows_ GROUP BY doc_id
), reps AS (
  SELECT k, min(doc_id) AS r FROM keyed GROUP BY k
), own AS (
  SELECT a.doc_id AS r, a.n, a.g FROM rows_ a JOIN reps ON reps.r = a.doc_id
), pairs AS (
  SELECT a.r AS a, b.r AS b, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS i
  FROM own a JOIN own b ON a.g = b.g AND a.r < b.r GROUP BY a.r, b.r
), links AS (
  SELECT a, b FROM pairs WHERE 100 * i >= 90 * (n + m - i)
), both_ AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT r AS a, r AS b FROM reps UNION SELECT reach.a, both_.b FROM reach JOIN both_ ON reach.b = both_.a
), least_ AS (
  SELECT a, min(b) AS c FROM reach GROUP BY a
)
SELECT sets.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(c, sets.doc_id) AS component_id
FROM sets LEFT JOIN keyed USING (doc_id) LEFT JOIN reps USING (k) LEFT JOIN least_ ON least_.a = reps.r
""" % _WORDS.format(r"[^\x20\x09-\x0D]+")

_OP6 = r"""
WITH facts AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256, length(coalesce(text, '')) AS n
  FROM documents
), kept AS (
  SELECT text_sha256, first(doc_id ORDER BY n DESC, doc_id) AS keep_id, count(*) AS group_size FROM facts GROUP BY text_sha256
)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, text_sha256
FROM facts JOIN kept USING (text_sha256)
"""

_OP7 = r"""
WITH facts AS (
  SELECT page_id, sha1(coalesce(html, '')) AS h, strlen(coalesce(html, '')) AS n FROM pages
), last_ AS (
  SELECT h, max(page_id) AS p FROM facts GROUP BY h
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST((CAST('0x' || substr(h, 1 + 5 * (i // 4), 5) AS INTEGER) >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN page_id = p THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = p THEN NULL ELSE p END AS refers_to
FROM facts JOIN last_ USING (h)
"""

_OP9 = r"""
WITH bw AS (
  SELECT item_id, %s AS w FROM benchmark
), windows AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, g, len(string_split(g, ' ')) AS n FROM (
    SELECT item_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 10 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 8), lambda i: array_to_string(w[i:i + 9], ' ')) END) AS g FROM bw)
), dw AS (
  SELECT doc_id, %s AS w FROM documents
), sizes AS (
  SELECT DISTINCT n FROM windows
), runs AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM dw, sizes WHERE len(w) >= n
), hits AS (
  SELECT doc_id, i, r.n, item FROM (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM runs) r JOIN windows ON r.g = windows.g AND r.n = windows.n
), places AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
""" % ((_WORDS.format(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"),) * 2)

#: The CRC-32 of a text, from its table, as DuckDB has no function of this name.
_CRC = r"""
  SELECT list_transform(range(256), lambda i: list_reduce([i::UBIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END)) AS t
"""
_CRC_OF = r"""xor(list_reduce([4294967295::UBIGINT] || list_transform(range(0, strlen({0})),
    lambda k: CAST('0x' || substr(hex(encode({0})), CAST(2 * k + 1 AS INTEGER), 2) AS UBIGINT)),
    lambda c, b: xor(c >> 8, t[CAST((xor(c, b) & 255) + 1 AS INTEGER)])), 4294967295::UBIGINT)"""

_OP13 = r"""
WITH RECURSIVE crc AS (%s
), runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{00C0}-\x{00FF}]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
), hashed AS (
  SELECT run, %s AS h FROM (SELECT run, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS key FROM runs) CROSS JOIN crc
), words AS (
  SELECT CASE WHEN h %% 97 = 0 THEN substr(run, 1, CAST(h %% length(run) AS BIGINT)) || substr(run, CAST(h %% length(run) AS BIGINT) + 2) ELSE run END AS word
  FROM hashed
), vocab AS (
  SELECT word, count(*) AS n FROM words WHERE length(word) >= 5 GROUP BY word HAVING count(*) >= 3
), skips AS (
  SELECT word, n, i, substr(word, 1, i - 1) AS x, substr(word, i + 1) AS y FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocab)
), pairs AS (
  SELECT a.word AS a, b.word AS b FROM skips a JOIN skips b ON a.i = b.i AND a.x = b.x AND a.y = b.y AND a.word <> b.word
  UNION SELECT s.word, v.word FROM skips s JOIN vocab v ON v.word = s.x || s.y
  UNION SELECT v.word, s.word FROM skips s JOIN vocab v ON v.word = s.x || s.y
), near AS (
  SELECT a, count(*) AS n_near, first(b ORDER BY v.n DESC, b) AS b, max(v.n) AS m FROM pairs JOIN vocab v ON v.word = b GROUP BY a
), formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * n THEN b END AS form, CASE WHEN m >= 2 * n THEN m END AS form_n
  FROM vocab LEFT JOIN near ON a = word
), walk AS (
  SELECT word, word AS at, form AS next FROM formed
  UNION ALL SELECT walk.word, f.word, f.form FROM walk JOIN formed f ON f.word = walk.next
)
SELECT f.word, f.form, walk.at AS root, CAST(f.n AS BIGINT) AS n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM formed f JOIN walk ON walk.word = f.word AND walk.next IS NULL
""" % (_CRC, _CRC_OF.format("key"))

_OP12 = r"""
WITH RECURSIVE crc AS (%s
), hashed AS (
  SELECT conv_id, turn, role, text, %s %% 20 AS k FROM (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations) CROSS JOIN crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN k = 3 THEN [1, 2] ELSE [1] END) AS copy FROM hashed WHERE k <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS p FROM damaged
), judged AS (
  SELECT conv_id, turn, role, text, p, left(role, 1) AS i, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS solid,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY p) || left(role, 1) AS two,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 AS seen FROM placed
), faulty AS (
  SELECT *, CASE WHEN solid = '' THEN 'b' WHEN seen THEN 'd' WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS f FROM judged
), way AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS p, {'c': 0::BIGINT, 'a': ''} AS s0, {'c': 1000000000::BIGINT, 'a': ''} AS s1,
    {'c': 1000000000::BIGINT, 'a': ''} AS s2, {'c': 1000000000::BIGINT, 'a': ''} AS s3 FROM conversations
  UNION ALL
  SELECT conv_id, p, {'c': t0.c + 3, 'a': t0.a || 'D'},
    CASE WHEN keep AND i = 's' THEN list_min([{'c': t1.c + 3, 'a': t1.a || 'D'}, {'c': t0.c + m, 'a': t0.a || 'K'}]) ELSE {'c': t1.c + 3, 'a': t1.a || 'D'} END,
    CASE WHEN keep THEN list_min([{'c': t2.c + 3, 'a': t2.a || 'D'}, {'c': t0.c + m + u, 'a': t0.a || eu}, {'c': t1.c + m + u, 'a': t1.a || eu},
      {'c': t3.c + m + u, 'a': t3.a || eu}]) ELSE {'c': t2.c + 3, 'a': t2.a || 'D'} END,
    CASE WHEN keep THEN list_min([{'c': t3.c + 3, 'a': t3.a || 'D'}, {'c': t2.c + m + v, 'a': t2.a || ev}]) ELSE {'c': t3.c + 3, 'a': t3.a || 'D'} END
  FROM (
    SELECT w.conv_id, f.p, f.i, f.f NOT IN ('b', 'd') AS keep, CASE WHEN f.f = 't' THEN 1 ELSE 0 END AS m,
      CASE WHEN f.i = 'u' THEN 0 ELSE 2 END AS u, CASE WHEN f.i = 'u' THEN 'K' ELSE 'R' END AS eu,
      CASE WHEN f.i = 'a' THEN 0 ELSE 2 END AS v, CASE WHEN f.i = 'a' THEN 'K' ELSE 'R' END AS ev, s0 AS t0, s1 AS t1,
      list_min([s2, {'c': s0.c + 2, 'a': s0.a || 'I'}, {'c': s1.c + 2, 'a': s1.a || 'I'}, {'c': s3.c + 2, 'a': s3.a || 'I'}]) AS t2,
      list_min([s3, {'c': s2.c + 2, 'a': s2.a || 'I'}, {'c': s0.c + 4, 'a': s0.a || 'II'}, {'c': s1.c + 4, 'a': s1.a || 'II'}]) AS t3
    FROM way w JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.p = w.p + 1)
), done AS (
  SELECT conv_id, list_min([s0, s3, {'c': s2.c + 2, 'a': s2.a || 'I'}, {'c': s1.c + 4, 'a': s1.a || 'II'}]) AS best
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY p DESC) AS r FROM way) WHERE r = 1
), edits AS (
  SELECT conv_id, j, substr(best.a, CAST(j AS BIGINT), 1) AS e FROM (SELECT conv_id, best, unnest(range(1, length(best.a) + 1)) AS j FROM done)
), numbered AS (
  SELECT *, sum(CASE WHEN e <> 'I' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY j) AS q,
    sum(CASE WHEN e <> 'D' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY j) AS o FROM edits
), lined AS (
  SELECT n.conv_id, j, e, o, role, text, max(CASE WHEN o = 1 AND e = 'K' AND i = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY n.conv_id) AS s
  FROM numbered n LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM n.conv_id AND f.p = n.q AND n.e <> 'I'
), texts AS (
  SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (o - s) %% 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY j) AS t
  FROM lined WHERE e <> 'D' GROUP BY conv_id
), facts AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (f = 'b') AS blank, count(*) FILTER (f = 'd') AS duplicate,
    count(*) FILTER (f = 't') AS truncated, count(*) FILTER (two NOT IN ('su', 'ua', 'au')) AS illegal FROM faulty GROUP BY conv_id
)
SELECT done.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, best.c AS cost, best.a AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM done LEFT JOIN facts ON facts.conv_id IS NOT DISTINCT FROM done.conv_id LEFT JOIN texts ON texts.conv_id IS NOT DISTINCT FROM done.conv_id
""" % (_CRC, _CRC_OF.format("key"))

SQL = {
    "op1_ngram_jaccard_join": _OP1,
    "op6_exact_dedup": _OP6,
    "op7_warc_bundles": _OP7,
    "op9_decontaminate": _OP9,
    "op12_conversation_repair": _OP12,
    "op13_spelling_variants": _OP13,
}
