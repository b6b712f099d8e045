"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

#: CRC-32 (reflected, polynomial 0xEDB88320 = 3988292384) from a table made of its rule.
_CRC32 = """
crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
"""

OP6 = f"""
WITH {_CRC32}
base AS (SELECT doc_id, coalesce(text, '') AS body, coalesce(CAST(doc_id AS VARCHAR), '') AS k
  FROM documents),
bytes AS (SELECT *, hex(encode(body)) AS hx FROM base),
summed AS (SELECT doc_id, k, strlen(body) + 1 AS size, xor(list_reduce(list_prepend(4294967295,
    list_transform(range(0, length(hx) // 2), lambda p: CAST('0x' || hx[2 * p + 1 : 2 * p + 2] AS BIGINT))),
    lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS BIGINT) + 1])), 4294967295) AS text_crc32
  FROM bytes, crc_table),
draws AS (SELECT *, list_transform(range(17), lambda s:
    -ln((CAST('0x' || substr(md5(k || ':' || s), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0)) AS d
  FROM summed),
placed AS (SELECT *, list_position(d[1:16], list_min(d[1:16])) - 1 AS shard,
    list_position(d, list_min(d)) - 1 AS grown_shard FROM draws)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law,
  CAST(shard AS INTEGER) AS shard, row_number() OVER (PARTITION BY shard
    ORDER BY md5(k || ':' || size || ':' || text_crc32), doc_id, size, text_crc32) - 1 AS slot, CAST(grown_shard AS INTEGER) AS grown_shard
FROM placed
"""

OP4 = """
WITH RECURSIVE
docs AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \\x09-\\x0D]+')) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), chr(1)) || chr(2) || coalesce(text, chr(1))
      || chr(2) || coalesce(source, chr(1)) || chr(2)), 1, 15) AS BIGINT) AS key
  FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM docs GROUP BY source),
weighed AS (SELECT *, [3.0::DOUBLE, 1.0, 2.0][CAST(rank % 3 AS INTEGER) + 1] AS w, 2.0::DOUBLE * source_size AS stop
  FROM sources),
whole AS (SELECT 1.5::DOUBLE * sum(source_size)::DOUBLE AS words, sum(w) AS w FROM weighed),
rounds AS (
  SELECT 1 AS i, words / w AS rate FROM whole
  UNION ALL
  SELECT i + 1, ((SELECT words FROM whole) - (SELECT coalesce(sum(stop), 0) FROM weighed WHERE w * rate > stop))
      / (SELECT sum(w) FROM weighed WHERE w * rate <= stop)
  FROM rounds WHERE i < 50 AND EXISTS (SELECT 1 FROM weighed WHERE w * rate <= stop)),
final AS (SELECT max(rate) AS rate FROM rounds),
targets AS (SELECT weighed.*, least(w * rate, stop) AS target FROM weighed, final),
placed AS (SELECT d.*, t.rank, t.source_size, t.target,
    CAST(sum(d.size) OVER (PARTITION BY t.rank ORDER BY d.key, d.doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
queue AS (SELECT p.*, e, e * source_size + upto AS pos, (e * source_size + upto) / target AS finish
  FROM placed p, (VALUES (0), (1)) x(e) WHERE size > 0),
taking AS (SELECT *, sum(size) OVER (ORDER BY finish, rank, pos ROWS UNBOUNDED PRECEDING)
    <= (SELECT floor(sum(target) + 0.25) FROM targets) AS take FROM queue),
times AS (SELECT doc_id, key, count(*) AS n FROM taking WHERE take GROUP BY doc_id, key)
SELECT p.doc_id, p.source, CAST(p.size AS BIGINT) AS size, p.source_size, p.target,
  CAST(p.size * coalesce(n, 0) AS BIGINT) AS taken
FROM placed p LEFT JOIN times t ON p.doc_id = t.doc_id AND p.key = t.key
"""

OP2 = r"""
WITH docs AS (SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents),
named AS (SELECT row_number() OVER () AS d, doc_id,
    regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS ws FROM docs),
items AS (SELECT DISTINCT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS ws
  FROM benchmark),
sized AS (SELECT *, len(ws) AS n, least(len(ws), 5) AS k FROM items WHERE len(ws) > 0),
pieces AS (SELECT item_id, n, k, array_to_string(ws[q + 1 : q + k], ' ') AS sh
  FROM (SELECT *, unnest(range(0, n - k + 1)) AS q FROM sized)),
counted AS (SELECT item_id, n, k, sh, count(*) AS w FROM pieces GROUP BY ALL),
parts AS (SELECT d, m, k, p, array_to_string(ws[p + 1 : p + k], ' ') AS sh
  FROM (SELECT d, ws, len(ws) AS m, k, unnest(range(0, greatest(0, len(ws) - k + 1))) AS p
        FROM named, (SELECT DISTINCT k FROM sized))),
hits AS (SELECT d, m, p, c.*, least(n, m) - c.k + 1 AS size FROM parts JOIN counted c USING (sh, k)),
starts AS (SELECT *, unnest(range(greatest(0, p - size + 1), least(p, greatest(0, m - n)) + 1)) AS s FROM hits),
shared AS (SELECT d, item_id, n, k, m, s, size, sh, least(count(*), any_value(w)) AS common
  FROM starts GROUP BY d, item_id, n, k, m, s, size, sh),
scored AS (SELECT d, item_id, s, CAST(size + k - 1 AS INTEGER) AS window_words,
    sum(common) / (size + n - k + 1 - sum(common)) AS similarity
  FROM shared GROUP BY d, item_id, n, k, m, s, size),
best AS (SELECT *, row_number() OVER (PARTITION BY d, item_id ORDER BY similarity DESC, s) AS r
  FROM scored WHERE similarity >= 0.8)
SELECT doc_id, item_id, similarity, CAST(s AS INTEGER) AS window_start, window_words
FROM best JOIN named USING (d) WHERE r = 1
"""

OP11 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents),
size AS (SELECT count(*) FILTER (len(ts) > 0) AS n_docs, sum(len(ts))::BIGINT AS n_terms FROM docs),
items AS (SELECT DISTINCT item_id, text FROM benchmark),
asked AS (
  SELECT k, item_id, term, count(*) AS times FROM (
    SELECT k, item_id, unnest(ts) AS term FROM (
      SELECT row_number() OVER () AS k, item_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM items)) GROUP BY ALL),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM docs)
       WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w
      FROM tf, size GROUP BY term, n_docs),
scores AS (
  SELECT k, item_id, doc_id, r, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS score
  FROM (SELECT r, doc_id, 25 + (75 * len(ts) * n_docs) // n_terms AS m FROM docs, size WHERE len(ts) > 0)
  JOIN tf USING (r) JOIN w USING (term) JOIN asked USING (term) GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 10
"""

OP13 = f"""
WITH RECURSIVE {_CRC32}
runs AS (
  SELECT k, run, count(*) AS times, hex(encode(k || ':' || run)) AS hx FROM (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS k, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run
    FROM documents) WHERE length(run) >= 7 GROUP BY ALL),
summed AS (
  SELECT run, times, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(length(hx) // 2),
    lambda i: CAST('0x' || substr(hx, 2 * i + 1, 2) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[1 + xor(c & 255, b)]))) AS h
  FROM runs, crc_table),
words AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
    SELECT times, CASE WHEN h % 31 = 0 THEN left(run, CAST(h % length(run) AS INTEGER))
      || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word FROM summed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
cut AS (SELECT word, i, left(word, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, CAST(unnest(range(length(word))) AS INTEGER) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS near FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT c.word, w.word FROM cut c JOIN words w ON c.rest = w.word
  UNION SELECT w.word, c.word FROM cut c JOIN words w ON c.rest = w.word),
best AS (
  SELECT p.word, count(*) AS n_near, min({{'m': -w.n, 'near': p.near}}) AS top
  FROM near p JOIN words w ON p.near = w.word GROUP BY p.word),
formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -top.m >= 10 * n THEN top.near END AS form,
    CASE WHEN -top.m >= 10 * n THEN -top.m END AS form_n
  FROM words LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS root, 0 AS steps FROM formed
  UNION ALL SELECT c.word, f.form, c.steps + 1 FROM chain c JOIN formed f ON c.root = f.word WHERE f.form IS NOT NULL),
last AS (SELECT word, arg_max(root, steps) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN last USING (word)
"""
OP12 = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
usable AS (
  SELECT * FROM v WHERE label IS NOT NULL AND len(x) > 0
    AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(x, lambda c: c <> 0)) > 0),
links AS (
  SELECT a.r AS a, b.r AS b FROM usable a JOIN usable b ON a.label = b.label AND len(a.x) = len(b.x) AND a.r <> b.r
  WHERE list_dot_product(a.x, b.x) >= 0.98 * sqrt(list_dot_product(a.x, a.x)) * sqrt(list_dot_product(b.x, b.x))),
reach AS (SELECT a, b FROM links UNION SELECT q.a, l.b FROM reach q JOIN links l ON q.b = l.a),
least AS (SELECT q.a AS r, min(o.vec_id) AS other FROM reach q JOIN v o ON q.b = o.r GROUP BY q.a),
counted AS (SELECT a AS r, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(other, vec_id)) AS component_id,
  coalesce(vec_id = least(vec_id, coalesce(other, vec_id)), false) AS kept
FROM v LEFT JOIN least USING (r) LEFT JOIN counted USING (r)
"""

ORACLE = {"op2_decontaminate": OP2, "op4_mix_sources": OP4, "op6_rendezvous_shards": OP6,
          "op11_lexical_search": OP11, "op12_embedding_dedup": OP12, "op13_spelling_variants": OP13}
