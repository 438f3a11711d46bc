"""DuckDB SQL with the rows of those queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# Every quotient is made here, down to the number of seats, and the highest are taken.
ORACLES["op1_source_mix"] = """
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_docs FROM docs GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS src, sum(source_size) OVER ()::BIGINT AS total FROM sizes),
weighed AS (SELECT *, CASE src % 3 WHEN 1 THEN 3 WHEN 2 THEN 1 ELSE 2 END AS weight FROM ranked),
prefixes AS (
  SELECT a.*, (SELECT coalesce(sum(2 * b.source_size), 0) FROM weighed b
      WHERE (b.source_size * a.weight, b.src) < (a.source_size * b.weight, a.src))::BIGINT AS caps,
    (SELECT sum(b.weight) FROM weighed b
      WHERE (b.source_size * a.weight, b.src) >= (a.source_size * b.weight, a.src))::BIGINT AS weights
  FROM weighed a),
stops AS (SELECT *, 4 * source_size * weights <= weight * (3 * total - 2 * caps) AS stopped FROM prefixes),
targets AS (
  SELECT *, CASE WHEN stopped THEN (2 * source_size)::DOUBLE
    ELSE (weight * (3 * total - 2 * sum(CASE WHEN stopped THEN 2 * source_size ELSE 0 END) OVER ()))::DOUBLE
      / (2 * sum(CASE WHEN stopped THEN 0 ELSE weight END) OVER ())::DOUBLE END AS target,
    (3 * total + 64) // 128 AS seats FROM stops),
source_quotients AS (
  SELECT src, k, seats, target / (2 * k + 1) AS quotient FROM targets, range(0, 100000) r(k) WHERE k <= target // 64 + 8 AND target > 0),
source_quota AS (
  SELECT src, count(*) AS quota FROM
    (SELECT *, row_number() OVER (ORDER BY quotient DESC, src, k) AS place FROM source_quotients) WHERE place <= seats GROUP BY src),
sharded AS (
  SELECT d.*, t.src, t.source_size, t.target, coalesce(q.quota, 0) AS source_quota,
    ('0x' || substr(md5('mix-1:' || coalesce(d.doc_id::VARCHAR, 'null')), 1, 8))::BIGINT
      % ((t.n_docs + greatest(512, (SELECT (count(*) + 4095) // 4096 FROM docs)) - 1)
         // greatest(512, (SELECT (count(*) + 4095) // 4096 FROM docs))) AS shard
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN source_quota q ON q.src = t.src),
shards AS (
  SELECT src, shard, sum(size)::BIGINT AS z, any_value(source_quota) AS source_quota FROM sharded GROUP BY src, shard),
shard_quotients AS (
  SELECT src, shard, k, source_quota, z::DOUBLE / (2 * k + 1) AS quotient FROM shards, range(0, 100000) r(k)
  WHERE k <= 2 * z // 64 + 8 AND z > 0),
shard_quota AS (
  SELECT src, shard, count(*) AS quota FROM
    (SELECT *, row_number() OVER (PARTITION BY src ORDER BY quotient DESC, shard, k) AS place FROM shard_quotients)
  WHERE place <= source_quota GROUP BY src, shard),
rings AS (
  SELECT s.*, h.z, least(64 * coalesce(q.quota, 0), 2 * h.z) AS words,
    64 * (('0x' || substr(md5('mix-1:start:' || s.src || ':' || s.shard), 1, 8))::BIGINT % greatest(1, (h.z + 63) // 64)) AS f,
    sum(size) OVER (PARTITION BY s.src, s.shard ORDER BY md5('mix-1:order:' || coalesce(doc_id::VARCHAR, 'null')), size
      ROWS UNBOUNDED PRECEDING) AS e
  FROM sharded s JOIN shards h ON h.src = s.src AND h.shard = s.shard
    LEFT JOIN shard_quota q ON q.src = s.src AND q.shard = s.shard)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  (CASE WHEN z > 0 THEN words // z * size + greatest(0, least(e, f + words % z) - greatest(e - size, f))
    + greatest(0, least(e, f + words % z - z) - greatest(e - size, 0)) ELSE 0 END)::BIGINT AS taken
FROM rings"""

# CRC-32 by its table; the slots given up are dealt one by one.
ORACLES["op4_slot_sharding"] = """
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda c, i: CASE WHEN c % 2 = 1 THEN xor(3988292384::BIGINT, c // 2) ELSE c // 2 END)) AS t),
sized AS (
  SELECT doc_id, (octet_length(encode(coalesce(text, ''))) + 16)::BIGINT AS size,
    xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)),
      lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]))) AS text_crc32
  FROM documents, crc_table),
slotted AS (
  SELECT *, (('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':' || text_crc32), 1, 8))::BIGINT % 4096)::INT AS v
  FROM sized),
loads AS (
  SELECT r.v::INT AS v, (r.v % 40)::INT AS shard, coalesce(sum(size), 0)::BIGINT AS bytes, count(size) AS n_rows
  FROM range(4096) r(v) LEFT JOIN slotted s ON s.v = r.v GROUP BY r.v),
marked AS (
  SELECT *, sum(bytes) OVER (PARTITION BY shard ORDER BY bytes DESC, v ROWS UNBOUNDED PRECEDING)
    <= sum(bytes) OVER () / 40 AS stays FROM loads),
pool AS (SELECT v, bytes, row_number() OVER (ORDER BY bytes DESC, v) AS i FROM marked WHERE NOT stays),
kept AS (
  SELECT list(bytes ORDER BY shard) AS loads FROM
    (SELECT r.shard, coalesce(sum(bytes), 0)::BIGINT AS bytes FROM range(40) r(shard)
     LEFT JOIN marked m ON m.shard = r.shard AND stays GROUP BY r.shard)),
deal(i, v, place, loads) AS (
  SELECT 0::BIGINT, -1::INT, 0::INT, loads FROM kept
  UNION ALL
  SELECT p.i, p.v, list_position(d.loads, list_min(d.loads))::INT,
    list_transform(d.loads, lambda x, j: CASE WHEN j = list_position(d.loads, list_min(d.loads)) THEN x + p.bytes ELSE x END)
  FROM deal d JOIN pool p ON p.i = d.i + 1),
newest AS (
  SELECT m.v, coalesce(d.place - 1, m.shard)::INT AS shard, n_rows FROM marked m LEFT JOIN deal d ON d.v = m.v),
begins AS (SELECT *, sum(n_rows) OVER (PARTITION BY shard ORDER BY v) - n_rows AS begin FROM newest)
SELECT s.doc_id, s.size, s.text_crc32, 'bytes' AS law, b.shard,
  (b.begin + row_number() OVER (PARTITION BY s.v ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1)::BIGINT AS slot,
  NULL::INT AS grown_shard
FROM slotted s JOIN begins b ON b.v = s.v"""

ORACLES["op8_exact_dedup"] = """
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents),
ranked AS (
  SELECT doc_id, t, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) AS place,
    first_value(doc_id) OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) AS keep_id,
    count(*) OVER (PARTITION BY t) AS group_size FROM texts)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(t) AS text_sha256 FROM ranked"""

# Exact sets, all pairs that share a shingle and whose sizes allow a link, then reachability.
ORACLES["op3_near_dedup"] = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words),
sizes AS (SELECT w.doc_id, count(s) AS n FROM words w LEFT JOIN shingles s ON s.doc_id = w.doc_id GROUP BY w.doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sizes UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other)
SELECT s.doc_id, s.n AS n_shingles, min(r.other) AS component_id, s.doc_id = min(r.other) AS kept
FROM sizes s JOIN reach r ON r.doc_id = s.doc_id GROUP BY s.doc_id, s.n"""

ORACLES["op9_vector_search"] = """
WITH numbers AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM numbers q JOIN numbers c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""

ORACLES["op6_warc_captures"] = """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(encode(coalesce(html, ''))) AS h FROM pages),
digests AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 8), lambda i:
    array_to_string(list_transform(range(0, 4), lambda j:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, 5 * i + 1, 5))::BIGINT >> (15 - 5 * j)) & 31)::INT + 1, 1)), '')), '')
    AS payload_digest FROM payloads),
ranked AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last FROM digests)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to FROM ranked"""

ORACLES["op7_tool_calls"] = """
WITH RECURSIVE asks AS (
  SELECT conv_id, turn, text, ['search', 'lookup', 'recall'][turn % 3 + 1] AS name, turn // 2 AS half,
    len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS top FROM conversations WHERE role = 'assistant'),
linked AS (
  SELECT a.*, b.turn AS need, r.text AS content, r.turn IS NOT NULL AS has FROM asks a
  LEFT JOIN asks b ON b.conv_id = a.conv_id AND b.turn = a.half AND a.half <> a.turn
  LEFT JOIN conversations r ON r.conv_id = a.conv_id AND r.turn = a.turn + 1),
depth(conv_id, turn, level) AS (
  SELECT conv_id, turn, 0 FROM linked WHERE need IS NULL
  UNION ALL SELECT l.conv_id, l.turn, d.level + 1 FROM linked l JOIN depth d ON d.conv_id = l.conv_id AND d.turn = l.need)
SELECT l.conv_id, l.turn, concat('call-', l.conv_id, '-', l.turn) AS call_id, l.name, d.level::INT AS level,
  CASE WHEN name = 'recall' THEN 'unknown tool'
    WHEN name = 'search' AND (len(text) < 1 OR top < 1 OR top > 80) OR name = 'lookup' AND len(text) > 400 THEN 'invalid'
    WHEN NOT has THEN 'no result' ELSE 'ok' END AS status,
  concat('{"arguments":{"after":[', CASE WHEN need IS NOT NULL THEN concat('"call-', l.conv_id, '-', need, '"') ELSE '' END,
    '],"query":', to_json(text)::VARCHAR, ',"top":', top, '},"id":"call-', l.conv_id, '-', l.turn, '","name":"', name,
    '","result":', coalesce(to_json(content)::VARCHAR, 'null'), '}') AS canonical
FROM linked l JOIN depth d ON d.conv_id = l.conv_id AND d.turn = l.turn"""

ORACLES["op13_fill_in_middle"] = """
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n, sha256(concat('1:', doc_id)) AS h FROM documents),
draws AS (
  SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS c1, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS c2,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90
      THEN 'plain' WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM texts),
cuts AS (SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b FROM draws),
parts AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN concat('<P>', p, '<S>', s, '<M>', m) ELSE concat('<S>', s, '<P>', p, '<M>', m) END)
    AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts"""
