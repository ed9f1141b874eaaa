"""DuckDB SQL for the text queries that SQL can express."""

from __future__ import annotations

_URL = """
WITH p AS (
  SELECT page_id, url,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
rules(verdict, rh, rp) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
judged AS (
  SELECT page_id, host, path,
         (SELECT arg_max(rh || rp, length(rh || rp)) FROM rules WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)) AS rule,
         (SELECT arg_max(verdict, length(rh || rp)) FROM rules WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)) AS said
  FROM p)
"""

#: Pages here carry no canonical links and no refresh redirects, so the oracle has the rules alone; tests cover links.
_OP2 = _URL + "SELECT page_id, host, path, rule, coalesce(said, 'allow') AS verdict FROM judged"

#: A window is two hexadecimal digits a byte, named by its MD5; texts are read in blocks of 1,000 windows, to cut short strings.
_OP3 = """
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
blocks AS (
  SELECT r, b, least(1000, n - 199 - b) AS n_here, substr(h, 2 * b + 1, 2 * 1199) AS part FROM (SELECT r, h, n, unnest(range(0, n - 199, 1000)) AS b FROM docs)),
windows AS (
  SELECT r, b + i AS s, md5_number(substr(part, 2 * i + 1, 400)) AS w FROM (SELECT r, b, part, unnest(range(0, n_here)) AS i FROM blocks)),
again AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
hits AS (
  SELECT r, s, CASE WHEN s <= lag(s) OVER (PARTITION BY r ORDER BY s) + 200 THEN 0 ELSE 1 END AS fresh FROM windows WHERE w IN (SELECT w FROM again)),
marked AS (SELECT r, s, sum(fresh) OVER (PARTITION BY r ORDER BY s) AS run FROM hits),
runs AS (SELECT r, run, min(s) AS s, max(s) + 200 AS e FROM marked GROUP BY r, run),
gaps AS (SELECT r, s, e, coalesce(lag(e) OVER (PARTITION BY r ORDER BY s), 0) AS kept_from FROM runs),
cuts AS (
  SELECT docs.r, sum(e - s) AS n_removed, count(*) AS n_spans, max(e) AS last_e, string_agg(substr(h, 2 * kept_from + 1, 2 * (s - kept_from)), '' ORDER BY s) AS kept
  FROM gaps JOIN docs USING (r) GROUP BY docs.r)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last_e, 0) + 1))) AS kept_sha256
FROM docs LEFT JOIN cuts USING (r)
"""

_OP9 = """
WITH d AS (SELECT doc_id, regexp_extract_all(lower_az, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
           FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_az FROM documents)),
b AS (SELECT item_id, regexp_extract_all(lower_az, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
      FROM (SELECT item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_az FROM benchmark)),
windows AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[s:s + least(10, len(w)) - 1], ' ') AS words
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS words
           FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d CROSS JOIN lengths WHERE len(w) >= n)),
hits AS (SELECT p.doc_id, p.s, p.n, x.item_id FROM places p JOIN windows x ON p.n = x.n AND p.words = x.words),
hit_words AS (SELECT doc_id, count(DISTINCT s + k) AS n_hit FROM (SELECT doc_id, s, unnest(range(0, n)) AS k FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM hits WHERE item_id IS NOT NULL GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


_OP11 = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same, CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
      FROM r AS a JOIN r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank, s.id AS negative_id,
       p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) <= 3
"""

#: The table of CRC-32, from its polynomial, and the sum over a list of bytes in hexadecimal.
_CRC_TABLE = """crc AS (SELECT list(v ORDER BY i) AS entries FROM (
  SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) AS t(i)))"""


def _crc(text: str) -> str:
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: CAST('0x' || h AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {octets}), lambda c, o: xor(entries[(xor(c, o) & 255) + 1], c >> 8)), 4294967295)"


_OP12 = f"""
WITH {_CRC_TABLE},
turns AS (SELECT conv_id, turn, sha256(strlen(r) || ':' || r || t) AS id, len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')) AS words
          FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL)),
convs AS (SELECT conv_id, list({{'id': id, 'words': words}} ORDER BY turn NULLS FIRST, id) AS own FROM turns GROUP BY conv_id),
opened AS (SELECT c.conv_id, c.own, coalesce(b.own, []) AS base, {_crc("CAST(c.conv_id AS VARCHAR)")} % 4 AS h
           FROM convs AS c CROSS JOIN crc LEFT JOIN convs AS b ON b.conv_id = c.conv_id - c.conv_id % 20),
rebuilt AS (SELECT conv_id, list_concat(CASE WHEN h > 0 THEN base[1:h] ELSE base[1:0] END, own[h + 1:]) AS turns FROM opened),
prefixes AS (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt),
members AS (SELECT conv_id, depth, len(turns) = depth AS ends, array_to_string(list_transform(turns[1:depth], lambda x: x.id), ',') AS node,
                   array_to_string(list_transform(turns[1:depth - 1], lambda x: x.id), ',') AS parent, CASE WHEN depth > 0 THEN turns[depth].words ELSE 0 END AS words,
                   list_transform(range(0, depth + 1), lambda d: CASE WHEN d = 0 THEN '' ELSE array_to_string(list_transform(turns[1:d], lambda x: x.id), ',') END) AS above
            FROM prefixes),
nodes AS (SELECT CASE WHEN depth = 0 THEN '' ELSE node END AS node, depth, CASE WHEN depth > 1 THEN parent ELSE '' END AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words,
                 any_value(above) AS above, sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
          FROM members GROUP BY ALL),
children AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY parent),
own AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes AS n LEFT JOIN children USING (node)),
under AS (SELECT up AS node, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * words) AS saved_tokens
          FROM (SELECT unnest(above) AS up, n_children, n_convs, words FROM own) GROUP BY up)
SELECT o.conv_id, o.depth, p.conv_id AS parent_conv_id, o.n_convs, o.n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, o.ends_sha256
FROM own AS o JOIN under AS u ON o.node = u.node LEFT JOIN own AS p ON o.depth > 0 AND p.node = o.parent
"""

_OP13 = f"""
WITH RECURSIVE {_CRC_TABLE},
docs AS (SELECT doc_id, coalesce(text, '') AS text, CAST(strlen(coalesce(text, '')) + 16 AS BIGINT) AS size FROM documents),
groups AS (SELECT text, CAST(sum(size) AS BIGINT) AS size, min(doc_id) AS first FROM docs GROUP BY text),
placed AS (SELECT text, size, row_number() OVER (ORDER BY size DESC, first) AS k, row_number() OVER (PARTITION BY size ORDER BY first) AS r FROM groups),
steps(k, loads, size, shard) AS (
  SELECT CAST(0 AS BIGINT), list_transform(range(40), lambda x: CAST(0 AS BIGINT)), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)
  UNION ALL
  SELECT p.k, list_transform(s.loads, lambda x, i: CASE WHEN i = list_position(s.loads, list_min(s.loads)) THEN x + p.size ELSE x END), p.size, CAST(list_position(s.loads, list_min(s.loads)) - 1 AS BIGINT)
  FROM steps AS s JOIN placed AS p ON p.k = s.k + 1),
shares AS (SELECT size, shard, count(*) AS n FROM steps WHERE k > 0 GROUP BY size, shard),
spans AS (SELECT size, shard, sum(n) OVER (PARTITION BY size ORDER BY shard) AS upto, sum(n) OVER (PARTITION BY size ORDER BY shard) - n AS after FROM shares),
homes AS (SELECT p.text, s.shard FROM placed AS p JOIN spans AS s ON p.size = s.size AND p.r > s.after AND p.r <= s.upto)
SELECT d.doc_id, d.size, {_crc("d.text")} AS text_crc32, 'bytes' AS law, CAST(h.shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY h.shard ORDER BY d.doc_id) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM docs AS d JOIN homes AS h ON d.text = h.text CROSS JOIN crc
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_url_filter": _OP2, "op3_suffix_dedup": _OP3, "op9_decontaminate": _OP9, "op11_hard_negatives": _OP11, "op12_conversation_trie": _OP12, "op13_sharding": _OP13}
