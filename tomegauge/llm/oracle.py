"""SQL for the queries whose rows SQL can express. The others are tested against brute force."""

from __future__ import annotations

MIX = r"""
WITH RECURSIVE rows AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    coalesce(q.w, 1.0) AS w,
    (CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '#1'), 1, 13)) AS BIGINT) + 0.5) / 4503599627370496.0 AS u
  FROM documents LEFT JOIN (
    SELECT doc_id AS id, pow(4.0, avg(quality) - 0.5) AS w FROM labels WHERE quality IS NOT NULL GROUP BY doc_id
  ) q ON q.id = documents.doc_id
), sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight
  FROM rows GROUP BY source
), share(n, level) AS (  -- the share per weight, raised as long as sources stop at their limit
  SELECT 0, (SELECT sum(source_size) / sum(weight) FROM sizes)
  UNION ALL
  SELECT n + 1, (
    SELECT (sum(source_size) - sum(CASE WHEN level * weight > 3.0 * source_size THEN 3.0 * source_size ELSE 0 END))
      / nullif(sum(CASE WHEN level * weight > 3.0 * source_size THEN 0 ELSE weight END), 0) FROM sizes)
  FROM share WHERE n < 40
), targets AS (
  SELECT source, source_size, least(3.0 * source_size, weight * (SELECT max(level) FROM share)) AS target FROM sizes
), plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM targets
), placed AS (
  SELECT r.doc_id, r.size, p.source_size, p.target, p.epochs, CAST(round(p.target - p.epochs * p.source_size) AS BIGINT) AS budget,
    coalesce(sum(r.size) OVER (PARTITION BY r.source ORDER BY -ln(r.u) / r.w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
  FROM rows r JOIN plan p ON r.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
  CAST(epochs * size + greatest(0, least(size, budget - earlier)) AS BIGINT) AS taken
FROM placed
"""

SHARDS = r"""
WITH steps AS (  -- the table of the CRC with polynomial 0xEDB88320: one entry per byte
  SELECT list_transform(range(256), lambda n: list_reduce(
    list_prepend(CAST(n AS BIGINT), CAST(range(8) AS BIGINT[])),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
), sized AS (
  SELECT doc_id, coalesce(text, '') AS text, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size FROM documents
), summed AS (
  SELECT *, xor(list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT), list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda b: CAST(('0x' || b) AS BIGINT))),
      lambda c, b: xor(c >> 8, crc[CAST(xor(c & 255, b) + 1 AS INTEGER)])), 4294967295) AS text_crc32,
    sum(size) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto, sum(size) OVER () AS total
  FROM sized, steps
), cut AS (
  SELECT *, CAST(least(7, (2 * upto - size) * 8 // (2 * total)) AS INTEGER) AS shard FROM summed
)
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'bytes' AS law, shard,
  CAST(row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM cut
"""

NEAR = r"""
WITH RECURSIVE cut AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), items AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(len(words) - 2), lambda i: words[i + 1] || ' ' || words[i + 2] || ' ' || words[i + 3]) END) AS item
  FROM cut
), sizes AS (
  SELECT cut.doc_id, CAST(count(item) AS BIGINT) AS n FROM cut LEFT JOIN items USING (doc_id) GROUP BY cut.doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM items a JOIN items b ON a.item = b.item AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * n_both >= 85 * (x.n + y.n - n_both)
), reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT sizes.doc_id, n AS n_shingles, least(sizes.doc_id, coalesce(min(b), sizes.doc_id)) AS component_id,
  sizes.doc_id = least(sizes.doc_id, coalesce(min(b), sizes.doc_id)) AS kept
FROM sizes LEFT JOIN reach ON a = sizes.doc_id GROUP BY sizes.doc_id, n
"""


NEGATIVES = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS row_id, a.label = r.label AS same,
    CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda k: a.v[k] * r.v[k])) AS BIGINT) AS score
  FROM rows a JOIN rows r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
), positives AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, row_id) AS place FROM scored WHERE same
  ) WHERE place <= 5
), negatives AS (
  SELECT p.anchor_id, p.row_id AS positive_id, n.row_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.row_id ORDER BY n.score DESC, n.row_id) AS rank
  FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
    AND 100 * n.score >= 80 * p.score AND 100 * n.score <= 100 * p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 5
"""

FILTERS = r"""
WITH rests AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), cut AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rests
), rules(name, start, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), fits AS (
  SELECT page_id, host, path, name || start AS rule, verdict,
    row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(name) + length(start) DESC NULLS LAST) AS place
  FROM cut LEFT JOIN rules ON (host = name OR suffix(host, '.' || name)) AND prefix(path, start)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE place = 1
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_minhash_near_dedup": NEAR, "op5_mix_sources": MIX, "op10_sharding": SHARDS, "op12_hard_negatives": NEGATIVES, "op13_url_filters": FILTERS}
