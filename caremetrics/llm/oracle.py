"""SQL twins of the queries that SQL can express at the size of the tables."""

from __future__ import annotations

_EXACT_DEDUP = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY body ORDER BY n DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY body) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY body ORDER BY n DESC, doc_id) AS kept,
       sha256(body) AS text_sha256
FROM d
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_DECONTAMINATION = rf"""
WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, list_slice(w, i, i + 9) AS words
  FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT doc_id, i, size, list_slice(w, i, i + size - 1) AS words
  FROM docs, sizes, unnest(range(1, len(w) - size + 2)) AS t(i)),
found AS (SELECT doc_id, item_id, i, p.size FROM places p JOIN windows v ON p.words = v.words),
hit AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM found, unnest(range(i, i + size)) AS t(k) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
  FROM found GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

_SUBSTRING_DEDUP = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 19), ' ')) AS h
  FROM d, unnest(range(1, len(w) - 18)) AS t(i)),
ranked AS (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS place FROM windows),
gone AS (
  SELECT DISTINCT doc_id, k FROM ranked, unnest(range(i, i + 20)) AS t(k) WHERE place > 1),
marks AS (SELECT doc_id, list(k) AS ks FROM gone GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(ks), 0)::BIGINT AS n_removed,
       sha256(array_to_string(
         CASE WHEN ks IS NULL THEN w
              ELSE list_transform(list_filter(range(1, len(w) + 1), lambda k: NOT list_contains(ks, k)), lambda k: w[k])
         END, ' ')) AS kept_sha256
FROM d LEFT JOIN marks USING (doc_id)
"""


_RANKED_SEARCH = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
i AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
q AS (SELECT DISTINCT item_id, t FROM (SELECT item_id, unnest(ws) AS t FROM i)),
s AS (SELECT count(*) FILTER (WHERE len(ws) > 0)::BIGINT AS nn, sum(len(ws))::BIGINT AS ll FROM d),
tf AS (SELECT doc_id, t, len(ws)::BIGINT AS n, count(*)::BIGINT AS tf
       FROM (SELECT doc_id, ws, unnest(ws) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY ALL),
w AS (SELECT t, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, s GROUP BY t, nn),
scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * nn) // ll))))::BIGINT AS score
  FROM q JOIN tf USING (t) JOIN w USING (t), s GROUP BY item_id, doc_id),
placed AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 10
"""

# CRC-32 byte by byte over all distinct features at once.
_RESAMPLING = rf"""
WITH RECURSIVE
bits AS (SELECT k, 0 AS i, k AS v FROM range(256) AS r(k)
         UNION ALL SELECT k, i + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE i < 8),
tab AS (SELECT k, v FROM bits WHERE i = 8),
texts AS (
  SELECT 0 AS kind, doc_id AS id, {_WORDS} AS w FROM documents
  UNION ALL
  SELECT 1, item_id, {_WORDS} FROM benchmark),
feats AS (
  SELECT kind, id, unnest(w) AS f FROM texts
  UNION ALL
  SELECT kind, id, w[i] || ' ' || w[i + 1] FROM texts, unnest(range(1, len(w))) AS t(i)),
each AS (SELECT kind, id, f, count(*) AS n FROM feats GROUP BY ALL),
crc AS (
  SELECT f, hex(f) AS h, 0 AS i, 4294967295 AS c FROM (SELECT DISTINCT f FROM each)
  UNION ALL
  SELECT f, h, i + 1, xor(c >> 8, v) FROM crc JOIN tab ON k = xor(c & 255, ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)
  WHERE 2 * i < length(h)),
hashed AS (SELECT f, xor(c, 4294967295) % 10000 AS bucket FROM crc WHERE 2 * i = length(h)),
held AS (SELECT kind, id, bucket, n FROM each JOIN hashed USING (f)),
sums AS (SELECT bucket, coalesce(sum(n) FILTER (WHERE kind = 0), 0)::DOUBLE AS s,
                coalesce(sum(n) FILTER (WHERE kind = 1), 0)::DOUBLE AS t FROM held GROUP BY bucket),
gains AS (SELECT bucket, floor(1000 * ln(((t + 1) * ((SELECT sum(s) FROM sums) + 10000)) /
                                         ((s + 1) * ((SELECT sum(t) FROM sums) + 10000))))::BIGINT AS gain FROM sums),
weights AS (SELECT id, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::DOUBLE / sum(n))::BIGINT AS weight
            FROM held JOIN gains USING (bucket) WHERE kind = 0 GROUP BY id),
scored AS (
  SELECT id AS doc_id, len(w) >= 20 AS fits, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || id::VARCHAR), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM texts LEFT JOIN weights USING (id) WHERE kind = 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY fits ORDER BY score DESC, doc_id) AS place,
                  count(*) FILTER (WHERE fits) OVER () AS total FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN fits AND place <= 25 * total // 100 THEN place END AS rank FROM placed
"""


def oracle() -> dict[str, str]:
    return {
        "op6_substring_dedup": _SUBSTRING_DEDUP,
        "op8_exact_dedup": _EXACT_DEDUP,
        "op10_decontamination": _DECONTAMINATION,
        "op12_ranked_search": _RANKED_SEARCH,
        "op13_resampling": _RESAMPLING,
    }
