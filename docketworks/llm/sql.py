"""SQL for the queries that SQL can express, against the source tables."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BASE32 = UPPER + "234567"


def _words(pattern: str) -> str:
    return f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{pattern}')"


_LETTERS = _words(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_CHUNKS = _words(r"[^\x20\x09-\x0D]+")

DECONTAMINATION = f"""
WITH docs AS (SELECT doc_id, {_LETTERS} AS words FROM documents),
items AS (SELECT item_id, {_LETTERS} AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS size,
    array_to_string(words[i:i + least(len(words), 10) - 1], ' ') AS window_text
  FROM (SELECT *, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM items WHERE len(words) > 0)),
places AS (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM docs),
found AS (
  SELECT doc_id, i, s.size, window_text FROM (
    SELECT p.doc_id, p.i, s.size, array_to_string(p.words[p.i:p.i + s.size - 1], ' ') AS window_text
    FROM places p, (SELECT DISTINCT size FROM windows) s WHERE p.i + s.size - 1 <= len(p.words)) s
  WHERE window_text IN (SELECT window_text FROM windows)),
hits AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found JOIN windows USING (window_text))
  GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE docs AS (SELECT doc_id, {_CHUNKS} AS words FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle
  FROM (SELECT *, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM docs WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM shingles a JOIN shingles b USING (shingle)
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, x.n, y.n
  HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
reach AS (
  SELECT doc_id AS u, doc_id AS v FROM docs
  UNION SELECT r.u, l.v FROM reach r JOIN links l ON l.u = r.v)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM docs d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT u AS doc_id, min(v) AS component_id FROM reach GROUP BY u) USING (doc_id)"""

_VALUE = "(strpos('0123456789abcdef', substr(hex, 5 * g + {}, 1)) - 1)"
_QUINTET = " + ".join(f"{16 ** (5 - k)} * {_VALUE.format(k)}" for k in range(1, 6))
_LETTER = "substr('{}', 1 + CAST(({}) // {} % 32 AS BIGINT), 1)"
_FOUR = " || ".join(_LETTER.format(BASE32, _QUINTET, 32 ** k) for k in (3, 2, 1, 0))

ARCHIVES = f"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
hashed AS (
  SELECT *, sha1(payload) AS hex, max(page_id) OVER (PARTITION BY payload) AS largest FROM payloads)
SELECT page_id, strlen(payload) AS payload_bytes,
  array_to_string([{_FOUR} FOR g IN range(0, 8)], '') AS payload_digest,
  CASE WHEN page_id < largest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < largest THEN largest END AS refers_to
FROM hashed"""

_ROUNDS = 3


def _clusters() -> str:
    """Rounds written out one after another; a row per vector, dimension and centroid in each."""
    steps = [f"""
kept AS (
  SELECT row_number() OVER () AS row_id, vec_id,
    list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS components
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
started AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)) NULLS LAST, components) - 1 AS cluster,
    components FROM kept QUALIFY cluster < 16),
vectors AS (SELECT row_id, unnest(components) AS x, unnest(range(64)) AS dim FROM kept),
centroids_0 AS (SELECT cluster, unnest(components) AS c, unnest(range(64)) AS dim FROM started)"""]
    for i in range(_ROUNDS + 1):
        steps.append(f"""
nearest_{i} AS (
  SELECT row_id, cluster, distance FROM (
    SELECT row_id, cluster, CAST(sum((x - c) * (x - c)) AS BIGINT) AS distance
    FROM vectors JOIN centroids_{i} USING (dim) GROUP BY row_id, cluster)
  QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY distance, cluster) = 1)""")
        if i < _ROUNDS:
            steps.append(f"""
sums_{i} AS (
  SELECT cluster, dim, sum(x) AS total, count(*) AS members
  FROM nearest_{i} JOIN vectors USING (row_id) GROUP BY cluster, dim),
centroids_{i + 1} AS (
  SELECT cluster, dim,
    CAST(CASE WHEN members IS NULL THEN c ELSE (total - ((total % members) + members) % members) // members END
      AS BIGINT) AS c
  FROM centroids_{i} LEFT JOIN sums_{i} USING (cluster, dim))""")
    return f"""
WITH {",".join(steps)},
named AS (
  SELECT cluster, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY dim)) AS centroid_sha256
  FROM centroids_{_ROUNDS} GROUP BY cluster)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance,
  CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM nearest_{_ROUNDS} JOIN kept USING (row_id) JOIN named USING (cluster)"""


PHRASES = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
places AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM worded),
grams AS (
  SELECT lang, k, words[i:i + k - 1] AS phrase
  FROM places, (SELECT unnest([1, 2, 3]) AS k) s WHERE i + k - 1 <= len(words)),
counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY lang, k, phrase),
totals AS (SELECT lang, sum(f) AS n FROM counts WHERE k = 1 GROUP BY lang),
longer AS (
  SELECT lang, phrase, max(f) AS f FROM (
    SELECT lang, unnest([phrase[1:2], phrase[2:3]]) AS phrase, f FROM counts WHERE k = 3 AND f >= 10)
  GROUP BY lang, phrase),
kept AS (
  SELECT c.lang, c.k AS size, c.phrase, c.f AS a FROM counts c LEFT JOIN longer g USING (lang, phrase)
  WHERE c.k > 1 AND c.f >= 10 AND NOT coalesce(100 * g.f >= 50 * c.f, FALSE)),
cuts AS (SELECT *, unnest(range(1, size)) AS cut FROM kept),
scored AS (
  SELECT u.lang, u.phrase, u.a, x.f AS l, y.f AS r, u.cut,
    (CAST(1000000 AS HUGEINT) * u.a * u.a) // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM cuts u JOIN counts x ON x.lang = u.lang AND x.phrase = u.phrase[1:u.cut]
    JOIN counts y ON y.lang = u.lang AND y.phrase = u.phrase[u.cut + 1:u.size]),
weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (
  SELECT *, array_to_string(phrase, ' ') AS name, row_number() OVER (
    PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(phrase, ' ')) AS place FROM weakest)
SELECT lang, place AS rank, name AS phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE place <= 2000"""

SQL: dict[str, str] = {
    "op2_decontamination": DECONTAMINATION,
    "op3_minhash": NEAR_DUPLICATES,
    "op10_warc": ARCHIVES,
    "op11_zone_clusters": _clusters(),
    "op13_phrases": PHRASES,
}
