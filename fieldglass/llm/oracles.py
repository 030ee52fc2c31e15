"""SQL of the queries whose whole result SQL can express."""

from __future__ import annotations

from .cap_filters import THRESHOLD
from .digest_runs import LOWER, UPPER
from .ngram_join import SHARE, WINDOW
from .subvector_clusters import CLUSTERS, ROUNDS, SCALE, SEED, WIDTH
from .warc import REVISIT_BYTES

REVISITS = f"""
WITH digests AS (SELECT page_id, url, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
named AS (SELECT *, payload_bytes >= {REVISIT_BYTES} AND page_id <> max(page_id) OVER same AS again, max(page_id) OVER same AS first_id FROM digests WINDOW same AS (PARTITION BY payload_digest))
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first_id END AS refers_to, url FROM named
"""

#: Smallest id reachable by ``links`` (a, b, in both directions) for every row of ``items`` (id).
REACHED = """
reached AS (SELECT id AS a, id AS b FROM items UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
roots AS (SELECT a AS id, min(b) AS root FROM reached GROUP BY a)
"""

NGRAM_GROUPS = f"""
WITH RECURSIVE texts AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(greatest(len(w) - {WINDOW - 1}, least(len(w), 1)))) AS i FROM texts),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i + 1:i + {WINDOW}], ' ') AS s FROM places),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
contents AS (SELECT doc_id, n, md5(string_agg(s, '|' ORDER BY s)) AS content FROM shingles JOIN sizes USING (doc_id) GROUP BY doc_id, n),
firsts AS (SELECT content, n, min(doc_id) AS id FROM contents GROUP BY content, n),
items AS (SELECT id FROM firsts),
few AS (SELECT s, doc_id FROM shingles JOIN firsts ON doc_id = id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM few x JOIN few y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN firsts f ON f.id = a JOIN firsts g ON g.id = b WHERE {SHARE[1]} * c >= {SHARE[0]} * (f.n + g.n - c)
),{REACHED}
SELECT doc_id, coalesce(sizes.n, 0) AS n_shingles, coalesce(root, doc_id) AS component_id
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN contents USING (doc_id) LEFT JOIN firsts USING (content) LEFT JOIN roots USING (id)
"""

VECTOR_GROUPS = f"""
WITH RECURSIVE items AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
usable AS (
  SELECT id FROM (SELECT id, unnest(v) AS x FROM items) p GROUP BY id HAVING bool_and(x IS NOT NULL AND isfinite(x)) AND bool_or(x <> 0)
),
good AS (SELECT * FROM items JOIN usable USING (id) WHERE label IS NOT NULL),
links AS (
  SELECT x.id AS a, y.id AS b FROM good x JOIN good y ON x.label = y.label AND x.id <> y.id AND len(x.v) = len(y.v) WHERE list_cosine_similarity(x.v, y.v) >= {THRESHOLD}
),{REACHED},
counts AS (SELECT a AS id, count(*) AS n FROM links GROUP BY a)
SELECT id AS vec_id, coalesce(n, 0) AS n_links, root AS component_id, id = root AS kept FROM items JOIN roots USING (id) LEFT JOIN counts USING (id)
"""

EXACT_DUPLICATES = f"""
WITH hashed AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS text_sha256 FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM hashed WINDOW same AS (PARTITION BY text_sha256)
"""


def clusters_sql() -> str:
    """Lloyd's rounds, one pair of CTEs each, over a long table of components."""
    start = f"""
WITH vectors AS (
  SELECT vec_id, embedding FROM embeddings WHERE len(embedding) = {WIDTH} AND vec_id IN (
    SELECT vec_id FROM (SELECT vec_id, unnest(embedding) AS x FROM embeddings) p GROUP BY vec_id HAVING bool_and(x IS NOT NULL AND isfinite(x))
  )
),
parts AS (
  SELECT vec_id, unnest(generate_series(1, {WIDTH})) AS d, CAST(floor({SCALE} * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x FROM vectors
),
first AS (
  SELECT vec_id, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS cluster FROM vectors
  ORDER BY cluster LIMIT {CLUSTERS}
),
centre0 AS (SELECT cluster, d, x AS c FROM first JOIN parts USING (vec_id))"""
    rounds = ""
    for i in range(ROUNDS + 1):
        rounds += f""",
near{i} AS (
  SELECT vec_id, cluster, distance FROM (
    SELECT vec_id, cluster, distance, row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) AS place FROM (
      SELECT vec_id, cluster, CAST(sum((x - c) * (x - c)) AS BIGINT) AS distance FROM parts JOIN centre{i} USING (d) GROUP BY ALL
    )
  ) WHERE place = 1
)"""
        if i < ROUNDS:
            rounds += f""",
centre{i + 1} AS (
  SELECT cluster, d, coalesce((s - ((s % n) + n) % n) // n, c) AS c FROM centre{i} LEFT JOIN (
    SELECT cluster, d, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM parts JOIN near{i} USING (vec_id) GROUP BY ALL
  ) USING (cluster, d)
)"""
    return f"""{start}{rounds},
digests AS (SELECT cluster, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM centre{ROUNDS} GROUP BY cluster)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM near{ROUNDS} JOIN digests USING (cluster)
"""


ORACLES = {
    "op1_warc": REVISITS,
    "op4_ngram_join": NGRAM_GROUPS,
    "op9_cap_filters": VECTOR_GROUPS,
    "op11_digest_runs": EXACT_DUPLICATES,
    "op13_subvector_clusters": clusters_sql(),
}
