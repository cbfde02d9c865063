"""Checking SQL (DuckDB's dialect) of the operators that SQL can express; quadratic, for small data."""

from __future__ import annotations

WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"

_REACH = """
reach AS (
    SELECT id AS a, id AS b FROM nodes
    UNION
    SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
),
component AS (SELECT a AS id, min(b) AS component_id FROM reach GROUP BY a)
"""

NEAR_VECTORS = f"""
WITH RECURSIVE fine AS (
    SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
nodes AS (SELECT vec_id AS id FROM embeddings),
links AS (SELECT x.id AS a, y.id AS b FROM fine x JOIN fine y ON x.id <> y.id AND list_cosine_similarity(x.v, y.v) >= 0.9),
n AS (SELECT a AS id, count(*) AS n FROM links GROUP BY a),
{_REACH}
SELECT id AS vec_id, coalesce(n, 0) AS n_links, component_id, id = component_id AS kept
FROM nodes LEFT JOIN n USING (id) JOIN component USING (id)
"""

REPEATED_PASSAGES = f"""
WITH d AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
g AS (
    SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)
),
f AS (SELECT g, min(doc_id) AS first FROM g GROUP BY g),
hit AS (SELECT DISTINCT doc_id, i + unnest(range(0, 13)) AS p FROM g JOIN f USING (g) WHERE first < doc_id),
r AS (SELECT doc_id, count(*) AS n FROM hit GROUP BY doc_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN hit USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

JACCARD_GROUPS = f"""
WITH RECURSIVE d AS (
    SELECT doc_id, {WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
    FROM documents
),
s AS (
    SELECT DISTINCT doc_id, g FROM (
        SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
        UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 4
    )
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n + q.n - c)),
nodes AS (SELECT doc_id AS id FROM d),
{_REACH}
SELECT id AS doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM nodes JOIN component USING (id) LEFT JOIN n ON n.doc_id = id
"""

REPEATED_BYTES = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
g AS (
    SELECT doc_id, i, substr(x, 2 * i - 1, 100) AS g
    FROM (SELECT doc_id, x, unnest(range(1, len(x) // 2 - 48)) AS i FROM d WHERE len(x) >= 100)
),
f AS (SELECT g, min(doc_id) AS first, max(doc_id) AS last FROM g GROUP BY g HAVING first < last),
hit AS (SELECT DISTINCT doc_id, i + unnest(range(0, 50)) AS p FROM g JOIN f USING (g) WHERE first < doc_id),
spans AS (
    SELECT doc_id, count(*) AS n, count(*) FILTER (p - 1 IS DISTINCT FROM before) AS spans
    FROM (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM hit) GROUP BY doc_id
),
bytes AS (SELECT doc_id, unnest(range(1, len(x) // 2 + 1)) AS p, x FROM d),
kept AS (
    SELECT doc_id, string_agg(substr(x, 2 * p - 1, 2), '' ORDER BY p) AS t
    FROM bytes WHERE doc_id IN (SELECT doc_id FROM spans) AND (doc_id, p) NOT IN (SELECT doc_id, p FROM hit) GROUP BY doc_id
)
SELECT doc_id, (len(x) // 2)::BIGINT AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
    sha256(unhex(CASE WHEN n > 0 THEN coalesce(t, '') ELSE x END)) AS kept_sha256
FROM d LEFT JOIN spans USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

FILL_IN_MIDDLE = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
        sha256('42:' || doc_id) AS h
    FROM documents
),
k AS (
    SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3,
        ('0x' || h[25:32])::BIGINT AS h4
    FROM d
),
c AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
            WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM k
),
p AS (
    SELECT *, array_to_string(u[:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix
    FROM c
)
SELECT doc_id, n::BIGINT AS n, form,
    CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM p
"""

_FOLDED = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
BENCHMARK_PASSAGES = f"""
WITH b AS (SELECT item_id, {_FOLDED} AS w FROM benchmark),
g AS (
    SELECT DISTINCT item_id, len(g) AS size, array_to_string(g, ' ') AS g FROM (
        SELECT item_id, w[i:i + 9] AS g FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)
    )
),
d AS (SELECT doc_id, {_FOLDED} AS w FROM documents),
runs AS (
    SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS g
    FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d JOIN (SELECT DISTINCT size FROM g) ON len(w) >= size)
),
hit AS (SELECT doc_id, i, size, item_id FROM runs JOIN g USING (size, g)),
words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, i + unnest(range(0, size)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, list_sort(list_distinct(list(item_id::VARCHAR))) AS items FROM hit GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
    sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
