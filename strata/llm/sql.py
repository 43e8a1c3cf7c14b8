"""DuckDB SQL for the rows of operators that SQL can state, for an independent engine."""

from __future__ import annotations

# Fixed value: a word of the contracts.
_WORDS = r"'[^\x20\x09-\x0D]+'"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Every node's smallest node that links lead to, itself included; ``linked`` has both directions.
_COMPONENTS = """
     reached AS (SELECT id AS a, id AS b FROM nodes UNION SELECT reached.a, linked.b FROM reached JOIN linked ON reached.b = linked.a),
     component AS (SELECT a AS id, min(b) AS component_id FROM reached GROUP BY a)"""

SUBSTRINGS = f"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS w FROM documents),
     windows AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s
                 FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM docs WHERE len(w) >= 13)),
     least AS (SELECT s, min(doc_id) AS first FROM windows GROUP BY s),
     gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM windows JOIN least USING (s) WHERE first < doc_id),
     word AS (SELECT doc_id, unnest(w) AS x, CAST(generate_subscripts(w, 1) AS BIGINT) AS p FROM docs),
     kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT docs.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM docs LEFT JOIN kept ON docs.doc_id = kept.doc_id
"""

JACCARD = f"""
WITH RECURSIVE docs AS (SELECT doc_id AS id, regexp_extract_all({_LOWER}, {_WORDS}) AS w FROM documents),
     shingles AS (SELECT DISTINCT id, array_to_string(w[i:i + 4], ' ') AS s
                  FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM docs WHERE len(w) > 0)),
     nodes AS (SELECT docs.id, count(s) AS n FROM docs LEFT JOIN shingles ON docs.id = shingles.id GROUP BY docs.id),
     shared AS (SELECT x.id AS a, y.id AS b, count(*) AS n FROM shingles x JOIN shingles y ON x.s = y.s AND x.id <> y.id
                GROUP BY x.id, y.id),
     linked AS (SELECT shared.a, shared.b FROM shared JOIN nodes x ON x.id = shared.a JOIN nodes y ON y.id = shared.b
                WHERE 100 * shared.n >= 80 * (x.n + y.n - shared.n)),{_COMPONENTS}
SELECT nodes.id AS doc_id, nodes.n AS n_shingles, component_id FROM nodes JOIN component USING (id)
"""

LINES = f"""
WITH cells AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
     line AS (SELECT doc_id, x, k, len(regexp_extract_all(x, {_WORDS})) AS n
              FROM (SELECT doc_id, unnest(l) AS x, CAST(generate_subscripts(l, 1) AS BIGINT) AS k FROM cells)),
     worded AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS p,
                       lead(x) OVER (PARTITION BY doc_id ORDER BY k) AS y FROM line WHERE n > 0),
     alone AS (SELECT x, min((doc_id, p)) AS first, count(DISTINCT doc_id) AS holders FROM worded GROUP BY x),
     pairs AS (SELECT x, y, min((doc_id, p)) AS first FROM worded WHERE y IS NOT NULL GROUP BY x, y),
     gone AS (SELECT doc_id, p FROM worded JOIN alone USING (x)
              WHERE first < (doc_id, p) AND (n >= 20 OR (n >= 3 AND n * holders >= 60))
              UNION SELECT doc_id, unnest([p, p + 1]) FROM worded JOIN pairs USING (x, y) WHERE first < (doc_id, p)),
     marked AS (SELECT line.doc_id, line.x, line.k, worded.p, gone.p IS NOT NULL AS removed
                FROM line LEFT JOIN worded USING (doc_id, k) LEFT JOIN gone ON gone.doc_id = line.doc_id AND gone.p = worded.p),
     kept AS (SELECT doc_id, string_agg(x, chr(10) ORDER BY k) AS t FROM marked WHERE NOT removed GROUP BY doc_id),
     runs AS (SELECT doc_id, count(*) AS n FROM (SELECT doc_id, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS run FROM gone)
              GROUP BY doc_id, run),
     longest AS (SELECT doc_id, max(n) AS n, CAST(sum(n) AS BIGINT) AS removed FROM runs GROUP BY doc_id),
     counts AS (SELECT doc_id, count(*) AS n FROM worded GROUP BY doc_id)
SELECT cells.doc_id, coalesce(counts.n, 0) AS n_lines, coalesce(longest.removed, 0) AS n_removed,
       coalesce(longest.n, 0) AS longest_run, sha256(coalesce(t, '')) AS kept_sha256
FROM cells LEFT JOIN counts USING (doc_id) LEFT JOIN longest USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

VECTORS = f"""
WITH RECURSIVE vectors AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
     nodes AS (SELECT id FROM vectors),
     good AS (SELECT * FROM vectors WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND list_aggregate(list_transform(v, lambda x: abs(x)), 'sum') > 0),
     linked AS (SELECT x.id AS a, y.id AS b FROM good x JOIN good y ON x.id <> y.id AND len(x.v) = len(y.v)
                WHERE list_cosine_similarity(x.v, y.v) >= 0.9),
     degree AS (SELECT a AS id, count(*) AS n FROM linked GROUP BY a),{_COMPONENTS}
SELECT id AS vec_id, coalesce(degree.n, 0) AS n_links, component_id, component_id = id AS kept
FROM nodes JOIN component USING (id) LEFT JOIN degree USING (id)
"""
