"""DuckDB SQL with the same result as a registered query, where SQL can express it."""

LINE_WINDOWS = """
WITH lines AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
     starts AS (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS pos FROM lines WHERE len(l) >= 3),
     windows AS (SELECT doc_id, pos, l[pos] AS a, l[pos + 1] AS b, l[pos + 2] AS c FROM starts
                 WHERE length(trim(concat(l[pos], l[pos + 1], l[pos + 2]))) > 0),
     ranked AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, pos) AS nth FROM windows),
     covered AS (SELECT DISTINCT doc_id, unnest([pos, pos + 1, pos + 2]) AS pos FROM ranked WHERE nth > 1),
     each_line AS (SELECT doc_id, unnest(range(1, len(l) + 1)) AS pos, unnest(l) AS line FROM lines),
     rest AS (SELECT e.doc_id, string_agg(e.line, chr(10) ORDER BY e.pos) AS text
              FROM each_line e LEFT JOIN covered c ON e.doc_id = c.doc_id AND e.pos = c.pos WHERE c.pos IS NULL GROUP BY e.doc_id),
     gone AS (SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN g.n IS NULL THEN d.text ELSE coalesce(r.text, '') END AS text,
       CASE WHEN coalesce(d.text, '') = '' THEN 0 ELSE CAST(len(d.l) AS BIGINT) END AS n_lines_before,
       CAST(coalesce(g.n, 0) AS BIGINT) AS n_removed
FROM lines d LEFT JOIN gone g ON d.doc_id = g.doc_id LEFT JOIN rest r ON d.doc_id = r.doc_id
"""

NEAR_VECTORS = """
WITH RECURSIVE numbers AS (SELECT vec_id, unnest(range(1, len(embedding) + 1)) AS i, unnest(embedding) AS x FROM embeddings),
     lengths AS (SELECT vec_id, sqrt(sum(CAST(x AS DOUBLE) * CAST(x AS DOUBLE))) AS norm FROM numbers GROUP BY vec_id),
     links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM numbers a JOIN numbers b ON a.i = b.i AND a.vec_id <> b.vec_id
               JOIN lengths n ON n.vec_id = a.vec_id JOIN lengths m ON m.vec_id = b.vec_id
               GROUP BY a.vec_id, b.vec_id, n.norm, m.norm HAVING sum(CAST(a.x AS DOUBLE) * CAST(b.x AS DOUBLE)) / (n.norm * m.norm) >= 0.95),
     reach(vec_id, other) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.other),
     classes AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
     counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN classes c ON c.vec_id = e.vec_id LEFT JOIN counts ON counts.a = e.vec_id
"""

ORACLES = {"op8_near_vectors": NEAR_VECTORS, "op10_line_windows": LINE_WINDOWS}
