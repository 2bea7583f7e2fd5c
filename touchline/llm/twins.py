"""The results of near-duplicate classes and benchmark leaks once more, as DuckDB SQL written from their definitions."""

from __future__ import annotations

#: Exact Jaccard similarity of all pairs of texts that share a shingle; components by spreading the least number.
NEAR_DEDUP = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, coalesce(text, '') AS text, dense_rank() OVER (ORDER BY coalesce(text, '')) AS node FROM documents
), w AS (
    SELECT node, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM (SELECT DISTINCT node, text FROM d)
), s AS (
    SELECT DISTINCT node, unnest(CASE WHEN len(w) < 5 THEN CASE WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS shingle
    FROM w
), n AS (
    SELECT node, count(*) AS size FROM s GROUP BY node
), shared AS (
    SELECT a.node AS x, b.node AS y, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.node < b.node GROUP BY ALL
), link AS (
    SELECT x, y FROM shared JOIN n i ON i.node = x JOIN n j ON j.node = y WHERE common >= 0.8 * (i.size + j.size - common) - 1e-9
), edge AS (
    SELECT x, y FROM link UNION SELECT y, x FROM link
), reach AS (
    SELECT node, node AS root FROM n
    UNION SELECT e.y, r.root FROM reach r JOIN edge e ON e.x = r.node
), root AS (
    SELECT node, min(root) AS root FROM reach GROUP BY node
), placed AS (
    SELECT doc_id, coalesce(root.root, d.node) AS root FROM d LEFT JOIN root USING (node)
)
SELECT doc_id, min(doc_id) OVER c AS class_id, count(*) OVER c AS class_rows, doc_id = min(doc_id) OVER c AS kept
FROM placed WINDOW c AS (PARTITION BY root)
"""

#: All diagonals of all texts and items; the best stretch of 13 aligned tokens, or of the item if it is shorter.
DECONTAMINATE = r"""
WITH d AS (
    SELECT doc_id, dense_rank() OVER (ORDER BY coalesce(text, '')) AS node, regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+') AS w FROM documents
), i AS (
    SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark
), dt AS (
    SELECT node, unnest(w) AS token, generate_subscripts(w, 1) - 1 AS p FROM (SELECT DISTINCT node, w FROM d)
), it AS (
    SELECT item_id, len(w) AS length, unnest(w) AS token, generate_subscripts(w, 1) - 1 AS q FROM i WHERE len(w) >= 6
), hit AS (
    SELECT node, item_id, length, p - q AS start, q FROM dt JOIN it USING (token)
), diagonal AS (
    SELECT node, item_id, length, start, count(*) AS matched, list(q ORDER BY q) AS places FROM hit
    GROUP BY ALL HAVING count(*) >= 0.8 * least(length, 13) - 1e-9
), best AS (
    SELECT node, item_id, length, start, matched, least(length, 13) AS stretch,
        list_max(list_transform(range(0, length - least(length, 13) + 1), lambda k: len(list_filter(places, lambda q: q >= k AND q < k + least(length, 13))))) AS most
    FROM diagonal
), top AS (
    SELECT node, item_id, length, most / stretch AS overlap, matched, start FROM best WHERE most / stretch >= 0.8 - 1e-12
    QUALIFY row_number() OVER (PARTITION BY node, item_id ORDER BY most DESC, matched DESC, start) = 1
)
SELECT DISTINCT doc_id, item_id, start::INTEGER AS start, matched::INTEGER AS matched, length::INTEGER AS length, overlap FROM d JOIN top USING (node)
"""
