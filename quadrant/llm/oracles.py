"""DuckDB SQL of the opN queries that SQL can express."""

from __future__ import annotations

_BLANK = "' ' || chr(9) || chr(11) || chr(12) || chr(13)"

ORACLE: dict[str, str] = {}

ORACLE["op4_line_dedup"] = f"""
WITH parts AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS arr FROM documents),
ln AS (SELECT doc_id, source, generate_subscripts(arr, 1) AS pos, unnest(arr) AS line FROM parts),
tr AS (SELECT doc_id, source, pos, line, trim(line, {_BLANK}) AS t FROM ln),
wide AS (SELECT t, min((doc_id * 1000000 + pos)) AS first FROM tr WHERE t <> ''
         GROUP BY t HAVING count(DISTINCT source) >= 10),
flag AS (SELECT tr.doc_id, tr.pos, tr.line, wide.t IS NOT NULL AND tr.doc_id * 1000000 + tr.pos <> wide.first AS gone
         FROM tr LEFT JOIN wide ON tr.t = wide.t)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text,
       count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed
FROM flag GROUP BY doc_id
"""

ORACLE["op10_mix"] = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                  md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k FROM documents),
s AS (SELECT source, CAST(sum(size) AS DOUBLE) AS source_size,
             [3.0, 1.0, 2.0][1 + CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER)]::DOUBLE AS w
      FROM d GROUP BY source),
c AS (SELECT *, 2.0 * source_size / w AS ratio, 1.5 * sum(source_size) OVER () AS total, sum(w) OVER () AS w_all FROM s),
p AS (SELECT *, ratio <= (total - coalesce(sum(2.0 * source_size) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / (w_all - coalesce(sum(w) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS full_
      FROM c),
t AS (SELECT source, source_size, CAST(CASE WHEN full_ THEN 2.0 * source_size
             ELSE (total - coalesce(sum(CASE WHEN full_ THEN 2.0 * source_size END) OVER (), 0)) * w
                  / (w_all - coalesce(sum(CASE WHEN full_ THEN w END) OVER (), 0)) END AS DOUBLE) AS target FROM p),
u AS (SELECT *, CASE WHEN source_size > 0 THEN floor(floor(target) / source_size) ELSE 0 END AS epochs FROM t),
r AS (SELECT d.doc_id, d.source, d.size, u.source_size, u.target, u.epochs, floor(u.target) - u.epochs * u.source_size AS rest,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id ROWS UNBOUNDED PRECEDING) - d.size AS before
      FROM d JOIN u ON d.source IS NOT DISTINCT FROM u.source)
SELECT doc_id, source, size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(epochs * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken FROM r
"""

ORACLE["op6_nearest"] = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""
