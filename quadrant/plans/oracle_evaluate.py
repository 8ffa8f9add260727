"""DuckDB oracles for the evaluation queries."""

from __future__ import annotations

from quadrant.plans.oracle_base import oracle, with_

HUMAN = """
human AS (
  SELECT doc_id AS unit, 'quality' AS label, CAST(quality AS BIGINT) AS value FROM labels
  UNION ALL
  SELECT doc_id, 'safe', CAST(1 - toxic AS BIGINT) FROM labels
),
model AS (
  SELECT doc_id AS unit, 'quality' AS label, CAST(n_chars > 1000 AS BIGINT) AS value FROM documents WHERE doc_id % 3 <> 0
  UNION ALL
  SELECT doc_id, 'safe', CAST(n_chars <= 3000 AS BIGINT) FROM documents WHERE doc_id % 4 <> 0
),
scored AS (
  SELECT h.unit, h.label, h.value AS t, coalesce(m.value, 0) AS p
  FROM human h LEFT JOIN model m ON m.unit = h.unit AND m.label = h.label
  UNION ALL
  SELECT m.unit, m.label, 0, m.value FROM model m
  WHERE m.unit IN (SELECT unit FROM human) AND NOT EXISTS (SELECT 1 FROM human h WHERE h.unit = m.unit AND h.label = m.label)
),
pairs AS (
  SELECT h.unit, h.label, h.value AS t, m.value AS p FROM human h JOIN model m ON m.unit = h.unit AND m.label = h.label
)"""

RATERS = """
raters AS (
  SELECT l.doc_id AS unit, 'quality' AS rater, CAST(l.quality AS BIGINT) AS value FROM labels l JOIN documents d ON d.doc_id = l.doc_id
  UNION ALL
  SELECT l.doc_id, 'safe', CAST(1 - l.toxic AS BIGINT) FROM labels l JOIN documents d ON d.doc_id = l.doc_id
  UNION ALL
  SELECT l.doc_id, 'length', CAST(d.n_chars > 1000 AS BIGINT) FROM labels l JOIN documents d ON d.doc_id = l.doc_id
  WHERE l.doc_id % 3 <> 0
)"""


def _alpha(name: str, where: str) -> str:
    base = f"SELECT unit, value FROM raters WHERE {where}"
    return f"""
SELECT '{name}' AS raters, round(1 - d_o / ((nn * nn - sc) / (nn - 1)), 6) AS alpha, n_units, nn AS n_values FROM (
  SELECT sum((m * m - s2) / (m - 1)) AS d_o, CAST(sum(m) AS BIGINT) AS nn, CAST(count(*) AS BIGINT) AS n_units,
         (SELECT sum(c * c) FROM (SELECT count(*) AS c FROM ({base}) b
                                  WHERE unit IN (SELECT unit FROM ({base}) x GROUP BY unit HAVING count(*) >= 2)
                                  GROUP BY value)) AS sc
  FROM (SELECT unit, sum(n) AS m, sum(n * n) AS s2 FROM (SELECT unit, value, count(*) AS n FROM ({base}) y GROUP BY unit, value)
        GROUP BY unit HAVING sum(n) >= 2)
)"""


oracle("corpus_split", """
SELECT d.doc_id, CASE WHEN d.doc_id % 10 = 9 THEN 'test' WHEN d.doc_id % 10 = 8 THEN 'dev' ELSE 'train' END AS split,
       d.lang, d.n_chars, CAST(l.quality AS BIGINT) AS quality, CAST(l.toxic AS BIGINT) AS toxic
FROM documents d JOIN labels l ON l.doc_id = d.doc_id""")

oracle("f1_scores", with_(HUMAN, """
per AS (
  SELECT label, CAST(sum(CASE WHEN t = 1 AND p = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
         CAST(sum(CASE WHEN t = 0 AND p = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
         CAST(sum(CASE WHEN t = 1 AND p = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn
  FROM scored GROUP BY label
),
per2 AS (
  SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
         CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall,
         CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1 FROM per
),
micro AS (SELECT sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn FROM per)""", body="""
SELECT 'label' AS scope, label, tp, fp, fn, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM per2
UNION ALL
SELECT 'micro', NULL, CAST(tp AS BIGINT), CAST(fp AS BIGINT), CAST(fn AS BIGINT),
       round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END, 6),
       round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END, 6),
       round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END, 6) FROM micro
UNION ALL
SELECT 'macro', NULL, CAST(sum(tp) AS BIGINT), CAST(sum(fp) AS BIGINT), CAST(sum(fn) AS BIGINT),
       round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6) FROM per2"""))

oracle("krippendorff_alpha", with_(RATERS, """
raters2 AS (
  SELECT unit, 'quality' AS rater, value FROM raters WHERE rater = 'quality'
  UNION ALL
  SELECT unit, 'quality_copy', value FROM raters WHERE rater = 'quality'
)""", body=" UNION ALL ".join([
    _alpha("all", "rater IN ('quality', 'safe', 'length')"),
    _alpha("quality_length", "rater IN ('quality', 'length')"),
    _alpha("quality_safe", "rater IN ('quality', 'safe')"),
    _alpha("identical", "TRUE").replace("FROM raters", "FROM raters2"),
])))

oracle("confusion_matrix", with_(HUMAN, body="""
SELECT label, CAST(t AS BIGINT) AS truth, CAST(sum(CASE WHEN p = 0 THEN 1 ELSE 0 END) AS BIGINT) AS pred_0,
       CAST(sum(CASE WHEN p = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pred_1
FROM pairs GROUP BY label, t"""))
