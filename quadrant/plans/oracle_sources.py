"""DuckDB oracles for the source and sink queries (what must come back)."""

from __future__ import annotations

from quadrant.plans.oracle_base import CAT, LINES, QUADS, SEG, VOCAB, ORACLE, oracle, with_
from quadrant.plans.oracle_catalog import GP, INTERVIEWS, TEXT_DOCS
from quadrant.plans.oracle_transcripts import media_key

oracle("src_csv_catalog", with_(CAT, body="""
SELECT c.media, c.title, c.title2, c.url, CAST(c.created AS VARCHAR) AS creationdate,
       d.text AS description
FROM cat c JOIN documents d ON d.doc_id = c.doc_id"""))

oracle("sink_csv", with_(CAT, QUADS, *GP, TEXT_DOCS, body="SELECT * FROM text_docs"))

oracle("src_segments_json", with_(SEG, body=f"""
SELECT {media_key('media')} AS media_key,
       CAST(row_number() OVER (PARTITION BY conv_id ORDER BY start_ms, end_ms, text) - 1 AS BIGINT) AS ord,
       start_raw, end_raw, start_ms, end_ms, text, confidence
FROM seg"""))

oracle("src_segments_rejects", with_(SEG, f"""
m AS (SELECT {media_key('media')} AS media_key, conv_id % 7 AS kind, count(*) AS n FROM seg GROUP BY ALL)""", body="""
SELECT media_key, 'segment' AS reason, n FROM m WHERE kind NOT IN (2, 3, 5)
UNION ALL
SELECT media_key, CASE kind WHEN 2 THEN 'damaged file' WHEN 3 THEN 'no segments' WHEN 4 THEN 'no times' ELSE 'empty file' END AS reason,
       CAST(1 AS BIGINT) AS n FROM m WHERE kind IN (2, 3, 4, 5)"""))

oracle("src_csv_rejects", with_(CAT, body="""
SELECT CASE WHEN ord % 9 NOT IN (4, 5, 7) THEN ord END AS ord, CASE WHEN ord % 9 NOT IN (4, 5, 7) THEN media_seg END AS media_seg,
       CASE WHEN ord % 9 NOT IN (4, 5, 7) THEN title2 END AS title2,
       CASE ord % 9 WHEN 4 THEN ord || ',' || media_seg WHEN 5 THEN 'none,' || media_seg || ',"' || title2 || '"'
                    WHEN 7 THEN ord || ',' || media_seg || ',"' || title2 || '",more' END AS record FROM cat"""))

oracle("src_sparql_rejects", with_(CAT, body="""
SELECT media_seg, title2, 'binding' AS reason, CAST(1 AS BIGINT) AS n FROM cat WHERE ord % 8 NOT IN (1, 2)
UNION ALL
SELECT NULL, NULL, CASE ord % 8 WHEN 1 THEN 'damaged page' ELSE 'no bindings' END, count(*) FROM cat WHERE ord % 8 IN (1, 2) GROUP BY ord % 8"""))

oracle("src_text_lines", with_(SEG, LINES, body="""
SELECT file, CAST(row_number() OVER (PARTITION BY file ORDER BY line_no) - 1 AS BIGINT) AS line_no, line FROM lines"""))

oracle("src_sparql_json", with_(CAT, QUADS, *GP, INTERVIEWS, body="SELECT * FROM interviews"))

oracle("vocab_select", with_(VOCAB, body="""
SELECT min(ord) AS ord, strLabel, subclass, entity, uriclass
FROM vocab_raw WHERE list_name = 'list1' GROUP BY strLabel, subclass, entity, uriclass"""))

oracle("sink_append", with_(CAT, body="""
SELECT ord, media_seg, title, CAST(ord // 500 AS BIGINT) AS batch_id FROM cat"""))


def _nested() -> None:
    from quadrant.plans import oracle_catalog  # noqa: F401 - registers resolve_entities
    ORACLE["sink_nested_json"] = ORACLE["resolve_entities"]


_nested()

