"""DuckDB oracles for incremental, publish and streaming queries: what a
single full run must produce."""

from __future__ import annotations

from urllib.parse import quote

from quadrant.functions import constants as K
from quadrant.plans.oracle_base import CAT, DOC_TEXTS, SEG, VOCAB, oracle, with_
from quadrant.plans.oracle_catalog import CHUNKS, COLLECT, FIRST_VOCAB, LEX, PARSE, RESOLVED
from quadrant.plans.oracle_transcripts import media_key

oracle("incremental_offset", with_(CAT, body="""
SELECT media_seg,
       label || ' ' || presentation || ' Les mot-clés du texte : ' ||
       (CASE WHEN doc_id % 11 <> 0 THEN k1 || ', ' || k2 || ', ' || k3 END) AS text,
       CAST(CASE WHEN pos < early THEN pos // 500 * 500 ELSE early + (pos - early) // 500 * 500 END AS BIGINT) AS batch_id
FROM (SELECT *, row_number() OVER (ORDER BY ord) - 1 AS pos, count(*) OVER () * 7 // 10 AS early FROM cat)"""))

oracle("incremental_date", """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date, count(*) AS n_events, round(sum(value), 6) AS total_value,
       CASE WHEN CAST(ts AS DATE) <= DATE '2024-01-11' THEN '2024-01-11'
            WHEN CAST(ts AS DATE) <= DATE '2024-01-21' THEN '2024-01-21' ELSE '2024-01-31' END AS run_date
FROM events
WHERE CAST(ts AS DATE) > DATE '2024-01-01' AND CAST(ts AS DATE) <= DATE '2024-01-31'
GROUP BY ALL""")

RECORDS = with_(VOCAB, CHUNKS, DOC_TEXTS, LEX, PARSE, COLLECT, FIRST_VOCAB, RESOLVED, f"""
segs AS (SELECT media_seg, count(*) AS n_labels, CAST(split_part(media_seg, '/', -1) AS BIGINT) AS doc,
                string_agg(DISTINCT '<' || media_seg || '> <' || uriclass || '> <' || entity || '> <' || media_seg || '> .', chr(10)
                           ORDER BY '<' || media_seg || '> <' || uriclass || '> <' || entity || '> <' || media_seg || '> .') AS body
         FROM resolved GROUP BY media_seg),
recs AS (SELECT *, CASE WHEN doc % 10 = 9 THEN doc - 1 ELSE doc END AS m,
                'http://example.org/doc/' || CAST(CASE WHEN doc % 10 = 9 THEN doc - 1 ELSE doc END AS VARCHAR) AS media FROM segs)""",
                body="{body}")
STATUS = "CASE WHEN m % 7 <= 4 THEN 'published' ELSE 'dead' END"
ATTEMPTS = "CASE WHEN m % 7 <= 4 THEN greatest(m % 7, 1) ELSE 4 END"

oracle("publish_with_retry", RECORDS.replace("{body}", f"""
SELECT media, CASE WHEN m % 13 = 0 THEN 'locked' ELSE {STATUS} END AS status,
       CAST(CASE WHEN m % 13 = 0 THEN 0 ELSE {ATTEMPTS} END AS BIGINT) AS attempts,
       'https://store.example.org/api/set_media?uri=' || replace(media, ':', '%3A')
         || '&mimetype=application/pdf&segmenttype={quote(K.CORE_TEXT)}&threshold=0.0&unlock=true' AS request_url,
       md5(string_agg(body, chr(10) ORDER BY body)) AS body_md5, count(*) AS n_requests
FROM recs GROUP BY media, m"""))

oracle("publish_dead_letter", RECORDS.replace("{body}", """
SELECT media, media_seg, CAST(n_labels AS BIGINT) AS n_labels, md5(body) AS body_md5
FROM recs WHERE m % 13 <> 0 AND m % 7 > 4"""))

oracle("stream_publish", RECORDS.replace("{body}", f"""
SELECT DISTINCT media, {STATUS} AS status, CAST({ATTEMPTS} AS BIGINT) AS attempts, CAST(1 AS BIGINT) AS n_batches FROM recs"""))

oracle("stream_ingest", with_(SEG, body=f"""
SELECT {media_key('media')} AS media_key, start_raw, end_raw, start_ms, end_ms, text, confidence FROM seg"""))

oracle("stream_dedupe", with_(CAT, body="""
SELECT ord, media, media_seg, title FROM (
  SELECT ord, media, media_seg, title, row_number() OVER (PARTITION BY media ORDER BY ord) AS rn FROM cat
) WHERE rn = 1"""))

oracle("stream_ingest_archive", with_(SEG, body=f"""
SELECT {media_key('media')} AS media_key, start_raw, end_raw, text, confidence, CAST(0 AS BIGINT) AS n_left FROM seg"""))

oracle("stream_dedupe_state", with_(CAT, body="""
SELECT ord, media, media_seg, title FROM (
  SELECT ord, media, media_seg, title, row_number() OVER (PARTITION BY media ORDER BY ord) AS rn FROM cat
) WHERE rn = 1"""))

oracle("stream_redelivery", with_(SEG, body=f"""
SELECT {media_key('media')} AS media_key, start_raw, end_raw, start_ms, end_ms,
       CASE WHEN conv_id % 3 = 0 THEN 'corrected: ' || text ELSE text END AS text, confidence,
       CAST(CASE WHEN conv_id % 3 = 2 THEN 1 ELSE 2 END AS BIGINT) AS n_versions,
       CAST(CASE WHEN conv_id % 3 = 1 THEN 1 ELSE 0 END AS BIGINT) AS n_rejects FROM seg"""))
