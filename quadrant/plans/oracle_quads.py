"""DuckDB oracles for the quad queries."""

from __future__ import annotations

from quadrant.functions import constants as K
from quadrant.plans.oracle_base import CAT, LINES, ORACLE, QUADS, SEG, oracle, with_
from quadrant.plans.oracle_transcripts import w2, x4

COLS = "s, p, o, g, o_kind, o_datatype, o_lang"

SEG_SRC = """
segsrc AS (SELECT media, start_raw, end_raw, text, confidence FROM seg)"""

CORRECTED = """
fixed AS (
  SELECT m.media, w.start AS start_raw, w."end" AS end_raw, w.text, CAST(NULL AS DOUBLE) AS confidence
  FROM w2 w JOIN (SELECT DISTINCT mkey, media FROM seg) m ON m.mkey = w.file
)"""


def doomed(store: str, media: str) -> str:
    return f"""
layers AS (
  SELECT DISTINCT s AS g FROM {store} WHERE p = '{K.CORE_DOCUMENT}' AND o IN (SELECT media FROM {media})
    AND s IN (SELECT s FROM {store} WHERE p = '{K.RDF_TYPE}' AND o = '{K.CORE_ASR_LAYER}')
),
doomed AS (
  SELECT g FROM layers
  UNION
  SELECT o AS g FROM {store} WHERE p = '{K.CORE_SEGMENT}' AND s IN (SELECT g FROM layers)
)"""


oracle("segments_to_quads", with_(SEG, SEG_SRC, x4("segsrc"), body=f"SELECT {COLS} FROM x4"))

oracle("delete_transcription", with_(SEG, SEG_SRC, x4("segsrc"), """
gone AS (SELECT DISTINCT media FROM seg WHERE conv_id % 3 = 0)""", doomed("x4", "gone"), body=f"""
SELECT {COLS} FROM x4 WHERE g NOT IN (SELECT g FROM doomed)"""))

oracle("replace_transcription", with_(SEG, LINES, w2(), CORRECTED, """
newsrc AS (SELECT * FROM fixed WHERE ends_with(media, 'v1'))""", SEG_SRC, x4("segsrc"), x4("newsrc", "nx4"),
    """gone AS (SELECT DISTINCT media FROM newsrc)""", doomed("x4", "gone"), body=f"""
SELECT {COLS} FROM x4 WHERE g NOT IN (SELECT g FROM doomed)
UNION
SELECT {COLS} FROM nx4"""))

oracle("correction_round_trip", with_(SEG, LINES, w2(), CORRECTED, SEG_SRC, x4("segsrc"), x4("fixed", "nx4"),
    """gone AS (SELECT DISTINCT media FROM fixed)""", doomed("x4", "gone"), body=f"""
SELECT {COLS} FROM x4 WHERE g NOT IN (SELECT g FROM doomed)
UNION
SELECT {COLS} FROM nx4"""))


def esc(x: str) -> str:
    return (f"replace(replace(replace(replace({x}, '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n'), "
            f"chr(13), '\\r')")


OBJ = (f"CASE WHEN o_kind = 'uri' THEN '<' || o || '>' ELSE '\"' || {esc('o')} || '\"' || "
       f"CASE WHEN o_datatype IS NOT NULL THEN '^^<' || o_datatype || '>' "
       f"WHEN o_lang IS NOT NULL THEN '@' || o_lang ELSE '' END END")

ALLQ = """
allq AS (SELECT s, p, o, g, o_kind, o_datatype, o_lang FROM quads
         UNION ALL SELECT s, p, o, g, o_kind, o_datatype, o_lang FROM x4)"""

oracle("quads_to_nquads", with_(CAT, QUADS, SEG, SEG_SRC, x4("segsrc"), ALLQ, body=f"""
SELECT '<' || s || '> <' || p || '> ' || {OBJ} || ' <' || g || '> .' AS value FROM allq"""))

oracle("src_nquads", with_(CAT, QUADS, SEG, SEG_SRC, x4("segsrc"), ALLQ, body=f"SELECT {COLS} FROM allq"))

oracle("quads_update_batches", with_(SEG, """
segsrc AS (SELECT conv_id, media, start_raw, end_raw, text, confidence FROM seg)""", x4("segsrc", keep="conv_id, "), """
bq AS (SELECT DISTINCT conv_id % 8 AS bucket, s, p, o, g, o_kind, o_datatype, o_lang FROM x4)""", body=f"""
SELECT bucket, CAST(pos // 500 AS BIGINT) AS batch, count(*) AS n_quads,
       md5('INSERT DATA {{' || string_agg(stmt, ' ' ORDER BY pos) || '}}') AS request_md5
FROM (
  SELECT bucket, row_number() OVER (PARTITION BY bucket ORDER BY g NULLS FIRST, s NULLS FIRST, p NULLS FIRST,
                                     o NULLS FIRST, o_kind NULLS FIRST, o_datatype NULLS FIRST, o_lang NULLS FIRST) - 1 AS pos,
         'GRAPH <' || g || '> {{<' || s || '> <' || p || '> ' || {OBJ} || '}}' AS stmt
  FROM bq
) GROUP BY bucket, pos // 500"""))

ORACLE["deliver_updates"] = ORACLE["quads_update_batches"]
ORACLE["delete_in_place"] = ORACLE["delete_transcription"]
ORACLE["replace_in_place"] = ORACLE["replace_transcription"]


def blank(x: str) -> str:
    return f"CASE WHEN ends_with({x}, '/instance') THEN 'blank i' || regexp_extract({x}, 'doc/([0-9]+)', 1) || '.x' ELSE {x} END AS {x}"


oracle("src_nquads_grammar", with_(CAT, QUADS, body=f"""
SELECT {blank('s')}, p, {blank('o')}, CASE WHEN NOT contains(p, 'title') THEN g END AS g, o_kind, o_datatype, o_lang FROM quads"""))
