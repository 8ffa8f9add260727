"""DuckDB oracles for transcript queries, plus shared SQL for time codes,
media keys, the transcript merge and transcript quads."""

from __future__ import annotations

from quadrant.functions import constants as K
from quadrant.plans.oracle_base import LINES, SEG, oracle, with_


def hh(ms: str) -> str:
    h = f"({ms}) // 3600000"
    return f"(CASE WHEN {h} < 10 THEN '0' || CAST({h} AS VARCHAR) ELSE CAST({h} AS VARCHAR) END)"


def p2(x: str) -> str:
    return f"lpad(CAST({x} AS VARCHAR), 2, '0')"


def p3(x: str) -> str:
    return f"lpad(CAST({x} AS VARCHAR), 3, '0')"


def timecode(ms: str) -> str:
    return (f"'T' || {hh(ms)} || ':' || {p2(f'(({ms}) // 60000) % 60')} || ':' || "
            f"{p2(f'(({ms}) // 1000) % 60')} || ':' || {p3(f'({ms}) % 1000')} || 'F1000'")


def duration(ms: str) -> str:
    return (f"'PT' || CAST(({ms}) // 3600000 AS VARCHAR) || 'H' || CAST((({ms}) // 60000) % 60 AS VARCHAR) || 'M' || "
            f"CAST((({ms}) // 1000) % 60 AS VARCHAR) || 'S' || {p3(f'({ms}) % 1000')} || 'N1000F'")


def srt_stamp(ms: str) -> str:
    return (f"{hh(ms)} || ':' || {p2(f'(({ms}) // 60000) % 60')} || ':' || "
            f"{p2(f'(({ms}) // 1000) % 60')} || ',' || {p3(f'({ms}) % 1000')}")


def to_ms(raw: str) -> str:
    return f"CAST(round(TRY_CAST({raw} AS DOUBLE) * 1000) AS BIGINT)"


def media_key(m: str, keep_version: bool = False) -> str:
    last = f"string_split({m}, ':')[-1]"
    hal = last if keep_version else f"regexp_replace({last}, 'v[0-9]+$', '')"
    nakala = f"array_to_string(string_split({m}, '/')[5:], '.')"
    return f"(CASE WHEN contains({m}, 'nakala') THEN {nakala} WHEN contains({m}, 'hal') THEN {hal} END)"


TCAT = """
convs AS (SELECT DISTINCT conv_id FROM conversations),
tcat AS (
  SELECT conv_id AS ord,
         CASE WHEN conv_id % 4 <> 0
              THEN 'http://example.org/asa#oai:HAL:hal-' || lpad(CAST(conv_id AS VARCHAR), 8, '0')
                   || CASE WHEN conv_id % 6 = 1 THEN 'v2' ELSE 'v1' END
              ELSE 'https://api.nakala.example/data/10.34847/nkl.' || CAST(conv_id AS VARCHAR) END AS media,
         'entretien avec Speaker ' || CAST(conv_id % 40 AS VARCHAR) || ' (entretien ' || CAST(conv_id AS VARCHAR) || ')' AS title
  FROM convs
)"""

FILE_KEYS = f"""
file_keys AS (
  SELECT DISTINCT {media_key('media')} AS file_key FROM seg WHERE conv_id % 5 <> 0
)"""

TXT_NAMES = """
txt_names AS (
  SELECT CASE WHEN conv_id % 5 = 0
              THEN 'export__.hal-' || lpad(CAST(conv_id AS VARCHAR), 8, '0') || 'v1.lintoai.txt'
              ELSE 'entretien avec Speaker ' || CAST(conv_id % 45 AS VARCHAR) || ' (revu ' || CAST(conv_id AS VARCHAR) || ').txt'
         END AS txtname
  FROM convs
)"""

LINE_RE = "^([^-:]*)-([^-:]*)[^:]*:(.*)$"


def w2(lines_cte: str = "lines", name: str = "w2") -> str:
    """The transcript merge as CTEs over (file, line_no, line)."""
    return f"""
{name}_c AS (
  SELECT file, line_no, trim(line) AS st, regexp_matches(trim(line), '{LINE_RE}') AS ok,
         trim(regexp_extract(trim(line), '{LINE_RE}', 3)) AS body
  FROM {lines_cte}
),
{name}_k AS (
  SELECT file, line_no,
         CASE WHEN st = '' THEN 'cont' WHEN ok AND body <> '' THEN 'text' WHEN ok THEN 'cont' ELSE 'noise' END AS kind,
         CASE WHEN ok THEN trim(regexp_extract(st, '{LINE_RE}', 1)) END AS start,
         CASE WHEN ok THEN trim(regexp_extract(st, '{LINE_RE}', 2)) ELSE '' END AS e,
         CASE WHEN ok THEN body END AS text
  FROM {name}_c
),
{name}_i AS (
  SELECT *, max(CASE WHEN kind <> 'cont' THEN line_no END)
              OVER (PARTITION BY file ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island
  FROM {name}_k
),
{name} AS (
  SELECT h.file, h.line_no AS head_line_no, h.start, coalesce(x.last_end, '') AS "end", h.text
  FROM {name}_i h
  LEFT JOIN (SELECT file, island, arg_max(e, line_no) AS last_end FROM {name}_i
             WHERE e <> '' AND island IS NOT NULL GROUP BY file, island) x
    ON x.file = h.file AND x.island = h.line_no
  WHERE h.line_no = h.island AND h.kind = 'text'
)"""


def x4(src: str, name: str = "x4", keep: str = "") -> str:
    """Transcript quads of a (media, start_raw, end_raw, text, confidence) table."""
    layer = f"replace(media, 'media', 'layer') || '{K.ASR_LAYER_SUFFIX}'"
    b, e = to_ms("start_raw"), to_ms("end_raw")

    def q(s, p, o, g, kind, dt=None):
        dts = f"'{dt}'" if dt else "NULL"
        return (f"SELECT {keep}{s} AS s, '{p}' AS p, {o} AS o, {g} AS g, '{kind}' AS o_kind, "
                f"CAST({dts} AS VARCHAR) AS o_datatype, CAST(NULL AS VARCHAR) AS o_lang FROM {name}_t")

    seg_rows = [
        q("layer", K.CORE_SEGMENT, "segu", "layer", "uri"),
        q("segu", K.CORE_BEGIN_TIME, "begin_tc", "segu", "literal"),
        q("segu", K.CORE_BEGIN_TIME_TR, "CAST(begin_tr AS VARCHAR)", "segu", "literal", K.XSD_INTEGER),
        q("segu", K.CORE_END_TIME, "end_tc", "segu", "literal"),
        q("segu", K.CORE_END_TIME_TR, "CAST(end_tr AS VARCHAR)", "segu", "literal", K.XSD_INTEGER),
        q("segu", K.CORE_DURATION, "duration_tc", "segu", "literal"),
        q("segu", K.CORE_DURATION_TR, "CAST(duration_tr AS VARCHAR)", "segu", "literal", K.XSD_INTEGER),
        q("segu", K.RDF_TYPE, f"'{K.CORE_ASR_SEGMENT}'", "segu", "uri"),
        q("segu", K.CORE_TEXT_PROP, "text", "segu", "literal"),
        q("segu", K.CORE_CONFIDENCE, "CAST(confidence AS VARCHAR)", "segu", "literal", K.XSD_FLOAT),
        q("layer", K.RDF_TYPE, f"'{K.CORE_ASR_LAYER}'", "layer", "uri"),
        q("layer", K.RDFS_LABEL, f"'{K.ASR_LAYER_LABEL}'", "layer", "literal"),
        q("layer", K.CORE_DOCUMENT, "media", "layer", "uri"),
    ]
    return f"""
{name}_a AS (
  SELECT {keep}media, start_raw, end_raw, text, confidence, {layer} AS layer, {b} AS begin_tr, {e} AS end_tr FROM {src}
),
{name}_t AS (
  SELECT *, layer || '{K.SEGMENT_URI_INFIX}' || replace(start_raw, '.', '_') AS segu,
         end_tr - begin_tr AS duration_tr,
         {timecode('begin_tr')} AS begin_tc, {timecode('end_tr')} AS end_tc, {duration('end_tr - begin_tr')} AS duration_tc
  FROM {name}_a
),
{name} AS (
  SELECT DISTINCT * FROM ({' UNION ALL '.join(seg_rows)}) WHERE o IS NOT NULL
)"""


oracle("media_key", with_(SEG, TCAT, body=f"""
SELECT media, {media_key('media')} AS media_key, {media_key('media', True)} AS media_key_versioned
FROM (SELECT media FROM seg UNION SELECT media FROM tcat)"""))

oracle("media_with_transcript", with_(SEG, TCAT, FILE_KEYS, body=f"""
SELECT media, {media_key('media')} AS media_key FROM tcat
WHERE {media_key('media')} IN (SELECT file_key FROM file_keys)"""))

oracle("file_to_title", with_(SEG, TCAT, FILE_KEYS, body="""
SELECT f.file_key, t.title, regexp_replace(t.title, '[^\\p{L}\\p{N}_\\s]', '', 'g') AS name
FROM file_keys f
LEFT JOIN (SELECT f2.file_key, arg_min(c.title, c.ord) AS title
           FROM file_keys f2 JOIN tcat c ON contains(c.media, f2.file_key) GROUP BY f2.file_key) t
  ON t.file_key = f.file_key"""))

oracle("name_to_media", with_(TCAT, TXT_NAMES, body="""
SELECT n.txtname,
       CASE WHEN contains(n.txtname, 'lintoai')
            THEN left(split_part(n.txtname, '__.', 2), length(split_part(n.txtname, '__.', 2)) - 3) || 'json'
            ELSE coalesce(b.k, 'No match found') || '.lintoai.json' END AS jsonname
FROM txt_names n
LEFT JOIN (
  SELECT txtname, arg_min(k, (NOT ends_with(k, 'v2'), ord)) AS k FROM (
    SELECT n2.txtname, c.ord, string_split(c.media, ':')[-1] AS k
    FROM txt_names n2 JOIN tcat c
      ON contains(lower(c.title), lower(split_part(split_part(n2.txtname, 'entretien avec ', 2), '(', 1)))
    WHERE NOT contains(n2.txtname, 'lintoai')
  ) GROUP BY txtname
) b ON b.txtname = n.txtname"""))

oracle("segment_timecodes", with_(SEG, body=f"""
SELECT conv_id, turn, {timecode(to_ms('start_raw'))} AS begin_tc, {timecode(to_ms('end_raw'))} AS end_tc,
       {duration(to_ms('end_raw') + ' - ' + to_ms('start_raw'))} AS duration_tc,
       {to_ms('start_raw')} AS begin_tr, {to_ms('end_raw')} AS end_tr,
       {to_ms('end_raw')} - {to_ms('start_raw')} AS duration_tr
FROM seg"""))

oracle("coalesce_transcript", with_(SEG, LINES, w2(), body="SELECT * FROM w2"))

SEG_KEYED = f"""
segk AS (SELECT *, {media_key('media')} AS media_key FROM seg)"""

oracle("transcript_txt", with_(SEG, SEG_KEYED, body="""
SELECT media_key, CAST(row_number() OVER (PARTITION BY media_key ORDER BY start_ms, end_ms, ord) - 1 AS BIGINT) AS line_no,
       start_raw || '-' || end_raw || ' : ' || text AS line
FROM segk"""))

oracle("transcript_srt", with_(SEG, SEG_KEYED, f"""
cues AS (
  SELECT media_key, row_number() OVER (PARTITION BY media_key ORDER BY start_ms, end_ms, ord) AS cue,
         {srt_stamp('start_ms')} || ' --> ' || {srt_stamp('end_ms')} AS stamps, text
  FROM segk
)""", body="""
SELECT media_key, CAST((cue - 1) * 4 + k AS BIGINT) AS line_no,
       CASE k WHEN 0 THEN CAST(cue AS VARCHAR) WHEN 1 THEN stamps WHEN 2 THEN text ELSE '' END AS line
FROM cues, range(0, 4) r(k)"""))

oracle("layer_stats", with_(SEG, body="""
SELECT media, count(*) AS n_segments, CAST(sum(end_ms - start_ms) AS BIGINT) AS total_ms,
       min(start_ms) AS first_ms, max(end_ms) AS last_ms, count(*) - count(DISTINCT start_raw) AS shared_starts
FROM seg GROUP BY media"""))


oracle("src_media_ranges", with_(SEG, f"""
files AS (
  SELECT {media_key('media')} AS media_key,
         hex(encode(string_agg(text || '.' || chr(10), '' ORDER BY start_ms, end_ms, ord))) AS bytes
  FROM seg GROUP BY ALL
),
ranges AS (
  SELECT media_key, bytes, CAST(length(bytes) // 2 AS BIGINT) AS length,
         unnest(range(0, (length(bytes) // 2 + 1023) // 1024)) AS range_no
  FROM files
)""", body="""
SELECT media_key, length, CAST(range_no AS BIGINT) AS range_no, CAST(range_no * 1024 AS BIGINT) AS start,
       CAST(least(1024, length - range_no * 1024) AS BIGINT) AS n_bytes,
       md5(substr(bytes, CAST(range_no * 2048 + 1 AS BIGINT), 2048)) AS digest
FROM ranges"""))
