"""DuckDB oracle building blocks: the adapters of FIXTURES part B written as
plain SQL CTEs, independently of the Spark plans."""

from __future__ import annotations

from quadrant.functions import constants as K

ORACLE: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLE[name] = sql.strip()


def with_(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + body


NL = "chr(10)"

CAT = f"""
cat0 AS (
  SELECT doc_id, text, lang, source,
         CASE WHEN doc_id % 10 = 9 THEN doc_id - 1 ELSE doc_id END AS mnum,
         split_part(text, {NL}, 1) AS first_line,
         list_filter(regexp_split_to_array(text, '[ \n]+'), lambda x: x <> '') AS words
  FROM documents
),
cat AS (
  SELECT doc_id AS ord, doc_id,
         'http://example.org/doc/' || CAST(mnum AS VARCHAR) AS media,
         'http://example.org/seg/' || CAST(doc_id AS VARCHAR) AS media_seg,
         'http://example.org/layer/' || CAST(mnum AS VARCHAR) AS layer,
         'http://example.org/doc/' || CAST(mnum AS VARCHAR) || '/instance' AS instance,
         CASE WHEN doc_id % 3 = 0 THEN '{K.CORE_TEMPORAL_DOCUMENT}' ELSE '{K.CORE_TEXT}' END AS media_type,
         lang || ' ' || source AS label, lang, source,
         text || ' | ' || source || ' | ' || source AS presentation,
         list_min(words) AS k1, list_max(words) AS k2, words[-1] AS k3,
         CASE WHEN doc_id % 7 = 0 THEN 'editor' ELSE 'harvester' END AS last_user,
         CAST(DATE '2024-01-01' + CAST(doc_id % 60 AS INTEGER) AS DATE) AS created,
         first_line AS title, lang AS title_lang,
         'Programme ' || source AS title2,
         'http://example.org/doc/' || CAST(mnum AS VARCHAR) || '/document' AS url
  FROM cat0
)"""


def _quad(s, p, o, g, kind, dt="NULL", lang="NULL", where=""):
    w = f" WHERE {where}" if where else ""
    return (f"SELECT {s} AS s, '{p}' AS p, {o} AS o, {g} AS g, '{kind}' AS o_kind, "
            f"CAST({dt} AS VARCHAR) AS o_datatype, CAST({lang} AS VARCHAR) AS o_lang FROM cat{w}")


QUADS = "quads0 AS (\n" + "\nUNION ALL\n".join([
    _quad("media", K.RDF_TYPE, "media_type", "media", "uri"),
    _quad("layer", K.CORE_DOCUMENT, "media", "layer", "uri"),
    _quad("layer", K.CORE_SEGMENT, "media_seg", "layer", "uri"),
    _quad("media_seg", K.RDFS_LABEL, "label", "media_seg", "literal"),
    _quad("media_seg", K.RDFS_LABEL, "lang", "media_seg", "literal", where="doc_id % 5 = 0"),
    _quad("media_seg", K.DC_DESCRIPTION, "presentation", "media_seg", "literal"),
    _quad("media_seg", K.DC_SUBJECT, "k1", "media_seg", "literal", where="doc_id % 11 <> 0"),
    _quad("media_seg", K.DC_SUBJECT, "k2", "media_seg", "literal", where="doc_id % 11 <> 0"),
    _quad("media_seg", K.DC_SUBJECT, "k3", "media_seg", "literal", where="doc_id % 11 <> 0"),
    _quad("media_seg", K.CORE_CREATION_DATE, "CAST(created AS VARCHAR)", "media_seg", "literal"),
    _quad("media_seg", K.CORE_LAST_USER, f"'{K.USER}' || last_user", "media_seg", "uri"),
    _quad("media_seg", K.DC_TITLE, "title", "media_seg", "literal", lang="title_lang"),
    _quad("media_seg", K.DC_TITLE2, "title2", "media_seg", "literal"),
    _quad("media", K.CORE_INSTANCE, "instance", "media", "uri"),
    _quad("instance", K.CORE_HTTP_URL, "url", "media", "literal"),
]) + "\n),\nquads AS (SELECT DISTINCT * FROM quads0 WHERE o IS NOT NULL AND o <> '')"

SEG = """
seg0 AS (
  SELECT conv_id, turn, role, trim(replace(text, chr(10), ' ')) AS text FROM conversations
),
seg1 AS (
  SELECT *, CAST(length(text) AS BIGINT) AS len,
         CAST(SUM(CAST(length(text) AS BIGINT) * 40) OVER (
              PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS end_ms
  FROM seg0
),
seg AS (
  SELECT turn AS ord, conv_id, turn, role,
         'hal-' || lpad(CAST(conv_id AS VARCHAR), 8, '0') AS mkey,
         CASE WHEN conv_id % 4 <> 0
              THEN 'http://example.org/asa#oai:HAL:hal-' || lpad(CAST(conv_id AS VARCHAR), 8, '0') || 'v1'
              ELSE 'https://api.nakala.example/data/10.34847/nkl.' || CAST(conv_id AS VARCHAR) END AS media,
         end_ms - len * 40 AS start_ms, end_ms,
         CAST((end_ms - len * 40) // 1000 AS VARCHAR) || '.' || lpad(CAST((end_ms - len * 40) % 1000 AS VARCHAR), 3, '0') AS start_raw,
         CAST(end_ms // 1000 AS VARCHAR) || '.' || lpad(CAST(end_ms % 1000 AS VARCHAR), 3, '0') AS end_raw,
         text,
         CASE WHEN role = 'system' THEN NULL ELSE CAST(len % 100 AS DOUBLE) / 100 END AS confidence
  FROM seg1
)"""

LINES = """
lines AS (
  SELECT mkey AS file, turn AS line_no,
         start_raw || '-' || end_raw || ' : ' || CASE WHEN turn % 3 = 2 THEN '' ELSE text END AS line
  FROM seg
)"""

VOCAB = """
vbase AS (
  SELECT item_id,
         split_part(text, ' ', 1) || ' ' || split_part(text, ' ', 2) AS strLabel,
         'class' || CAST(item_id % 5 AS VARCHAR) AS subclass,
         'urn:e:' || CAST(item_id AS VARCHAR) AS entity,
         'urn:c:' || CAST(item_id % 5 AS VARCHAR) AS uriclass,
         'list' || CAST(item_id % 3 AS VARCHAR) AS list_name
  FROM benchmark
),
vocab_raw AS (
  SELECT item_id AS ord, strLabel, subclass, entity, uriclass, list_name FROM vbase
  UNION ALL
  SELECT item_id + 1000000, strLabel, subclass, entity || ':copy', uriclass, list_name FROM vbase WHERE item_id < 5
  UNION ALL
  SELECT item_id + 2000000, strLabel, subclass, entity, uriclass, list_name FROM vbase WHERE item_id % 10 = 7
),
vocab AS (
  SELECT min(ord) AS ord, strLabel, subclass, entity, uriclass, list_name,
         strLabel || '(' || subclass || ')' AS vocas
  FROM vocab_raw GROUP BY strLabel, subclass, entity, uriclass, list_name
),
vpos AS (
  SELECT *, row_number() OVER (ORDER BY ord) - 1 AS pos FROM vocab
),
vchunk AS (
  SELECT *, CAST(pos // 27 AS BIGINT) AS chunk_id, CAST(pos % 27 AS BIGINT) AS pos_in_chunk FROM vpos
)"""

TITLES = f"""
titles AS (
  SELECT doc_id AS line_no, split_part(text, {NL}, 1) AS title FROM documents WHERE lang IN ('fr', 'en')
)"""

DOC_TEXTS = """
dtexts AS (
  SELECT 'http://example.org/seg/' || CAST(doc_id AS VARCHAR) AS media_seg, text FROM documents
)"""


def pat(name: str, p: str, s_as: str, o_as: str | None = None, o_value: str | None = None,
        lang: str | None = None) -> str:
    """One triple pattern as a CTE over `quads`."""
    cols = f"s AS {s_as}" + (f", o AS {o_as}" if o_as else "")
    cond = f"p = '{p}'"
    if o_value is not None:
        cond += f" AND o = '{o_value}'"
    if lang is not None:
        cond += f" AND o_lang = '{lang}'"
    return f"{name} AS (SELECT {cols} FROM quads WHERE {cond})"
