"""DuckDB oracles for the catalogue, text-preparation and labelling queries."""

from __future__ import annotations

from quadrant.functions import constants as K
from quadrant.plans.oracle_base import (CAT, DOC_TEXTS, QUADS, TITLES, VOCAB, oracle, pat,
                                        with_)

# ------------------------------------------------------------ vocabulary
oracle("vocab_dedupe", with_(VOCAB, body="SELECT ord, strLabel, subclass, entity, uriclass, list_name FROM vocab"))
oracle("vocab_qualified", with_(VOCAB, body="SELECT ord, strLabel, subclass, vocas FROM vocab"))
oracle("vocab_chunks", with_(VOCAB, body="SELECT ord, vocas, chunk_id, pos_in_chunk FROM vchunk"))

# ------------------------------------------------------------ text prep
oracle("classification_text", with_(CAT, body=f"""
SELECT media_seg,
       label || ' ' || presentation || '{K.KEYWORD_MARKER}' ||
       (CASE WHEN doc_id % 11 <> 0 THEN k1 || ', ' || k2 || ', ' || k3 END) AS text
FROM cat"""))

DEDUP_PRES = """
pres AS (
  SELECT media, media_seg,
         array_to_string(list_filter(string_split(presentation, ' | '),
                         lambda x, i: list_position(string_split(presentation, ' | '), x) = i), ' | ') AS presentation
  FROM cat
)"""
oracle("merge_presentations", with_(CAT, DEDUP_PRES, body="""
SELECT p.media, p.media_seg, m.merged AS presentation
FROM pres p JOIN (SELECT media, string_agg(DISTINCT presentation, ' | ' ORDER BY presentation) AS merged
                  FROM pres GROUP BY media) m ON p.media = m.media"""))

oracle("dedupe_keep_first", with_(CAT, body="""
SELECT ord, media, media_seg, title FROM (
  SELECT ord, media, media_seg, title, row_number() OVER (PARTITION BY media ORDER BY ord) AS rn FROM cat
) WHERE rn = 1"""))

oracle("catalog_from_uris", """
SELECT 'https://hal.example.org/hal-' || lpad(CAST(doc_id AS VARCHAR), 8, '0') AS uri_s,
       'https://hal.example.org/hal-' || lpad(CAST(doc_id AS VARCHAR), 8, '0') || '/document' AS url,
       ':hal-' || lpad(CAST(doc_id AS VARCHAR), 8, '0') || 'v1' AS media
FROM documents""")

# ------------------------------------------------------------ graph patterns
GP = [
    pat("doc", K.CORE_DOCUMENT, "layer", "media"),
    pat("segl", K.CORE_SEGMENT, "layer", "media_seg"),
    pat("inst", K.CORE_INSTANCE, "media", "instance"),
    pat("urls", K.CORE_HTTP_URL, "instance", "url"),
    pat("labs", K.RDFS_LABEL, "media_seg", "lab1"),
    pat("cds", K.CORE_CREATION_DATE, "media_seg", "creation_date"),
    pat("pres", K.DC_DESCRIPTION, "media_seg", "presentation"),
    pat("kws", K.DC_SUBJECT, "media_seg", "keyword"),
    pat("titl", K.DC_TITLE, "media_seg", "title"),
    pat("titl2", K.DC_TITLE2, "media_seg", "title2"),
    pat("harv", K.CORE_LAST_USER, "media_seg", o_value=K.HARVESTER),
    pat("is_text", K.RDF_TYPE, "media", o_value=K.CORE_TEXT),
    pat("is_temporal", K.RDF_TYPE, "media", o_value=K.CORE_TEMPORAL_DOCUMENT),
]

TEXT_DOCS = """
text_docs AS (
  SELECT string_agg(DISTINCT lab1, ' | ' ORDER BY lab1) AS lab, media, url, presentation,
         string_agg(keyword, ', ' ORDER BY keyword) AS keywords, media_seg, creation_date
  FROM doc JOIN segl USING (layer) JOIN labs USING (media_seg) JOIN cds USING (media_seg)
       JOIN pres USING (media_seg) JOIN kws USING (media_seg) JOIN inst USING (media) JOIN urls USING (instance)
  WHERE media IN (SELECT media FROM is_text) AND media_seg IN (SELECT media_seg FROM harv)
  GROUP BY media, url, presentation, media_seg, creation_date
)"""

TEMPORAL_DOCS = """
temporal_docs AS (
  SELECT title AS lab, media, url, presentation,
         string_agg(keyword, ', ' ORDER BY keyword) AS keywords, media_seg, creation_date
  FROM doc JOIN segl USING (layer) JOIN titl USING (media_seg) JOIN pres USING (media_seg)
       JOIN cds USING (media_seg) JOIN kws USING (media_seg) JOIN inst USING (media) JOIN urls USING (instance)
  WHERE media IN (SELECT media FROM is_temporal)
  GROUP BY title, media, url, presentation, media_seg, creation_date
)"""

INTERVIEWS = """
interviews AS (
  SELECT DISTINCT media, title, title2, url, creation_date
  FROM doc JOIN segl USING (layer) JOIN titl USING (media_seg) JOIN titl2 USING (media_seg)
       JOIN cds USING (media_seg) JOIN inst USING (media) JOIN urls USING (instance)
  WHERE media IN (SELECT media FROM is_temporal)
)"""

UNION_DOCS = """
union_docs AS (
  SELECT lab, media, url, presentation, keywords, media_seg, creation_date, src_rank FROM (
    SELECT *, row_number() OVER (PARTITION BY media
                                 ORDER BY src_rank, sort_key, media_seg, lab, presentation, keywords) AS rn
    FROM (SELECT *, CAST(1 AS BIGINT) AS src_rank, url AS sort_key FROM text_docs
          UNION ALL
          SELECT *, CAST(2 AS BIGINT) AS src_rank, creation_date AS sort_key FROM temporal_docs) u
  ) WHERE rn = 1
)"""

oracle("catalog_text_docs", with_(CAT, QUADS, *GP, TEXT_DOCS, body="SELECT * FROM text_docs"))
oracle("catalog_temporal_docs", with_(CAT, QUADS, *GP, TEMPORAL_DOCS, body="SELECT * FROM temporal_docs"))
oracle("catalog_interviews", with_(CAT, QUADS, *GP, INTERVIEWS, body="SELECT * FROM interviews"))
oracle("catalog_union", with_(CAT, QUADS, *GP, TEXT_DOCS, TEMPORAL_DOCS, UNION_DOCS,
                              body="SELECT * FROM union_docs"))
oracle("group_concat_labels", with_(CAT, QUADS, *GP, body="""
SELECT media_seg, string_agg(DISTINCT lab1, ' | ' ORDER BY lab1) AS lab,
       string_agg(keyword, ', ' ORDER BY keyword) AS keywords
FROM labs JOIN kws USING (media_seg) GROUP BY media_seg"""))
oracle("filter_collection", with_(CAT, QUADS, *GP, INTERVIEWS, body="""
SELECT * FROM interviews WHERE contains(lower(title2), 'programme src1')"""))
oracle("filter_by_type", with_(CAT, QUADS, *GP, body="SELECT DISTINCT media FROM is_temporal"))
oracle("filter_title_lang", with_(CAT, QUADS, TITLES, body=f"""
SELECT s AS media_seg, o AS title FROM quads
WHERE p = '{K.DC_TITLE}' AND o_lang = 'fr' AND o IN (SELECT title FROM titles)"""))
oracle("lookup_titles", with_(CAT, QUADS, TITLES, *GP, body=f"""
SELECT t.line_no, t.title, d.media, u.url
FROM titles t
JOIN (SELECT s AS media_seg, o AS title FROM quads WHERE p = '{K.DC_TITLE}' AND o_lang = 'fr') q ON q.title = t.title
JOIN segl ON segl.media_seg = q.media_seg JOIN doc ON doc.layer = segl.layer
JOIN inst ON inst.media = d.media JOIN urls u ON u.instance = inst.instance""".replace("JOIN doc ON", "JOIN doc d ON")
                                                      .replace("doc.layer", "d.layer")))

oracle("recent_documents", with_(CAT, body="""
SELECT media_seg, CAST(created AS VARCHAR) AS created FROM cat
WHERE date_diff('day', created, DATE '2024-02-15') < 10"""))

oracle("instances_with_inference", """
WITH RECURSIVE edges AS (
  SELECT 'nation/' || CAST(n_nationkey AS VARCHAR) AS child, 'region/' || CAST(n_regionkey AS VARCHAR) AS parent FROM nation
  UNION ALL
  SELECT 'region/' || CAST(r_regionkey AS VARCHAR), 'World' FROM region
),
clo(child, ancestor) AS (
  SELECT child, parent FROM edges
  UNION
  SELECT c.child, e.parent FROM clo c JOIN edges e ON c.ancestor = e.child
),
inst AS (SELECT c_custkey AS instance, 'nation/' || CAST(c_nationkey AS VARCHAR) AS class FROM customer)
SELECT instance, class FROM inst
UNION
SELECT i.instance, c.ancestor AS class FROM inst i JOIN clo c ON i.class = c.child""")

oracle("latest_media_by_title", with_(CAT, body="""
SELECT title, arg_max(media, (created, media)) AS media, CAST(max(created) AS VARCHAR) AS created
FROM cat GROUP BY title"""))

oracle("order_by_created", with_(CAT, body="""
SELECT media_seg, CAST(created AS VARCHAR) AS created, url, ord FROM cat ORDER BY created, url, ord"""))

oracle("page_slice", with_(CAT, body="""
SELECT ord, media_seg, pos FROM (
  SELECT ord, media_seg, CAST(row_number() OVER (ORDER BY ord) - 1 AS BIGINT) AS pos FROM cat
) WHERE pos >= 500 AND pos < 1000"""))

oracle("tail_rows", with_(CAT, body="SELECT ord, media_seg FROM cat ORDER BY ord DESC LIMIT 2"))

oracle("rollback_results", with_(CAT, body="""
SELECT ord, media_seg, CAST(created AS VARCHAR) AS created FROM cat
WHERE ord <= (SELECT max(ord) FROM cat WHERE created = DATE '2024-02-10')"""))

# ------------------------------------------------------------ labelling
CHUNKS = """
chunks AS (
  SELECT chunk_id, list(struct_pack(match := lower(strLabel), label := vocas) ORDER BY pos_in_chunk) AS chunk,
         list(vocas ORDER BY pos_in_chunk) AS offered
  FROM vchunk GROUP BY chunk_id
)"""

CHUNKS_PLAIN = """
chunks_plain AS (
  SELECT chunk_id, list(struct_pack(match := lower(strLabel), label := strLabel) ORDER BY pos_in_chunk) AS chunk,
         list(strLabel ORDER BY pos_in_chunk) AS offered
  FROM vchunk GROUP BY chunk_id
)"""

LEX = """
lex AS (
  SELECT t.media_seg, c.chunk_id, c.offered,
         list_transform(list_filter(c.chunk, lambda x: contains(lower(t.text), x.match)), lambda x: x.label) AS hits
  FROM dtexts t, chunks c
),
resp AS (
  SELECT media_seg, chunk_id, offered,
         CASE WHEN len(hits) > 0 THEN array_to_string(hits, ', ') ELSE 'Rien' END AS response
  FROM lex
)"""

oracle("text_chunk_pairs", with_(VOCAB, CHUNKS, DOC_TEXTS, body="""
SELECT t.media_seg, c.chunk_id, CAST(len(c.chunk) AS BIGINT) AS n_labels FROM dtexts t, chunks c"""))

oracle("classify_lexical", with_(VOCAB, CHUNKS, DOC_TEXTS, LEX, body="SELECT media_seg, chunk_id, response FROM resp"))

PARSE = """
parsed AS (
  SELECT media_seg, chunk_id,
         list_filter(list_transform(string_split(resp_text, ','), lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(13) || chr(160))),
                     lambda x: list_contains(offered, x)) AS labels
  FROM (SELECT *, response AS resp_text FROM resp)
)"""

oracle("parse_predictions", with_(VOCAB, CHUNKS, DOC_TEXTS, LEX, PARSE.replace(
    "response AS resp_text", "response || chr(160) || ', Rien,' || chr(160) || lower(response) AS resp_text"), body="""
SELECT media_seg, chunk_id, CAST(i - 1 AS BIGINT) AS lpos, labels[i] AS label
FROM parsed, range(1, len(labels) + 1) r(i)"""))

COLLECT = """
collected AS (
  SELECT media_seg, flatten(list(labels ORDER BY chunk_id)) AS labels FROM parsed GROUP BY media_seg
)"""

oracle("collect_predictions", with_(VOCAB, CHUNKS, DOC_TEXTS, LEX, PARSE, COLLECT, body="""
SELECT media_seg, CAST(i - 1 AS BIGINT) AS lpos, labels[i] AS label
FROM collected, range(1, len(labels) + 1) r(i)"""))

FIRST_VOCAB = """
first_vocab AS (
  SELECT vocas AS match, strLabel, subclass, entity, uriclass FROM (
    SELECT *, row_number() OVER (PARTITION BY vocas ORDER BY ord) AS rn FROM vocab) WHERE rn = 1
)"""

RESOLVED = """
exploded AS (
  SELECT media_seg, CAST(i - 1 AS BIGINT) AS lpos, labels[i] AS match
  FROM collected, range(1, len(labels) + 1) r(i)
),
resolved AS (
  SELECT e.media_seg, e.lpos, f.strLabel, f.entity, f.uriclass
  FROM exploded e JOIN first_vocab f ON f.match = e.match
)"""

oracle("resolve_entities", with_(VOCAB, CHUNKS, DOC_TEXTS, LEX, PARSE, COLLECT, FIRST_VOCAB, RESOLVED, body="""
SELECT r.media_seg, CAST(row_number() OVER (PARTITION BY r.media_seg ORDER BY r.lpos) - 1 AS BIGINT) AS lpos,
       r.strLabel, r.entity, r.uriclass
FROM resolved r
UNION ALL
SELECT c.media_seg, NULL, NULL, NULL, NULL FROM collected c
WHERE c.media_seg NOT IN (SELECT media_seg FROM resolved)"""))

oracle("index_quads", with_(VOCAB, CHUNKS_PLAIN, DOC_TEXTS,
                            LEX.replace("chunks c", "chunks_plain c"), PARSE, COLLECT,
                            FIRST_VOCAB.replace("SELECT vocas AS match", "SELECT strLabel AS match")
                                       .replace("PARTITION BY vocas", "PARTITION BY strLabel"),
                            RESOLVED, body="""
SELECT DISTINCT media_seg AS s, uriclass AS p, entity AS o, media_seg AS g FROM resolved"""))

CAT_TEXTS = """
upres AS (
  SELECT lab, media, media_seg, keywords,
         array_to_string(list_filter(string_split(presentation, ' | '),
                         lambda x, i: list_position(string_split(presentation, ' | '), x) = i), ' | ') AS presentation
  FROM union_docs
),
ctexts AS (
  SELECT p.media_seg, p.lab || ' ' || m.merged || ' Les mot-clés du texte : ' || p.keywords AS text
  FROM upres p JOIN (SELECT media, string_agg(DISTINCT presentation, ' | ' ORDER BY presentation) AS merged
                     FROM upres GROUP BY media) m ON p.media = m.media
)"""

APP_CHUNKS = """
vocab1 AS (
  SELECT min(ord) AS ord, strLabel, subclass, entity, uriclass
  FROM vocab_raw WHERE list_name = 'list1' GROUP BY strLabel, subclass, entity, uriclass
),
vchunk1 AS (
  SELECT *, CAST((row_number() OVER (ORDER BY ord) - 1) // 27 AS BIGINT) AS chunk_id,
         CAST((row_number() OVER (ORDER BY ord) - 1) % 27 AS BIGINT) AS pos_in_chunk FROM vocab1
),
chunks1 AS (
  SELECT chunk_id, list(strLabel ORDER BY pos_in_chunk) AS offered FROM vchunk1 GROUP BY chunk_id
)"""

REQUESTS = """
SELECT t.media_seg, c.chunk_id, CAST(0 AS BIGINT) AS msg_ord, 'system' AS role, '{task}' AS content, '{variant}' AS variant
FROM ctexts t, {chunks} c
UNION ALL
SELECT t.media_seg, c.chunk_id, 1, 'user', 'Le texte : ' || t.text, '{variant}' FROM ctexts t, {chunks} c
UNION ALL
SELECT t.media_seg, c.chunk_id, 2, 'system', '{choices}' || {prefix}array_to_string(c.offered, ' '), '{variant}'
FROM ctexts t, {chunks} c"""

oracle("inference_requests", with_(CAT, QUADS, *GP, TEXT_DOCS, TEMPORAL_DOCS, UNION_DOCS, CAT_TEXTS, VOCAB, CHUNKS,
                                   APP_CHUNKS, body=REQUESTS.format(task="{task}", choices="{choices}", variant="batch",
                                                                     chunks="chunks", prefix="")
                                   + "\nUNION ALL" + REQUESTS.format(task="{task}", choices="{choices}", variant="app",
                                                                     chunks="chunks1", prefix="'[list1] ' || ")))

oracle("index_end_to_end", with_(CAT, QUADS, *GP, TEXT_DOCS, TEMPORAL_DOCS, UNION_DOCS, CAT_TEXTS, VOCAB, CHUNKS,
                                 LEX.replace("dtexts t", "ctexts t"), PARSE, COLLECT, FIRST_VOCAB, RESOLVED, body="""
SELECT DISTINCT media_seg AS s, uriclass AS p, entity AS o, media_seg AS g FROM resolved"""))


def _fill_prompts() -> None:
    from quadrant.operators.label import SYSTEM_CHOICES, SYSTEM_TASK
    from quadrant.plans.oracle_base import ORACLE
    q = ORACLE["inference_requests"]
    ORACLE["inference_requests"] = (q.replace("{task}", SYSTEM_TASK.replace("'", "''"))
                                     .replace("{choices}", SYSTEM_CHOICES.replace("'", "''")))


_fill_prompts()
