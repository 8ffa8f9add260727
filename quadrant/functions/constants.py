"""Vocabulary URIs, markers and sizes shared by every job.

Fixed values: these must equal what the catalogue and its existing quads use,
so they are stated here plainly, once, in natural order.
"""

# --- fixed values: RDF namespaces -------------------------------------------
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
XSD = "http://www.w3.org/2001/XMLSchema#"
DC = "http://purl.org/dc/elements/1.1/"
CORE = "http://www.ina.fr/core#"
USER = "http://www.ina.fr/user/"

# --- fixed values: predicates and classes -----------------------------------
RDF_TYPE = RDF + "type"
RDFS_LABEL = RDFS + "label"
DC_TITLE = DC + "title"
DC_TITLE2 = DC + "title2"
DC_DESCRIPTION = DC + "description"
DC_SUBJECT = DC + "subject"
CORE_TEXT = CORE + "Text"
CORE_TEMPORAL_DOCUMENT = CORE + "TemporalDocument"
CORE_DOCUMENT = CORE + "document"
CORE_SEGMENT = CORE + "segment"
CORE_INSTANCE = CORE + "instance"
CORE_HTTP_URL = CORE + "http_url"
CORE_CREATION_DATE = CORE + "creationDate"
CORE_LAST_USER = CORE + "lastUser"
CORE_ASR_LAYER = CORE + "ASRLayer"
CORE_ASR_SEGMENT = CORE + "ASRSegment"
CORE_BEGIN_TIME = CORE + "beginTime"
CORE_BEGIN_TIME_TR = CORE + "beginTimeTR"
CORE_END_TIME = CORE + "endTime"
CORE_END_TIME_TR = CORE + "endTimeTR"
CORE_DURATION = CORE + "duration"
CORE_DURATION_TR = CORE + "durationTR"
CORE_TEXT_PROP = CORE + "text"
CORE_CONFIDENCE = CORE + "confidence"
XSD_INTEGER = XSD + "integer"
XSD_FLOAT = XSD + "float"
HARVESTER = USER + "harvester"

# --- fixed values: transcript layer naming ----------------------------------
ASR_LAYER_LABEL = "Transcription WHISPER"
ASR_LAYER_SUFFIX = "/transcription/whisper"
SEGMENT_URI_INFIX = "/segment_"
TRANSCRIPT_FILE_SUFFIX = ".lintoai.json"

# --- fixed values: text markers ----------------------------------------------
KEYWORD_MARKER = " Les mot-clés du texte : "
NO_ANSWER = "Rien"
INTERVIEW_MARKER = "entretien avec "
LINTO_NAME_MARKER = "__."
NO_MATCH = "No match found"

# --- fixed values: batch sizes and retry budget -----------------------------
LABELS_PER_CHUNK = 27
ROWS_PER_BATCH = 500
QUADS_PER_REQUEST = 500
RETRY_ROUNDS = 5
RETRIES_PER_MEDIA = 3
FIRST_RUN_LOOKBACK_DAYS = 10
