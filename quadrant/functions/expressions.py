"""Scalar Column builders. All built-in expressions: they stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- time codes
def seconds_text_to_ms(raw) -> Column:
    """'12.34' (seconds, as written in the JSON) -> 12340 ms (BIGINT).

    Hand-corrected files may hold a blank or malformed time: that gives null
    (and no time quad) rather than failing the job under ANSI casts."""
    return F.round(_c(raw).try_cast("double") * 1000).cast("bigint")


def ms_to_seconds_text(ms) -> Column:
    """12340 -> '12.340' (the raw form used in segment URIs and TXT lines)."""
    ms = _c(ms)
    return F.concat(F.floor(ms / 1000).cast("string"), F.lit("."),
                    F.lpad((ms % 1000).cast("string"), 3, "0"))


def _pad2(x: Column) -> Column:
    return F.lpad(x.cast("string"), 2, "0")


def _hours(ms: Column) -> Column:
    # hours may exceed 99 in theory; lpad would truncate, so only pad below 10
    h = F.floor(ms / 3600000)
    return F.when(h < 10, F.concat(F.lit("0"), h.cast("string"))).otherwise(h.cast("string"))


def ms_to_timecode(ms) -> Column:
    """ms -> 'Thh:mm:ss:nnnF1000' (frame count in thousandths)."""
    ms = _c(ms)
    return F.concat(F.lit("T"), _hours(ms), F.lit(":"),
                    _pad2(F.floor(ms / 60000) % 60), F.lit(":"),
                    _pad2(F.floor(ms / 1000) % 60), F.lit(":"),
                    F.lpad((ms % 1000).cast("string"), 3, "0"), F.lit("F1000"))


def ms_to_duration(ms) -> Column:
    """ms -> 'PThHmMsSnnnN1000F'."""
    ms = _c(ms)
    return F.concat(F.lit("PT"), F.floor(ms / 3600000).cast("string"), F.lit("H"),
                    (F.floor(ms / 60000) % 60).cast("string"), F.lit("M"),
                    (F.floor(ms / 1000) % 60).cast("string"), F.lit("S"),
                    F.lpad((ms % 1000).cast("string"), 3, "0"), F.lit("N1000F"))


def ms_to_srt_stamp(ms) -> Column:
    """ms -> 'HH:MM:SS,mmm'; hours are not wrapped at 24."""
    ms = _c(ms)
    return F.concat(_hours(ms), F.lit(":"), _pad2(F.floor(ms / 60000) % 60), F.lit(":"),
                    _pad2(F.floor(ms / 1000) % 60), F.lit(","),
                    F.lpad((ms % 1000).cast("string"), 3, "0"))


# ---------------------------------------------------------------- media keys
def media_key(media, keep_version: bool = False) -> Column:
    """Provider routing (F7): file key of a media URI, null for unknown providers.

    hal:    last ':' part, version suffix vNN removed unless keep_version
    nakala: path parts from the 5th on, joined by '.'
    When both words occur the nakala rule wins.
    """
    m = _c(media)
    last = F.element_at(F.split(m, ":"), -1)
    hal = last if keep_version else F.regexp_replace(last, "v[0-9]+$", "")
    parts = F.split(m, "/")
    nakala = F.array_join(F.slice(parts, 5, 1 << 20), ".")
    return (F.when(m.contains("nakala"), nakala)
             .when(m.contains("hal"), hal)
             .otherwise(F.lit(None).cast("string")))


def layer_uri(media) -> Column:
    """Transcript layer of a media: 'media' -> 'layer' + '/transcription/whisper'."""
    from quadrant.functions.constants import ASR_LAYER_SUFFIX
    return F.concat(F.replace(_c(media), F.lit("media"), F.lit("layer")), F.lit(ASR_LAYER_SUFFIX))


def segment_uri(layer, start_raw) -> Column:
    from quadrant.functions.constants import SEGMENT_URI_INFIX
    return F.concat(_c(layer), F.lit(SEGMENT_URI_INFIX),
                    F.replace(_c(start_raw), F.lit("."), F.lit("_")))


# ---------------------------------------------------------------- strings
def strip_punctuation(x) -> Column:
    """Unicode-aware removal of everything that is not a letter, digit, '_' or space."""
    return F.regexp_replace(_c(x), r"(?U)[^\p{L}\p{N}_\s]", "")


def trim_space(x) -> Column:
    """Without white space of any kind (tabs, no-break spaces, line separators) at the ends."""
    return F.regexp_replace(_c(x), r"(?U)^\s+|\s+$", "")


def percent_encode_path(x) -> Column:
    """RFC 3986 percent-encoding that keeps '/', like a path quote()."""
    enc = F.url_encode(_c(x))
    enc = F.replace(enc, F.lit("+"), F.lit("%20"))
    enc = F.replace(enc, F.lit("%2F"), F.lit("/"))
    enc = F.replace(enc, F.lit("*"), F.lit("%2A"))
    return F.replace(enc, F.lit("%7E"), F.lit("~"))


def qualified_label(label, subclass) -> Column:
    """P1: 'label(subclass)', null-propagating."""
    return F.concat(_c(label), F.lit("("), _c(subclass), F.lit(")"))


# ---------------------------------------------------------------- N-Quads terms
def nq_escape(x) -> Column:
    e = F.replace(_c(x), F.lit("\\"), F.lit("\\\\"))
    e = F.replace(e, F.lit('"'), F.lit('\\"'))
    e = F.replace(e, F.lit("\n"), F.lit("\\n"))
    return F.replace(e, F.lit("\r"), F.lit("\\r"))


def nq_unescape(x) -> Column:
    """The text of an N-Quads term: \\t \\b \\n \\r \\f, escaped quotes and
    backslashes, \\uXXXX (pairs too) and \\UXXXXXXXX."""
    parts = F.regexp_extract_all(_c(x), F.lit(r"(?s)((?:\\u[0-9A-Fa-f]{4})+|\\U[0-9A-Fa-f]{8}|\\.|[^\\]+)"), F.lit(1))
    code = lambda p, mark, charset: F.decode(F.unhex(F.replace(p, F.lit(mark), F.lit(""))), charset)
    one = lambda p: F.translate(F.substr(p, F.lit(2)), "tbnrf", "\t\b\n\r\f")
    return F.array_join(F.transform(parts, lambda p: F.when(~p.startswith("\\"), p)
                        .when(p.rlike(r"^\\u[0-9A-Fa-f]{4}"), code(p, "\\u", "UTF-16BE"))
                        .when(p.rlike(r"^\\U[0-9A-Fa-f]{8}$"), code(p, "\\U", "UTF-32")).otherwise(one(p))), "")


def nq_object(o, kind, datatype, lang) -> Column:
    lit_term = F.concat(F.lit('"'), nq_escape(o), F.lit('"'),
                        F.when(_c(datatype).isNotNull(), F.concat(F.lit("^^<"), _c(datatype), F.lit(">")))
                         .when(_c(lang).isNotNull(), F.concat(F.lit("@"), _c(lang)))
                         .otherwise(F.lit("")))
    return F.when(_c(kind) == "uri", F.concat(F.lit("<"), _c(o), F.lit(">"))).otherwise(lit_term)


def nq_line(s="s", p="p", o="o", g="g", kind="o_kind", datatype="o_datatype", lang="o_lang") -> Column:
    """One N-Quads statement: <s> <p> term <g> . (without <g> in the default graph, g null)"""
    graph = F.coalesce(F.concat(F.lit(" <"), _c(g), F.lit(">")), F.lit(""))
    return F.concat(F.lit("<"), _c(s), F.lit("> <"), _c(p), F.lit("> "), nq_object(o, kind, datatype, lang), graph, F.lit(" ."))
