"""Transcript queries: keys, lookups, time codes, merge, TXT / SRT, stats, ASR plug-in."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadrant.functions.expressions import media_key
from quadrant.operators import transcripts as TR
from quadrant.plans.registry import query
from quadrant.session import work_dir
from quadrant.sources import fixtures as FX
from quadrant.sources.media import media_ranges, read_ranges


def seg_keyed(spark, sf_dir):
    return FX.seg(spark, sf_dir).withColumn("media_key", media_key("media"))


@query("media_key")
def q_media_key(spark, sf_dir):
    m = FX.seg(spark, sf_dir).select("media").union(FX.tcat(spark, sf_dir).select("media")).distinct()
    return m.select("media", media_key("media").alias("media_key"),
                    media_key("media", keep_version=True).alias("media_key_versioned"))


@query("media_with_transcript")
def q_media_with_transcript(spark, sf_dir):
    return TR.media_with_transcript(FX.tcat(spark, sf_dir).select("media"), FX.transcript_file_keys(spark, sf_dir))


@query("file_to_title")
def q_file_to_title(spark, sf_dir):
    return TR.file_to_title(FX.transcript_file_keys(spark, sf_dir), FX.tcat(spark, sf_dir))


@query("name_to_media")
def q_name_to_media(spark, sf_dir):
    return TR.name_to_media(FX.txt_names(spark, sf_dir), FX.tcat(spark, sf_dir))


@query("segment_timecodes")
def q_segment_timecodes(spark, sf_dir):
    t = TR.segment_timecodes(FX.seg(spark, sf_dir))
    return t.select("conv_id", "turn", "begin_tc", "end_tc", "duration_tc", "begin_tr", "end_tr", "duration_tr")


@query("coalesce_transcript")
def q_coalesce_transcript(spark, sf_dir):
    segments, _ = TR.coalesce_transcript(FX.lines(spark, sf_dir))
    return segments


@query("transcript_txt")
def q_transcript_txt(spark, sf_dir):
    path = work_dir(spark, "txt")
    TR.write_documents(TR.txt_lines(seg_keyed(spark, sf_dir)), "media_key", ["start_ms", "end_ms", "ord"], "line", path)
    return TR.read_documents(spark, path, "media_key")


@query("transcript_srt")
def q_transcript_srt(spark, sf_dir):
    path = work_dir(spark, "srt")
    TR.write_documents(TR.srt_cues(seg_keyed(spark, sf_dir)), "media_key", ["start_ms", "end_ms", "ord"], "line", path)
    return TR.read_documents(spark, path, "media_key")


@query("layer_stats")
def q_layer_stats(spark, sf_dir):
    return TR.layer_stats(FX.seg(spark, sf_dir))


def land_media_files(spark, sf_dir) -> str:
    """Land one 'audio' file per media (its speech as bytes) in the shared folder."""
    s = seg_keyed(spark, sf_dir)
    path = work_dir(spark, "media-files")
    TR.write_documents(s.select("media_key", "start_ms", "end_ms", "ord",
                                F.concat(F.col("text"), F.lit(".")).alias("line")),
                       "media_key", ["start_ms", "end_ms", "ord"], "line", path)
    return path


def read_media_files(spark, path):
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
                 .option("pathGlobFilter", "*.txt").load(path)
                 .select(F.regexp_extract("path", "media_key=([^/]+)/", 1).alias("media_key"), "length", "content"))


@query("src_binary_media")
def q_src_binary_media(spark, sf_dir):
    files = read_media_files(spark, land_media_files(spark, sf_dir))
    cat = FX.tcat(spark, sf_dir).withColumn("media_key", media_key("media"))
    return cat.join(files.select("media_key", "length"), "media_key").select("media", "media_key", "length")


@query("src_media_ranges")
def q_src_media_ranges(spark, sf_dir):
    """Each media file in ranges of 1 KiB, with a digest of every range's bytes."""
    ranges = read_ranges(media_ranges(spark, land_media_files(spark, sf_dir), range_bytes=1024, suffix="*.txt"))
    return ranges.select(F.regexp_extract("path", "media_key=([^/]+)/", 1).alias("media_key"), "length", "range_no", "start",
                         "n_bytes", F.md5(F.encode(F.hex("content"), "utf-8")).alias("digest"))


def sentence_model(content: bytes, language: str) -> list[dict]:
    """An example model for the plug-in path: one segment per sentence of the decoded
    bytes, 40 ms per character."""
    text = content.decode("utf-8", errors="replace")
    out, t = [], 0
    for part in [p.strip() for p in text.replace("\n", " ").split(".")]:
        if not part:
            continue
        start, t = t, t + 40 * len(part)
        out.append({"start": f"{start // 1000}.{start % 1000:03d}", "end": f"{t // 1000}.{t % 1000:03d}",
                    "text": part, "confidence": (len(part) % 100) / 100})
    return out


@query("transcribe_plugin")
def q_transcribe_plugin(spark, sf_dir):
    files = read_media_files(spark, land_media_files(spark, sf_dir))
    return TR.transcribe(files, sentence_model, language="fr")
