"""Quad queries: transcript quads, delete / replace, N-Quads round trip,
update batches, and the correction round trip (X7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadrant.functions.expressions import nq_line
from quadrant.operators import quads as QD
from quadrant.operators import transcripts as TR
from quadrant.plans.registry import query
from quadrant.session import work_dir, written
from quadrant.sources import fixtures as FX
from quadrant.sources.delivery import SCHEMA as DELIVERED
from quadrant.sources.store import QUAD_COLUMNS, GraphStore, catalog_store, transcript_store


def transcript_quads(spark, sf_dir, keep=()):
    return QD.segments_to_quads(FX.seg(spark, sf_dir), keep=keep)


def corrected_segments(spark, sf_dir, lines=None):
    """W2 output mapped back to its media, in the segment shape X4 expects.

    Written once to the shared folder: both the new quads and the list of
    media whose old layers are deleted read it."""
    from quadrant.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    lines = FX.lines(spark, sf_dir) if lines is None else lines
    merged, _ = TR.coalesce_transcript(lines)
    return (merged.join(FX.transcript_media(spark, sf_dir), "file")
                  .select("media", F.col("head_line_no").alias("ord"), F.col("start").alias("start_raw"),
                          F.col("end").alias("end_raw"), "text", F.lit(None).cast("double").alias("confidence"))
                  .checkpoint())


@query("segments_to_quads")
def q_segments_to_quads(spark, sf_dir):
    return transcript_quads(spark, sf_dir).select(QUAD_COLUMNS)


@query("delete_transcription")
def q_delete_transcription(spark, sf_dir):
    store = transcript_store(spark, sf_dir)
    doomed = FX.seg(spark, sf_dir).where(F.col("conv_id") % 3 == 0).select("media").distinct()
    return QD.delete_transcription(store, doomed)


@query("replace_transcription")
def q_replace_transcription(spark, sf_dir):
    store = transcript_store(spark, sf_dir)
    new = corrected_segments(spark, sf_dir).where(F.col("media").endswith("v1"))
    return QD.replace_transcription(store, QD.segments_to_quads(new), new.select("media").distinct())


@query("delete_in_place")
def q_delete_in_place(spark, sf_dir):
    """J11 on a store laid out by graph: only the touched buckets are rewritten."""
    store = GraphStore(spark, work_dir(spark, "graph-store")).create(transcript_store(spark, sf_dir))
    store.delete(FX.seg(spark, sf_dir).where(F.col("conv_id") % 3 == 0).select("media"))
    return store.read().select(QUAD_COLUMNS)


@query("replace_in_place")
def q_replace_in_place(spark, sf_dir):
    """J12 on a store laid out by graph, twice with the same new quads: as once."""
    store = GraphStore(spark, work_dir(spark, "graph-store")).create(transcript_store(spark, sf_dir))
    new = corrected_segments(spark, sf_dir).where(F.col("media").endswith("v1"))
    for _ in range(2):
        store.replace(new, QD.segments_to_quads(new))
    return store.read().select(QUAD_COLUMNS)


@query("src_nquads_grammar")
def q_src_nquads_grammar(spark, sf_dir):
    """S7 beyond IRIs in named graphs: the catalogue with its instances as blank nodes, its
    titles in the default graph, and comments behind the dots. Parsed, written again
    (K6) and parsed again it is the same."""
    q = catalog_store(spark, sf_dir)
    blank = lambda c: F.when(F.col(c).endswith("/instance"), F.concat(F.lit("_:i"), F.regexp_extract(c, "doc/([0-9]+)", 1), F.lit(".x")))
    line = nq_line(g=F.when(~F.col("p").contains("title"), F.col("g")))
    named = lambda text, c: F.when(blank(c).isNotNull(), F.replace(text, F.concat(F.lit("<"), F.col(c), F.lit(">")), blank(c))).otherwise(text)
    line = named(named(line, "s"), "o")
    line = F.when(F.length("s") % 2 == 0, F.concat(line, F.lit(" # a comment with . and <x>"))).otherwise(line)
    path = work_dir(spark, "nquads-blank")
    q.select(line.alias("value")).write.mode("overwrite").text(path)
    first = QD.parse_nquads(spark.read.text(path), scope=F.lit("catalogue"))  # one document in many files: labels mean the same in all
    again = work_dir(spark, "nquads-again")
    QD.to_nquads(first).write.mode("overwrite").text(again)
    back = QD.parse_nquads(spark.read.text(again))
    return back.select(*[F.regexp_replace(c, f"{QD.SKOLEM}[0-9a-f]{{32}}:", "blank ").alias(c) if c in ("s", "o") else c for c in QUAD_COLUMNS])


@query("deliver_updates")
def q_deliver_updates(spark, sf_dir):
    """K7 as a sink: a first attempt fails in one of its tasks and leaves nothing, the
    second one is committed; read back from the journal."""
    q = transcript_quads(spark, sf_dir, keep=("conv_id",)).withColumn("bucket", F.col("conv_id") % 8).drop("conv_id")
    requests = written(QD.update_batches(q), "update-requests")
    journal = work_dir(spark, "journal")
    breaks = F.when(F.col("bucket") == 3, F.raise_error(F.lit("the receiver went away"))).otherwise(F.col("request"))
    try:
        QD.deliver_requests(requests.withColumn("request", breaks.cast("string")), journal)
    except Exception as e:
        if "the receiver went away" not in str(e):
            raise
    QD.deliver_requests(requests, journal)
    return spark.read.schema(DELIVERED).json(journal).select("bucket", "batch", "n_quads", F.md5("request").alias("request_md5"))


def _nquads_source(spark, sf_dir):
    return catalog_store(spark, sf_dir).select(QUAD_COLUMNS).unionByName(
        transcript_store(spark, sf_dir).select(QUAD_COLUMNS))


def _write_nquads(spark, sf_dir) -> str:
    path = work_dir(spark, "nquads")
    QD.to_nquads(_nquads_source(spark, sf_dir)).write.mode("overwrite").text(path)
    return path


@query("quads_to_nquads")
def q_quads_to_nquads(spark, sf_dir):
    return spark.read.text(_write_nquads(spark, sf_dir))


@query("src_nquads")
def q_src_nquads(spark, sf_dir):
    return QD.parse_nquads(spark.read.text(_write_nquads(spark, sf_dir)))


@query("quads_update_batches")
def q_quads_update_batches(spark, sf_dir):
    # the builder dedupes per conv_id, and every quad names its media's layer or
    # segment, so the set stays a set once conv_id becomes the bucket
    q = transcript_quads(spark, sf_dir, keep=("conv_id",)).withColumn("bucket", F.col("conv_id") % 8).drop("conv_id")
    b = QD.update_batches(q)
    return b.select("bucket", "batch", "n_quads", F.md5("request").alias("request_md5"))


@query("correction_round_trip")
def q_correction_round_trip(spark, sf_dir):
    """Segments -> TXT files -> staff corrections -> re-read -> merge -> quads -> replace."""
    from quadrant.plans.q_transcripts import seg_keyed
    s = seg_keyed(spark, sf_dir).withColumn("file", F.col("mkey"))
    path = work_dir(spark, "txt-export")
    TR.write_documents(TR.txt_lines(s, key_col="file"), "file", ["start_ms", "end_ms", "ord"], "line", path)
    exported = TR.read_documents(spark, path, "file")
    # the staff blank the text of every third line: the line extends the one above
    corrected = exported.withColumn(
        "line", F.when(F.col("line_no") % 3 == 2,
                       F.regexp_replace("line", r"^([^-:]*-[^-:]*[^:]*:).*$", "$1 ")).otherwise(F.col("line")))
    # the merge reads the lines twice, the files are read once
    new = corrected_segments(spark, sf_dir, written(corrected.select("file", "line_no", "line"), "corrected-lines"))
    store = transcript_store(spark, sf_dir)
    return QD.replace_transcription(store, QD.segments_to_quads(new), new.select("media").distinct())
