"""Incremental, publish and streaming queries."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from quadrant.functions import constants as K
from quadrant.operators import incremental as INC
from quadrant.operators import label as L
from quadrant.operators import textprep as T
from quadrant.plans.registry import query
from quadrant.session import work_dir, written
from quadrant.sources import files as FS
from quadrant.sources import fixtures as FX
from quadrant.streaming import ingest as ST

EVENT_RUNS = ["2024-01-11", "2024-01-21", "2024-01-31"]
INTERRUPTED_RUN = "2024-01-20"
PUBLISH_ENDPOINT = "https://store.example.org/api/set_media"


def _text_rows(df):
    kw = F.when(F.col("doc_id") % 11 != 0, F.concat_ws(", ", "k1", "k2", "k3"))
    run = [c for c in df.columns if c == "batch_id"]
    rows = df.select("media_seg", F.col("label").alias("lab"), "presentation", kw.alias("keywords"), *run)
    return T.classification_text(rows).select("media_seg", "text", *run)


@query("incremental_offset")
def q_incremental_offset(spark, sf_dir):
    """Offset-resumed runs of 500 rows until nothing is left, over an input
    that grows: first its first seven tenths (their last run is short), then all.
    The first run dies after writing its results and is redone. One job prepares many
    runs; each has its own commit."""
    work = work_dir(spark, "t1")
    staged = INC.stage_positions(FX.cat(spark, sf_dir), ["ord"], f"{work}/input")
    early = staged.where(F.col("pos") < staged.count() * 7 // 10)
    res, state = f"{work}/results", f"{work}/state"
    # a run that dies after writing its results but before its state is redone from the same offset
    INC.run_offset_batch(spark, early, _text_rows, res, state, commit_state=False)
    for grown in (early, staged):
        while INC.run_offset_batches(spark, grown, _text_rows, res, state):
            pass
    return spark.read.schema("media_seg string, text string, batch_id bigint").parquet(res)


def _daily(df):
    return (df.groupBy(F.to_date("ts").cast("string").alias("event_date"))
              .agg(F.count(F.lit(1)).alias("n_events"), F.round(F.sum("value"), 6).alias("total_value")))


@query("incremental_date")
def q_incremental_date(spark, sf_dir):
    """Date-resumed runs (10-day look-back, then since the last run). The
    second run is interrupted before its state is written and redone a day later;
    a same-day re-run is a no-op."""
    work = work_dir(spark, "t2")
    ev = FX.table(spark, sf_dir, "events").select("ts", "value")
    res, state = f"{work}/results", f"{work}/state"
    INC.run_date_batch(spark, ev, "ts", EVENT_RUNS[0], _daily, res, state)
    INC.run_date_batch(spark, ev, "ts", INTERRUPTED_RUN, _daily, res, state, commit_state=False)
    for as_of in (*EVENT_RUNS[1:], EVENT_RUNS[-1]):
        INC.run_date_batch(spark, ev, "ts", as_of, _daily, res, state)
    return spark.read.schema("event_date string, n_events bigint, total_value double, run_date string").parquet(res)


def _records(spark, sf_dir):
    """Records to publish: media, segment, predicted vocabulary rows, request."""
    from quadrant.plans.q_label import document_texts, vocabulary
    res = L.records(document_texts(spark, sf_dir), vocabulary(spark, sf_dir, True)).where(F.size("predicted_labels") > 0)
    doc = F.element_at(F.split("media_seg", "/"), -1).cast("bigint")
    media = F.concat(F.lit(FX.DOC_PREFIX), F.when(doc % 10 == 9, doc - 1).otherwise(doc).cast("string"))
    return INC.with_request(res.withColumn("media", media), PUBLISH_ENDPOINT, "application/pdf", K.CORE_TEXT)


def number_publisher(pdf: pd.DataFrame, attempt: int) -> pd.Series:
    """An example publisher: media number d is accepted from attempt d % 7 on."""
    return attempt >= pdf["media"].str.rsplit("/", n=1).str[-1].astype("int64") % 7


def _locked(records):
    return records.where(F.element_at(F.split("media", "/"), -1).cast("bigint") % 13 == 0).select("media")


def _publish(spark, sf_dir, work):
    # every round reads the records: written once, a retry never re-runs the classifier
    recs = written(_records(spark, sf_dir), "publish-records")
    return recs, INC.publish_with_retry(spark, recs, "media", number_publisher, f"{work}/acks", locked=_locked(recs))


@query("publish_with_retry")
def q_publish_with_retry(spark, sf_dir):
    """K8: the media is the unit of retries and locks; each has the requests of
    its segments, named here by URL and a digest of their bodies."""
    recs, status = _publish(spark, sf_dir, work_dir(spark, "k8"))
    bodies = F.array_join(F.array_sort(F.collect_list("body")), "\n")
    sent = recs.groupBy("media").agg(F.any_value("request_url").alias("request_url"), F.md5(bodies).alias("body_md5"),
                                     F.count(F.lit(1)).alias("n_requests"))
    return status.join(sent, "media")


@query("publish_dead_letter")
def q_publish_dead_letter(spark, sf_dir):
    work = work_dir(spark, "k9")
    recs, status = _publish(spark, sf_dir, work)
    INC.dead_letter(recs, status, "media", f"{work}/dead")
    back = spark.read.schema(recs.schema).json(f"{work}/dead")
    return back.select("media", "media_seg", F.size("predicted_labels").cast("bigint").alias("n_labels"), F.md5("body").alias("body_md5"))


def _land_drops(spark, sf_dir, inbox, drops):
    from quadrant.plans.q_transcripts import seg_keyed
    s = seg_keyed(spark, sf_dir)
    for d in drops:
        FS.land_segment_files(s.where(F.col("conv_id") % 4 == d), inbox).count()


SEG_COLS = ["media_key", "start_raw", "end_raw", "start_ms", "end_ms", "text", "confidence"]


@query("stream_ingest")
def q_stream_ingest(spark, sf_dir):
    """Files arriving in two waves; each run ingests what is new; a third
    run with nothing new adds nothing."""
    work = work_dir(spark, "t3")
    inbox, sink, ckpt = f"{work}/inbox", f"{work}/sink", f"{work}/checkpoint"
    _land_drops(spark, sf_dir, inbox, [0, 1])
    ST.run_available(ST.segment_stream(spark, inbox), sink, ckpt)
    _land_drops(spark, sf_dir, inbox, [2, 3])
    ST.run_available(ST.segment_stream(spark, inbox), sink, ckpt)
    ST.run_available(ST.segment_stream(spark, inbox), sink, ckpt)
    return spark.read.parquet(sink).select(SEG_COLS)


@query("stream_ingest_archive")
def q_stream_ingest_archive(spark, sf_dir):
    """Four waves land one after another, one run each; after every run its
    files are in the archive folder and the inbox is empty."""
    work = work_dir(spark, "k10")
    inbox, sink, ckpt, archive = f"{work}/inbox", f"{work}/sink", f"{work}/checkpoint", f"{work}/archive"
    for wave in range(4):
        _land_drops(spark, sf_dir, inbox, [wave])
        ST.ingest_and_archive(spark, inbox, sink, ckpt, archive)
    arch = FS.read_segment_files(spark, archive)
    n_left = FS.list_files(spark, inbox).agg(F.count(F.lit(1)).alias("n_left"))
    return arch.select("media_key", "start_raw", "end_raw", "text", "confidence").crossJoin(F.broadcast(n_left))  # one row of one number


@query("stream_redelivery")
def q_stream_redelivery(spark, sf_dir):
    """K10 with corrections: every file is delivered, then some again under the same
    name with corrected texts, some cut off, and some unchanged. The newest whole
    version of each media counts; all versions stand beside each other in the
    archive; what was cut off is in the rejects."""
    from quadrant.plans.q_transcripts import seg_keyed
    work = work_dir(spark, "k10-again")
    inbox, sink, ckpt, archive = f"{work}/inbox", f"{work}/sink", f"{work}/checkpoint", f"{work}/archive"
    s = seg_keyed(spark, sf_dir)
    FS.land_segment_files(s, inbox).count()
    ST.ingest_and_archive(spark, inbox, sink, ckpt, archive)
    FS.land_segment_files(s.where(F.col("conv_id") % 3 == 0).withColumn("text", F.concat(F.lit("corrected: "), "text")), inbox).count()
    cut = FS.segment_documents(s.where(F.col("conv_id") % 3 == 1).withColumn("text", F.lit("lost")))
    FS.land_documents(cut.withColumn("body", F.substring("body", 1, 40)), inbox).count()
    ST.ingest_and_archive(spark, inbox, sink, ckpt, archive)
    ST.ingest_and_archive(spark, inbox, sink, ckpt, archive)  # nothing new
    versions = FS.list_files(spark, archive).groupBy(F.regexp_replace("file", r"[.]lintoai[.]json$", "").alias("media_key")).agg(
        F.count(F.lit(1)).alias("n_versions"))
    bad = spark.read.parquet(f"{sink}/rejects").groupBy("media_key").agg(F.count(F.lit(1)).alias("n_rejects"))
    return (ST.latest_segments(spark, sink).join(versions, "media_key").join(bad, "media_key", "left")
            .select(*SEG_COLS, "n_versions", F.coalesce("n_rejects", F.lit(0)).alias("n_rejects")))


@query("stream_dedupe_state")
def q_stream_dedupe_state(spark, sf_dir):
    """T4 by keyed state: three overlapping drops, the last one a repetition; keys
    expire behind the watermark, and no run reads the sink."""
    work = work_dir(spark, "t4-state")
    inbox, sink, ckpt = f"{work}/inbox", f"{work}/sink", f"{work}/checkpoint"
    c = FX.cat(spark, sf_dir).select("ord", "media", "media_seg", "title", F.col("created").cast("timestamp").alias("created"))
    top = c.agg(F.max("ord")).first()[0]
    for drop in (F.col("ord") < 0.6 * top, F.col("ord") >= 0.4 * top, F.col("ord") < 0.3 * top):
        c.where(drop).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(c.schema).parquet(inbox)
        ST.run_available(ST.keep_first_stream(stream, "media", "ord", "created", "60 days"), sink, ckpt)
    return spark.read.schema(c.schema).parquet(sink).select("ord", "media", "media_seg", "title")


@query("stream_dedupe")
def q_stream_dedupe(spark, sf_dir):
    """T4: catalogue rows re-delivered in overlapping drops (the first six tenths,
    then the last six tenths); first per media wins."""
    work = work_dir(spark, "t4")
    inbox, sink, ckpt = f"{work}/inbox", f"{work}/sink", f"{work}/checkpoint"
    c = FX.cat(spark, sf_dir).select("ord", "media", "media_seg", "title")
    top = c.agg(F.max("ord")).first()[0]
    for drop in (F.col("ord") < 0.6 * top, F.col("ord") >= 0.4 * top):
        c.where(drop).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(c.schema).parquet(inbox)
        ST.run_foreach_batch(stream, ST.keep_first_batches("media", "ord", sink), ckpt)
    return spark.read.schema(c.schema).parquet(sink).select(c.columns)


@query("stream_publish")
def q_stream_publish(spark, sf_dir):
    """T5: records arriving as files; each micro-batch is published with retries,
    then recorded in the state table. The batch is replayed once, as after a
    failure before the checkpoint: status and state don't double."""
    work = work_dir(spark, "t5")
    inbox, ckpt = f"{work}/inbox", f"{work}/checkpoint"
    recs = _records(spark, sf_dir)
    recs.write.mode("append").parquet(inbox)
    publish = ST.publish_each_batch("media", number_publisher, work, f"{work}/state")

    def replayed(batch, batch_id):
        publish(batch, batch_id)
        publish(batch, batch_id)
    ST.run_foreach_batch(spark.readStream.schema(recs.schema).parquet(inbox), replayed, ckpt)
    n_states = spark.read.parquet(f"{work}/state").agg(F.count(F.lit(1)).alias("n_batches"))
    status = spark.read.schema("media string, status string, attempts bigint").parquet(f"{work}/status")
    return status.select("media", "status", "attempts").crossJoin(F.broadcast(n_states))  # one row of one number
