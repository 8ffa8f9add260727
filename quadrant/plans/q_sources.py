"""Source and sink queries: each writes to the shared folder and reads back."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadrant.operators import catalog as C
from quadrant.operators import label as L
from quadrant.plans.registry import query
from quadrant.session import work_dir
from quadrant.sources import files as FS
from quadrant.sources import fixtures as FX
from quadrant.sources.store import catalog_store

CATALOG_CSV_SCHEMA = "media string, title string, title2 string, url string, creationdate string, description string"


@query("src_csv_catalog")
def q_src_csv_catalog(spark, sf_dir):
    c = FX.cat(spark, sf_dir)
    d = FX.table(spark, sf_dir, "documents").select(F.col("doc_id"), F.col("text").alias("_text"))
    rows = c.join(d, "doc_id").select("media", "title", "title2", "url",
                                       F.col("created").cast("string").alias("creationdate"),
                                       F.col("_text").alias("description"))
    path = work_dir(spark, "catalog-csv")
    FS.write_csv(rows, path)
    return FS.read_csv(spark, path, CATALOG_CSV_SCHEMA)


@query("sink_csv")
def q_sink_csv(spark, sf_dir):
    rows = C.text_documents(catalog_store(spark, sf_dir)).select(
        "lab", "media", "url", "presentation", "keywords", "media_seg", "creation_date")
    path = work_dir(spark, "results-csv")
    FS.write_csv(rows, path)
    return FS.read_csv(spark, path, "lab string, media string, url string, presentation string, "
                                    "keywords string, media_seg string, creation_date string")


@query("src_segments_json")
def q_src_segments_json(spark, sf_dir):
    from quadrant.plans.q_transcripts import seg_keyed
    path = work_dir(spark, "segments-json")
    # every other media left as a verbose response
    FS.land_segment_files(seg_keyed(spark, sf_dir), path, verbose=F.col("conv_id") % 2 == 1).count()
    # a file without the suffix in the same folder must be ignored
    spark.createDataFrame([("not a transcript",)], "value string").coalesce(1).write.mode("append").text(path + "/notes")
    s = FS.read_segment_files(spark, path)
    return s.select("media_key", "ord", "start_raw", "end_raw", "start_ms", "end_ms", "text", "confidence")


@query("src_segments_rejects")
def q_src_segments_rejects(spark, sf_dir):
    """S2 over damaged input: of seven media, one file is cut off, one holds an object
    without segments, one an item without times, one nothing at all; the rest is
    whole. Segments and rejects are counted per media."""
    from quadrant.plans.q_transcripts import seg_keyed
    path = work_dir(spark, "segments-damaged")
    s = seg_keyed(spark, sf_dir)
    kind = s.select("media_key", (F.col("conv_id") % 7).alias("kind")).distinct()
    body = (F.when(F.col("kind") == 2, F.expr("substring(body, 1, length(body) - 5)"))
             .when(F.col("kind") == 3, F.lit('{"task": "transcribe", "error": "no speech"}'))
             .when(F.col("kind") == 4, F.concat(F.lit('[{"text": "timeless"},'), F.expr("substring(body, 2)")))
             .when(F.col("kind") == 5, F.lit("")).otherwise(F.col("body")))
    FS.land_documents(FS.segment_documents(s).join(kind, "media_key").withColumn("body", body), path).count()
    good = FS.read_segment_files(spark, path).groupBy("media_key").agg(F.lit("segment").alias("reason"), F.count(F.lit(1)).alias("n"))
    bad = FS.rejected_segment_files(spark, path).groupBy("media_key", "reason").agg(F.count(F.lit(1)).alias("n"))
    return good.unionByName(bad)


@query("src_csv_rejects")
def q_src_csv_rejects(spark, sf_dir):
    """S1 over damaged input: records with a field too few or too many, or with a word
    where a number belongs, are rejects with their raw text."""
    c = FX.cat(spark, sf_dir)
    quoted = F.concat(F.lit('"'), F.replace("title2", F.lit('"'), F.lit('""')), F.lit('"'))
    fields = F.concat_ws(",", F.when(F.col("ord") % 9 == 5, F.lit("none")).otherwise(F.col("ord").cast("string")), "media_seg", quoted)
    line = F.when(F.col("ord") % 9 == 4, F.concat_ws(",", F.col("ord").cast("string"), "media_seg")).when(
        F.col("ord") % 9 == 7, F.concat(fields, F.lit(",more"))).otherwise(fields)
    path = work_dir(spark, "csv-damaged")
    c.select(line.alias("value")).write.mode("overwrite").option("header", False).text(path)
    schema = "ord bigint, media_seg string, title2 string"
    good = FS.read_csv(spark, path, schema, header=False)
    bad = FS.rejected_csv(spark, path, schema, header=False)
    return good.select("ord", "media_seg", "title2", F.lit(None).cast("string").alias("record")).unionByName(
        bad.select(F.lit(None).cast("bigint").alias("ord"), F.lit(None).cast("string").alias("media_seg"), F.lit(None).cast("string").alias("title2"), "record"))


@query("src_sparql_rejects")
def q_src_sparql_rejects(spark, sf_dir):
    """S6 over damaged input: bindings of whole pages, and the pages that are cut off or
    hold an error instead of results."""
    c = FX.cat(spark, sf_dir).select("ord", "media_seg", "title2")
    binding = F.struct(*[F.struct(F.lit("literal").alias("type"), F.col(v).alias("value")).alias(v) for v in ("media_seg", "title2")])
    whole = F.to_json(F.struct(F.struct(F.array(F.lit("media_seg"), F.lit("title2")).alias("vars")).alias("head"),
                               F.struct(F.array(binding).alias("bindings")).alias("results")))
    page = F.when(F.col("ord") % 8 == 1, F.expr("substring(page, 1, length(page) - 3)")).when(
        F.col("ord") % 8 == 2, F.lit('{"error": "timeout"}')).otherwise(F.col("page"))
    path = work_dir(spark, "sparql-damaged")
    c.withColumn("page", whole).select(page.alias("value")).write.text(path + "/pages")
    names = ["media_seg", "title2"]
    good = FS.read_sparql_json(spark, path + "/pages", names).select(*names, F.lit("binding").alias("reason"), F.lit(1).cast("bigint").alias("n"))
    bad = FS.rejected_sparql_json(spark, path + "/pages", names).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return good.unionByName(bad.select(*[F.lit(None).cast("string").alias(v) for v in names], "reason", "n"))


@query("src_text_lines")
def q_src_text_lines(spark, sf_dir):
    from quadrant.operators import transcripts as TR
    path = work_dir(spark, "corrected-txt")
    TR.write_documents(FX.lines(spark, sf_dir), "file", ["line_no"], "line", path)
    return TR.read_documents(spark, path, "file")


INTERVIEW_VARS = ["media", "title", "title2", "url", "creation_date"]


@query("src_sparql_json")
def q_src_sparql_json(spark, sf_dir):
    rows = C.interviews(catalog_store(spark, sf_dir))
    path = work_dir(spark, "sparql-json")
    FS.write_sparql_json(rows, INTERVIEW_VARS, path, rows_per_page=100)
    return FS.read_sparql_json(spark, path, INTERVIEW_VARS)


@query("vocab_select")
def q_vocab_select(spark, sf_dir):
    path = work_dir(spark, "vocab-registry")
    FS.write_vocabulary_registry(FX.vocab_raw(spark, sf_dir), path)
    return FS.select_vocabulary(spark, path, "List 1")


@query("sink_append")
def q_sink_append(spark, sf_dir):
    c = FX.cat(spark, sf_dir).select("ord", "media_seg", "title")
    rows = c.withColumn("batch_id", F.floor(F.col("ord") / 500).cast("bigint"))
    path = work_dir(spark, "append")
    FS.append_batch(rows.where(F.col("batch_id") == 0), path)
    FS.append_batch(rows.where(F.col("batch_id") >= 1), path)
    FS.append_batch(rows.where(F.col("batch_id") == 1), path)  # redo: replaces, never duplicates
    return spark.read.parquet(path).select("ord", "media_seg", "title", F.col("batch_id").cast("bigint"))


@query("sink_nested_json")
def q_sink_nested_json(spark, sf_dir):
    from quadrant.plans.q_label import document_texts, vocabulary
    res = L.records(document_texts(spark, sf_dir), vocabulary(spark, sf_dir, True))
    path = work_dir(spark, "nested-json")
    res.write.mode("overwrite").json(path)
    back = spark.read.schema("media_seg string, predicted_labels array<struct<strLabel:string,subclass:string,"
                             "entity:string,uriclass:string>>").json(path)
    return back.select("media_seg", F.posexplode_outer("predicted_labels").alias("lpos", "l")).select(
        "media_seg", F.col("lpos").cast("bigint").alias("lpos"), F.col("l.strLabel").alias("strLabel"),
        F.col("l.entity").alias("entity"), F.col("l.uriclass").alias("uriclass"))

