"""Catalogue and text-preparation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadrant.functions import constants as K
from quadrant.operators import catalog as C
from quadrant.operators import textprep as T
from quadrant.operators.incremental import stage_positions
from quadrant.plans.registry import query
from quadrant.session import work_dir
from quadrant.sources import fixtures as FX
from quadrant.sources.store import catalog_store


@query("vocab_dedupe")
def q_vocab_dedupe(spark, sf_dir):
    return T.vocab_dedupe(FX.vocab_raw(spark, sf_dir))


@query("vocab_qualified")
def q_vocab_qualified(spark, sf_dir):
    v = T.with_qualified(T.vocab_dedupe(FX.vocab_raw(spark, sf_dir)))
    return v.select("ord", "strLabel", "subclass", "vocas")


@query("classification_text")
def q_classification_text(spark, sf_dir):
    c = FX.cat(spark, sf_dir)
    kw = F.when(F.col("doc_id") % 11 != 0, F.concat_ws(", ", "k1", "k2", "k3"))
    rows = c.select("media_seg", F.col("label").alias("lab"), "presentation", kw.alias("keywords"))
    return T.classification_text(rows).select("media_seg", "text")


@query("merge_presentations")
def q_merge_presentations(spark, sf_dir):
    c = FX.cat(spark, sf_dir).select("media", "media_seg", "presentation")
    return T.merge_presentations(c)


@query("dedupe_keep_first")
def q_dedupe_keep_first(spark, sf_dir):
    c = FX.cat(spark, sf_dir).select("ord", "media", "media_seg", "title")
    return T.dedupe_keep_first(c, "media", "ord")


@query("catalog_from_uris")
def q_catalog_from_uris(spark, sf_dir):
    d = FX.table(spark, sf_dir, "documents").select("doc_id")
    uris = d.select(F.concat(F.lit("https://hal.example.org/hal-"),
                             F.lpad(F.col("doc_id").cast("string"), 8, "0")).alias("uri_s"))
    return T.catalog_from_uris(uris)


@query("catalog_text_docs")
def q_catalog_text_docs(spark, sf_dir):
    return C.text_documents(catalog_store(spark, sf_dir))


@query("group_concat_labels")
def q_group_concat_labels(spark, sf_dir):
    q = catalog_store(spark, sf_dir)
    rows = (C.pattern(q, K.RDFS_LABEL, "media_seg", "lab1")
            .join(C.pattern(q, K.DC_SUBJECT, "media_seg", "keyword"), "media_seg"))
    return C.group_concat(rows, ["media_seg"])


@query("catalog_temporal_docs")
def q_catalog_temporal_docs(spark, sf_dir):
    return C.temporal_documents(catalog_store(spark, sf_dir))


@query("catalog_interviews")
def q_catalog_interviews(spark, sf_dir):
    return C.interviews(catalog_store(spark, sf_dir))


@query("catalog_union")
def q_catalog_union(spark, sf_dir):
    q = catalog_store(spark, sf_dir)
    return C.catalog_union(C.text_documents(q), C.temporal_documents(q))


@query("filter_collection")
def q_filter_collection(spark, sf_dir):
    return C.filter_collection(C.interviews(catalog_store(spark, sf_dir)), "Programme src1")


@query("filter_title_lang")
def q_filter_title_lang(spark, sf_dir):
    return C.titles_in_lang(catalog_store(spark, sf_dir), FX.title_list(spark, sf_dir), "fr")


@query("filter_by_type")
def q_filter_by_type(spark, sf_dir):
    return C.filter_by_type(catalog_store(spark, sf_dir), K.CORE_TEMPORAL_DOCUMENT)


@query("recent_documents")
def q_recent_documents(spark, sf_dir):
    c = FX.cat(spark, sf_dir)
    r = C.recent(c, FX.AS_OF, FX.RECENT_DAYS)
    return r.select("media_seg", F.col("created").cast("string").alias("created"))


@query("lookup_titles")
def q_lookup_titles(spark, sf_dir):
    return C.lookup_titles(catalog_store(spark, sf_dir), FX.title_list(spark, sf_dir), "fr")


@query("instances_with_inference")
def q_instances_with_inference(spark, sf_dir):
    return C.instances_with_inference(FX.typed_instances(spark, sf_dir), FX.class_edges(spark, sf_dir))


@query("latest_media_by_title")
def q_latest_media_by_title(spark, sf_dir):
    return C.latest_media_by_title(FX.cat(spark, sf_dir).select("title", "media", "created"))


@query("order_by_created")
def q_order_by_created(spark, sf_dir):
    c = FX.cat(spark, sf_dir)
    return (c.select("media_seg", F.col("created").cast("string").alias("created"), "url", "ord")
             .orderBy("created", "url", "ord"))


@query("page_slice")
def q_page_slice(spark, sf_dir):
    c = FX.cat(spark, sf_dir).select("ord", "media_seg")
    staged = stage_positions(c, ["ord"], work_dir(spark, "page-positions"))
    return C.page(staged, "pos", K.ROWS_PER_BATCH, K.ROWS_PER_BATCH)  # the scan skips other row groups


@query("tail_rows")
def q_tail_rows(spark, sf_dir):
    return C.tail(FX.cat(spark, sf_dir).select("ord", "media_seg"), 2, ["ord"])


@query("rollback_results")
def q_rollback_results(spark, sf_dir):
    c = FX.cat(spark, sf_dir).select("ord", "media_seg", "created")
    r = C.rollback_to_date(c, "2024-02-10")
    return r.withColumn("created", F.col("created").cast("string"))
