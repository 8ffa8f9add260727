"""Labelling queries: chunks, pairs, requests, classifier, parsing, resolution,
index quads, and the end-to-end indexing flow (flagship)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadrant.functions import constants as K
from quadrant.operators import catalog as C
from quadrant.operators import label as L
from quadrant.operators import textprep as T
from quadrant.plans.registry import query
from quadrant.session import written
from quadrant.sources import fixtures as FX
from quadrant.sources.store import catalog_store


def document_texts(spark, sf_dir):
    """Whole document texts keyed by their catalogue segment."""
    d = FX.table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.select(F.concat(F.lit(FX.SEG_PREFIX), F.col("doc_id").cast("string")).alias("media_seg"), "text")


def catalogue_texts(spark, sf_dir):
    """U1 -> A2 -> P2: the classification text of every catalogue media."""
    q = catalog_store(spark, sf_dir)
    # the union (a dozen pattern joins) feeds both sides of the presentation
    # merge: write it once to the shared folder instead of planning it twice
    u = written(C.catalog_union(C.text_documents(q), C.temporal_documents(q)), "catalogue-union")
    return T.classification_text(T.merge_presentations(u)).select("media_seg", "text")


_PREPARED: dict[tuple, L.Vocabulary] = {}


def vocabulary(spark, sf_dir, qualified=True) -> L.Vocabulary:
    """The vocabulary, prepared once per application: a dimension that every
    labelling query shares."""
    key = (spark.sparkContext.applicationId, id(spark), sf_dir, qualified)
    if key not in _PREPARED:
        _PREPARED[key] = L.Vocabulary(FX.vocab_raw(spark, sf_dir), qualified)
    return _PREPARED[key]


@query("vocab_chunks")
def q_vocab_chunks(spark, sf_dir):
    v = T.with_qualified(T.vocab_dedupe(FX.vocab_raw(spark, sf_dir)))
    rows, _ = L.vocab_chunks(v)
    return rows.select("ord", "vocas", "chunk_id", "pos_in_chunk")


@query("text_chunk_pairs")
def q_text_chunk_pairs(spark, sf_dir):
    v = vocabulary(spark, sf_dir)
    pairs = L.text_chunk_pairs(document_texts(spark, sf_dir), v.chunks, v.n_chunks)
    return pairs.select("media_seg", "chunk_id", F.size("chunk").cast("bigint").alias("n_labels"))


APP_LIST = "list1"


@query("inference_requests")
def q_inference_requests(spark, sf_dir):
    """P4, both prompt variants: the batch one offers qualified labels of the
    whole vocabulary; the app one offers the plain labels of one selected list
    and names that list."""
    texts = catalogue_texts(spark, sf_dir)
    v = vocabulary(spark, sf_dir)
    batch = L.inference_requests(L.text_chunk_pairs(texts, v.chunks, v.n_chunks)).withColumn("variant", F.lit("batch"))
    one = L.Vocabulary(FX.vocab_raw(spark, sf_dir).where(F.col("list_name") == APP_LIST), qualified=False)
    app = L.inference_requests(L.text_chunk_pairs(texts, one.chunks, one.n_chunks), list_name=APP_LIST) \
        .withColumn("variant", F.lit("app"))
    return batch.unionByName(app).withColumn("msg_ord", F.col("msg_ord").cast("bigint"))


def _responses(spark, sf_dir):
    v = vocabulary(spark, sf_dir)
    return L.lexical_response(L.lexical_pairs(document_texts(spark, sf_dir), v.chunks, v.n_chunks, v.blocks))


@query("classify_lexical")
def q_classify_lexical(spark, sf_dir):
    return _responses(spark, sf_dir).select("media_seg", "chunk_id", "response")


@query("parse_predictions")
def q_parse_predictions(spark, sf_dir):
    """F6 over noisy responses: the lexical answer between no-break spaces (usual
    in French output), a 'Rien', and a lower-cased copy."""
    resp = _responses(spark, sf_dir).withColumn("response", F.concat(
        F.col("response"), F.lit("\u00a0, " + K.NO_ANSWER + ",\u00a0"), F.lower(F.col("response"))))
    parsed = resp.select("media_seg", "chunk_id", L.parse_response().alias("labels"))
    return parsed.select("media_seg", "chunk_id", F.posexplode("labels").alias("lpos", "label")) \
        .withColumn("lpos", F.col("lpos").cast("bigint"))


@query("collect_predictions")
def q_collect_predictions(spark, sf_dir):
    preds = L.predict(document_texts(spark, sf_dir), vocabulary(spark, sf_dir))
    return preds.select("media_seg", F.posexplode("labels").alias("lpos", "label")) \
        .withColumn("lpos", F.col("lpos").cast("bigint"))


@query("resolve_entities")
def q_resolve_entities(spark, sf_dir):
    res = L.records(document_texts(spark, sf_dir), vocabulary(spark, sf_dir))
    return res.select("media_seg", F.posexplode_outer("predicted_labels").alias("lpos", "l")).select(
        "media_seg", F.col("lpos").cast("bigint").alias("lpos"), F.col("l.strLabel").alias("strLabel"),
        F.col("l.entity").alias("entity"), F.col("l.uriclass").alias("uriclass"))


@query("index_quads")
def q_index_quads(spark, sf_dir):
    """App variant: plain labels, resolved on strLabel, over whole documents."""
    return L.index_flow(document_texts(spark, sf_dir), vocabulary(spark, sf_dir, False))


@query("index_end_to_end")
def q_index_end_to_end(spark, sf_dir):
    """Batch variant, flagship: catalogue -> texts -> qualified labels -> quads."""
    return L.index_flow(catalogue_texts(spark, sf_dir), vocabulary(spark, sf_dir, True))


def offered_word_model(pdf):
    """The built-in rule as an external model: the offered labels whose word part
    occurs in the text, else the no-answer word."""
    import pandas as pd
    out = []
    for text, labels in zip(pdf["text"], pdf["labels"]):
        low = (text or "").lower()
        out.append(", ".join(x for x in labels if x.split("(")[0].lower() in low) or K.NO_ANSWER)
    return pd.Series(out, dtype="object")


@query("classify_plugin")
def q_classify_plugin(spark, sf_dir):
    """X1 through the plug-in path (Arrow batches to a Python model)."""
    v = vocabulary(spark, sf_dir, qualified=False)
    return L.plugin_response(document_texts(spark, sf_dir), v.chunks, v.n_chunks, offered_word_model).select(
        "media_seg", "chunk_id", "response")
