"""Evaluation queries: corpus split, F1, Krippendorff's alpha, confusion matrix."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadrant.operators import evaluate as EV
from quadrant.plans.registry import query
from quadrant.sources import fixtures as FX


def human_labels(spark, sf_dir):
    """Reference decisions (unit, label, value) from the labels table."""
    lab = FX.table(spark, sf_dir, "labels")
    return (lab.select(F.col("doc_id").alias("unit"), F.lit("quality").alias("label"),
                       F.col("quality").cast("bigint").alias("value"))
               .unionByName(lab.select(F.col("doc_id").alias("unit"), F.lit("safe").alias("label"),
                                       (1 - F.col("toxic")).cast("bigint").alias("value"))))


def model_labels(spark, sf_dir):
    """A model's decisions over every document (some documents left unrated)."""
    d = FX.table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return (d.where(F.col("doc_id") % 3 != 0)
             .select(F.col("doc_id").alias("unit"), F.lit("quality").alias("label"),
                     (F.col("n_chars") > 1000).cast("bigint").alias("value"))
             .unionByName(d.where(F.col("doc_id") % 4 != 0)
                           .select(F.col("doc_id").alias("unit"), F.lit("safe").alias("label"),
                                   (F.col("n_chars") <= 3000).cast("bigint").alias("value"))))


@query("corpus_split")
def q_corpus_split(spark, sf_dir):
    d = FX.table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    lab = FX.table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    s = EV.corpus_split(d, lab)
    return s.select("doc_id", "split", "lang", "n_chars",
                    F.col("quality").cast("bigint").alias("quality"), F.col("toxic").cast("bigint").alias("toxic"))


@query("f1_scores")
def q_f1_scores(spark, sf_dir):
    """Scored over the units that humans rated; a document the model left unrated
    counts as a 0 of the model."""
    truth = human_labels(spark, sf_dir)
    return EV.f1_scores(truth, model_labels(spark, sf_dir), universe=truth)


RATER_SETS = {"all": ["quality", "safe", "length"], "quality_length": ["quality", "length"],
              "quality_safe": ["quality", "safe"]}


@query("krippendorff_alpha")
def q_krippendorff_alpha(spark, sf_dir):
    """Alpha for several rater sets at once; 'identical' pairs the quality
    rater with a copy of itself (alpha = 1)."""
    r = FX.raters(spark, sf_dir)
    membership = F.array(*[F.when(F.col("rater").isin(m), F.lit(name)) for name, m in RATER_SETS.items()])
    sets = r.select("unit", "value", F.explode(F.filter(membership, lambda x: x.isNotNull())).alias("raters"))
    q = r.where(F.col("rater") == "quality").select("unit", "value")
    same = q.unionAll(q).withColumn("raters", F.lit("identical"))
    return EV.krippendorff_alpha(sets.unionByName(same), by=["raters"]).select("raters", "alpha", "n_units", "n_values")


@query("confusion_matrix")
def q_confusion_matrix(spark, sf_dir):
    return EV.confusion_matrix(human_labels(spark, sf_dir), model_labels(spark, sf_dir))
