"""The corpus pipeline: documents -> token ids, in five stages.

STAGES lists (name, function); a function takes (spark, docs, sf_dir), where docs
are the rows that the stage before kept, and returns a DataFrame. All but the
last return the columns of documents. `run` writes each stage's result as Parquet
into the shared folder and rereads it as the next one's docs.

Defined cases are those of the operators; beyond them: extra columns pass through
all stages but the last; a null language is filled by the predicted one; rows that
repeat a doc_id, or have none, are told apart by their texts; an empty table passes
through.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrant.llm import bpe, jaccard, language, lines, mixing
from quadrant.llm.common import read_table, written


def _recounted(docs: DataFrame) -> DataFrame:
    """n_chars follows the text."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised (operator 1)."""
    everyone = F.lit(True)  # every labelled document teaches
    seen = language.identify(docs, everyone, keep=tuple(docs.columns))
    return seen.filter(~F.col("_lid_rejected")).withColumn("lang", F.coalesce("lang", "_lid_lang")).select(*[F.col(f"`{c}`") for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without cross-site boilerplate lines (operator 4)."""
    return _recounted(lines.dedup_lines(docs).select(*[F.col(f"`{c}`") for c in docs.columns]))


def row_key(docs: DataFrame) -> Column:
    """Name of a row by its id and text, in the order of ids (null last)."""
    place = F.lpad((F.col("doc_id").cast("decimal(20,0)") + F.expr(f"{1 << 63}BD")).cast("string"), 20, "0")
    return F.concat(F.coalesce(place, F.lit("~")), F.when(F.col("text").isNull(), "-").otherwise(F.lit(":")), F.md5(F.coalesce("text", F.lit(""))))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates (operator 5): that with the smallest
    id, by row: texts that share an id are told apart, and of rows alike in id and
    text one stays (the smallest in its other columns). Documents without words are in
    no group and stay."""
    keyed = docs.withColumn("_nd_key", row_key(docs))
    found = jaccard.link_components(keyed, n=5, num=80, den=100, id_col="_nd_key")
    kept = found.filter(F.col("component_id") == F.col("_nd_key")).groupBy("_nd_key").agg(
        ((F.count("*") > 1) & (F.max("n_shingles") > 0)).alias("_nd_more"))
    kept = written(kept, "kept")
    out = keyed.join(kept, "_nd_key")
    if kept.filter("_nd_more").isEmpty():
        return out.select(*[F.col(f"`{c}`") for c in docs.columns])
    rows = [F.col(f"`{c}`") for c in docs.columns]
    alike = out.filter("_nd_more").groupBy("_nd_key").agg(F.min(F.struct(*rows)).alias("_nd_row")).select("_nd_row.*")
    return out.filter(~F.col("_nd_more")).select(*rows).unionByName(alike)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of the mix of sources (operator 10)."""
    return _recounted(mixing.mixed_rows(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row (operator 9)."""
    ids = bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

#: SQL can't express the character models, the mix's epochs over them and the
#: tokenizer together; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
