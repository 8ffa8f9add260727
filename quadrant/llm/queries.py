"""The registered opN queries: thin wrappers over the operators and given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrant.llm import alignment, bpe, conversations, dac, jaccard, language, licences, lines, mixing, suffixes, syncmers, urls, vptree
from quadrant.llm.common import read_table


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those not held out."""
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
    out = language.identify(read_table(spark, sf_dir, "documents"), ~held_out)
    return out.select("doc_id", held_out.alias("held_out"), F.col("_lid_lang").alias("lang_pred"), F.col("_lid_score").alias("score"),
                      F.col("_lid_rejected").alias("rejected"), F.col("_lid_entropy").alias("cross_entropy"))


def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases, identifier tags and expressions of every document."""
    out = licences.scan_licences(read_table(spark, sf_dir, "documents"))
    base = F.filter("hits", lambda h: h["kind"] == "base")
    names = lambda hits: F.array_join(F.array_sort(F.array_distinct(F.filter(
        F.transform(hits, lambda h: h["label"]), lambda x: x.isNotNull()))), ",")
    weight = F.create_map(*[F.lit(x) for pair in licences.WEIGHT.items() for x in pair])
    kinds = F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["kind"])))
    doubt = F.aggregate(kinds, F.lit(1.0), lambda acc, k: acc * (1.0 - weight[k]))
    return out.select("doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
                      F.array_min(F.transform(base, lambda h: h["word"])).alias("first_word"),
                      F.array_max(F.transform(base, lambda h: h["word"])).alias("last_word"),
                      names(base).alias("base_labels"), names(F.col("hits")).alias("labels"), (1.0 - doubt).alias("score"),
                      F.array_join(F.transform("expressions", lambda e: F.concat(e["level"], F.lit(": "), F.array_join(e["rpn"], " "))), "; ").alias("expressions"))


def op3_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    out = syncmers.fingerprint_edits(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("n_chars").cast("long").alias("n_chars"), F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
                      syncmers.as_text(F.col("own")).alias("fingerprint"), syncmers.as_text(F.col("other")).alias("edited_fingerprint"),
                      syncmers.likeness(F.col("own"), F.col("other")).alias("near_edited"),
                      syncmers.likeness(F.col("own"), F.col("next_own")).alias("near_next"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without cross-site boilerplate lines."""
    out = lines.dedup_lines(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "text", F.col("_ln_total").alias("n_lines"), F.col("_ln_removed").alias("n_removed"))


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingle sets are 0.85 alike."""
    return jaccard.link_components(read_table(spark, sf_dir, "documents"), n=4, num=85, den=100)


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    return vptree.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, factor=1.0)


def word_bpe() -> str:
    """The tokenizer file of the queries."""
    return public_tokenizers.path("word_bpe_49k.json")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, from the files written for them."""
    manifest, folder = dac.store_tokens(read_table(spark, sf_dir, "documents"), word_bpe(), end_id=2)
    return dac.read_files(manifest, folder)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of their decoded text."""
    return bpe.encode_and_decode(read_table(spark, sf_dir, "documents"), word_bpe())


#: (verdict, host/path); fixed by the query's contract.
URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    out = urls.judge(read_table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return out.select("page_id", F.col("_url_host").alias("host"), F.col("_url_path").alias("path"), F.col("_url_rule").alias("rule"),
                      F.col("_url_verdict").alias("verdict"), F.col("_url_score").alias("score"))


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from each document."""
    out = mixing.mix(read_table(spark, sf_dir, "documents"), keep=("doc_id", "source"))
    return out.select("doc_id", F.col("_mix_size").alias("size"), F.col("_mix_source_size").alias("source_size"),
                      F.col("_mix_target").alias("target"), F.col("_mix_taken").alias("taken"), "source")


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the bytes of 50-byte strings that a smaller doc_id has."""
    out = suffixes.remove_repeats(read_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers' tokens in every document."""
    return alignment.align(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation, after a fixed damage."""
    rows = read_table(spark, sf_dir, "conversations")
    found, blocks = conversations.repair(conversations.damage(rows))
    out = conversations.digests(blocks, found)
    ck = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    every = rows.select("conv_id").distinct().withColumn("ck", ck)  # conversations that lost all rows stay
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(out, "ck", "left").select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                                                F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language": op1_language,
    "op2_licences": op2_licences,
    "op3_syncmers": op3_syncmers,
    "op4_line_dedup": op4_line_dedup,
    "op5_jaccard": op5_jaccard,
    "op6_nearest": op6_nearest,
    "op7_token_files": op7_token_files,
    "op8_urls": op8_urls,
    "op9_bpe": op9_bpe,
    "op10_mix": op10_mix,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_alignment": op12_alignment,
    "op13_conversations": op13_conversations,
}
