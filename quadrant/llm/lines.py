"""Line dedup by distinct-site spread (operator 4): DataFrame operations only.

A line's spread is the number of distinct sites it occurs on. One HyperLogLog
sketch per line hash is built map-side and merged by the aggregation's shuffle, so
a line that a third of all rows share costs one small sketch per task. Lines whose
estimate lies within the sketch's error of the threshold are counted exactly.
A line on `min_sites` sites or more is cross-site boilerplate: every occurrence is
removed but the first (smallest id, then line number), so that no text is lost
from the corpus.

Lines are the parts between line feeds, compared without surrounding white space
by a 64-bit hash; blank lines are kept and never counted.

Defined cases: null text stays null; an empty text stays empty; a null site is a
site of its own; rows that share an id are treated as one place for the choice of
the first occurrence (they keep the line together); an empty table gives an empty
result; other columns pass untouched and may have any name not starting with
`_ln_`.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrant.llm.common import written

BLANK = " \t\r\x0b\x0c"
MIN_SITES = 10
LG_K = 12


def exploded(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """One row per non-blank line: id, site, position, hash."""
    text, site = F.col(f"`{text_col}`"), F.col(f"`{site_col}`").cast("string")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.concat(F.lit("s"), site), F.lit("null")).alias("site"),
                       F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    line = F.btrim(F.col("line"), F.lit(BLANK))
    return rows.select("id", "site", "pos", line.alias("line")).filter(F.length("line") > 0).select(
        "id", "site", "pos", F.xxhash64("line").alias("h"))


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """lines(id, site, pos, h) -> (h, sites, first) of the lines on `min_sites` sites or more."""
    sketched = (lines.groupBy("h")
                     .agg(F.hll_sketch_agg("site", F.lit(lg_k)).alias("sketch"), F.count("*").alias("n"),
                          F.min(F.struct("id", "pos")).alias("first"))
                     .filter(F.col("n") >= min_sites)  # fewer places than sites wanted: it can't be
                     .select("h", "first", F.hll_sketch_estimate("sketch").alias("sites")))
    band = 1 + math.ceil(4 * 1.04 / math.sqrt(2 ** lg_k) * min_sites)  # four standard errors
    sketched = written(sketched.filter(F.col("sites") >= min_sites - band), "line-sketches")
    near = sketched.filter(F.col("sites") <= min_sites + band)
    exact = (lines.join(near.select("h"), "h", "left_semi").groupBy("h", "site").agg(F.lit(1).alias("one"))
                  .groupBy("h").agg(F.count("*").alias("exact")))
    counted = near.join(exact, "h").filter(F.col("exact") >= min_sites).select("h", "first", F.col("exact").alias("sites"))
    return sketched.filter(F.col("sites") > min_sites + band).select("h", "first", "sites").unionByName(counted)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
                min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """`docs` with boilerplate lines removed from the text, and `_ln_total` and
    `_ln_removed`, the lines before and those removed."""
    lines = exploded(docs, id_col, text_col, site_col)
    found = written(boilerplate(lines, min_sites, lg_k).select("h", "first"), "line-boilerplate")
    hits = lines.join(found, "h").select(
        "id", "h", F.when(F.col("id").eqNullSafe(F.col("first.id")) & (F.col("pos") == F.col("first.pos")), F.struct("h", "pos")).alias("keep"))
    per = hits.groupBy("id").agg(F.collect_set("h").alias("_ln_drop"), F.collect_set("keep").alias("_ln_keep")).withColumnRenamed("id", "_ln_id")
    joined = docs.join(per, F.col(f"`{id_col}`").eqNullSafe(F.col("_ln_id")), "left")
    text = F.col(f"`{text_col}`")
    parts = F.split(text, "\n")
    line = lambda x: F.xxhash64(F.btrim(x, F.lit(BLANK)))
    kept = F.filter(parts, lambda x, i: ~F.array_contains(F.col("_ln_drop"), line(x))  # a place is kept for its line only: ids may repeat
                    | F.array_contains(F.col("_ln_keep"), F.struct(line(x).alias("h"), i.alias("pos"))))
    touched = F.col("_ln_id").isNotNull() | F.col("_ln_drop").isNotNull()
    out = joined.withColumn("_ln_lines", F.when(touched & text.isNotNull(), kept))
    clean = F.when(F.col("_ln_lines").isNotNull(), F.array_join("_ln_lines", "\n")).otherwise(text)
    total = F.coalesce(F.regexp_count(text, F.lit("\n")) + 1, F.lit(0)).cast("long")
    removed = F.when(F.col("_ln_lines").isNotNull(), total - F.size("_ln_lines")).otherwise(F.lit(0)).cast("long")
    return out.select(*[clean.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns],
                      total.alias("_ln_total"), removed.alias("_ln_removed"))
