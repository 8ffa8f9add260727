"""Exact substring ("contains") join without a cartesian product.

`text.contains(pattern)` cannot be hashed directly, so each side is cut into
short substrings (grams, length <= q): every text emits its distinct grams, and
every pattern is keyed by the one gram of its own that is rarest among the
texts (document frequency). Equi-joining on that gram yields a candidate set
that contains every true match; a final `contains` filter makes it exact.
Patterns shorter than q are keyed by themselves (texts emit all substrings of
length 1..q). Candidate volume is the sum, over patterns, of the document
frequency of their rarest gram -- not |patterns| x |texts|.

Empty patterns match every text; callers handle them with an aggregate over
the texts instead of pairing them (see `name_to_media`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Q = 3


def _all_grams(text: F.Column, q: int) -> F.Column:
    """Distinct substrings of length 1..q of `text` (per row, no shuffle)."""
    n = F.greatest(F.length(text), F.lit(1))
    per_pos = F.transform(F.sequence(F.lit(1), n),
                          lambda i: F.array(*[F.substring(text, i, k) for k in range(1, q + 1)]))
    return F.array_distinct(F.filter(F.flatten(per_pos), lambda g: F.length(g) > 0))


def _pattern_grams(pat: F.Column, q: int) -> F.Column:
    """Candidate keys of a pattern: its q-grams, or itself when shorter than q."""
    n = F.length(pat)
    qgrams = F.transform(F.sequence(F.lit(1), F.greatest(n - q + 1, F.lit(1))),
                         lambda i: F.struct(i.alias("gpos"), F.substring(pat, i, q).alias("gram")))
    return F.when(n >= q, qgrams).otherwise(
        F.array(F.struct(F.lit(1).alias("gpos"), pat.alias("gram"))))


def contains_join(left: DataFrame, left_key: list[str], pattern_col: str,
                  right: DataFrame, right_key: list[str], text_col: str, q: int = Q) -> DataFrame:
    """All (left row, right row) with right.text_col containing left.pattern_col.

    Patterns must be non-empty; both columns are compared as given (lower-case
    them first for a case-insensitive match). Returns left_key + pattern +
    right_key + text columns; join the remaining columns back by key.
    """
    lp = left.select(*left_key, F.col(pattern_col).alias("_pat")).where(F.length("_pat") > 0)
    rt = right.select(*right_key, F.col(text_col).alias("_text"))
    r_grams = rt.select(*right_key, F.explode(_all_grams(F.col("_text"), q)).alias("gram"))
    df = r_grams.groupBy("gram").agg(F.count(F.lit(1)).alias("_df"))
    p_grams = lp.select(*left_key, "_pat", F.explode(_pattern_grams(F.col("_pat"), q)).alias("pg")) \
        .select(*left_key, "_pat", F.col("pg.gpos").alias("gpos"), F.col("pg.gram").alias("gram"))
    ranked = p_grams.join(df, "gram", "left").fillna(0, subset=["_df"])
    chosen = ranked.groupBy(*left_key, "_pat").agg(
        F.min_by("gram", F.struct("_df", "gpos")).alias("gram"),
        F.min("_df").alias("_best_df"))
    # a pattern whose rarest gram never occurs cannot match: drop before joining
    cand = chosen.where(F.col("_best_df") > 0).drop("_best_df").join(r_grams, "gram").drop("gram")
    hits = cand.join(rt, right_key).where(F.col("_text").contains(F.col("_pat")))
    return hits.withColumnRenamed("_pat", pattern_col).withColumnRenamed("_text", text_col)
