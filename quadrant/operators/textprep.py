"""Text preparation: presentation merge (A2), dedupes (A3, A4), qualified
labels (P1), classification text (P2), catalogue rows from URI lists (P3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrant.functions import constants as K
from quadrant.functions.expressions import qualified_label
from quadrant.operators.catalog import keep_first


def dedupe_tokens(col: str) -> F.Column:
    """'a | b | a' -> 'a | b' (first occurrence order kept)."""
    return F.array_join(F.array_distinct(F.split(F.col(col), r" [|] ")), " | ")


def merge_presentations(rows: DataFrame, key: str = "media", col: str = "presentation") -> DataFrame:
    """A2: per-row token dedupe, then every row of a media gets the sorted,
    distinct whole strings of that media joined by ' | '.

    groupBy + join rather than a window: the collect_set is combined map-side,
    and a media holding a large share of rows is split by AQE's skew join
    instead of landing in one window task.
    """
    r = rows.withColumn(col, dedupe_tokens(col))
    merged = r.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(col)), " | ").alias("_merged"))
    return r.join(merged, key).withColumn(col, F.col("_merged")).drop("_merged")


def vocab_dedupe(vocab: DataFrame) -> DataFrame:
    """A4: full-row dedupe keeping the first file position."""
    cols = [c for c in vocab.columns if c != "ord"]
    return vocab.groupBy(cols).agg(F.min("ord").alias("ord")).select(["ord"] + cols)


def with_qualified(vocab: DataFrame) -> DataFrame:
    """vocas = strLabel(subclass)."""
    return vocab.withColumn("vocas", qualified_label("strLabel", "subclass"))


def classification_text(rows: DataFrame) -> DataFrame:
    """Label + presentation + keyword marker + keywords (null-propagating)."""
    return rows.withColumn("text", F.concat(F.col("lab"), F.lit(" "), F.col("presentation"),
                                            F.lit(K.KEYWORD_MARKER), F.col("keywords")))


def catalog_from_uris(uris: DataFrame) -> DataFrame:
    """url = uri + '/document'; media = ':' + last path part + 'v1'."""
    return uris.select(
        "uri_s",
        F.concat(F.col("uri_s"), F.lit("/document")).alias("url"),
        F.concat(F.lit(":"), F.element_at(F.split(F.col("uri_s"), "/"), -1), F.lit("v1")).alias("media"),
    )


def dedupe_keep_first(rows: DataFrame, key: str = "media", order: str = "ord") -> DataFrame:
    """A3: first row per key in source order."""
    return keep_first(rows, key, [order])
