"""Document fingerprints (operator 3) from closed syncmers: DataFrame operations only.

A k-mer (k bytes of the UTF-8 text) is a closed syncmer if the smallest hash among
its inner s-byte substrings stands at its first or last place. The choice looks at
nothing beyond the k-mer itself, so the syncmers of a text are the union of those
of any parts that overlap by k - 1 bytes: an edit changes only syncmers that touch
it, parts can be fingerprinted separately and put together, and memory is bounded
by a block of the text whatever its length.

The fingerprint is the bottom sketch of the syncmers: their `size` smallest
distinct hashes, in hexadecimal. The likeness of two fingerprints estimates the
Jaccard similarity of the syncmer sets from the `size` smallest hashes of both
(exact when both texts have fewer syncmers).

`fingerprint_edits` compares each text with an edited one (its last third
replaced by the first part of the next document in descending id order) and with
that next document. Documents are dealt to range buckets of ids; the first row of
each bucket is given to the bucket before it as a guest, so that every row finds
its successor within its bucket and texts are shuffled once.

Defined cases: a null text counts as empty; a text without a closed syncmer
(shorter than k bytes, or a few more) has the hash of the whole text instead, an
empty one too (so two empty texts have likeness 1); texts of any
length are read whole, block by block; a null id comes last, rows that share an id
are ordered by a hash of their text (the successor of a repeated row may be its
repetition; equal rows stay separate rows); a table of one row has itself as next;
an empty table gives an empty result; only the id and text columns are read, so
any other column may have any name.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrant.llm.common import borders, bucket_of, shuffle_partitions, written

K, S = 12, 6
SIZE = 64
BLOCK = 4096


def let(value: Column, body) -> Column:
    """body(value) with the value computed once a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def bottom(hashes: Column, size: int) -> Column:
    return F.slice(F.array_sort(F.array_distinct(hashes)), 1, size)


def sketch(raw: Column, size: int = SIZE, k: int = K, s: int = S, block: int = BLOCK) -> Column:
    """The `size` smallest hashes of the closed syncmers of a binary column. Blocks
    of `block` k-mers are reduced one by one."""
    return let(raw, lambda bound: _sketch(bound, size, k, s, block))


def _sketch(raw: Column, size: int, k: int, s: int, block: int) -> Column:
    w = k - s + 1  # inner substrings of a k-mer
    n = F.octet_length(raw)

    def closed(h: Column):
        """Is the first or the last of the w hashes from i on no larger than any
        other? Neighbours are asked first: most places fail at one of them."""
        def test(i: Column) -> Column:
            at = [F.get(h, i + j) if j else F.get(h, i) for j in range(w)]
            return reduce(and_, [at[0] <= x for x in at[1:]]) | reduce(and_, [at[-1] <= x for x in at[-2::-1]])
        return test

    def of_part(part: Column) -> Column:
        def choose(h: Column) -> Column:
            places = F.filter(F.sequence(F.lit(0), F.size(h) - w), closed(h))
            return bottom(F.transform(places, lambda i: F.xxhash64(F.substring(part, i + 1, F.lit(k)))), size)
        return let(F.transform(F.sequence(F.lit(0), F.octet_length(part) - s), lambda i: F.xxhash64(F.substring(part, i + 1, F.lit(s)))), choose)

    def of_block(start: Column) -> Column:
        return let(F.substring(raw, start + 1, F.lit(block + k - 1)), of_part)
    blocks = F.transform(F.sequence(F.lit(0), n - k, F.lit(block)), of_block)
    return F.when(n >= k, bottom(F.flatten(blocks), size)).otherwise(F.array().cast("array<bigint>"))


def anchored(hashes: Column, raw: Column) -> Column:
    """A text without any closed syncmer is its own only anchor."""
    return F.when(F.size(hashes) > 0, hashes).otherwise(F.array(F.xxhash64(raw)))


def together(a: Column, b: Column, size: int = SIZE) -> Column:
    """Sketch of a text from those of two parts that overlap by k - 1 bytes."""
    return bottom(F.concat(a, b), size)


def likeness(a: Column, b: Column, size: int = SIZE) -> Column:
    """Estimated Jaccard similarity of two sketches."""
    union = let(bottom(F.concat(a, b), size), lambda u: F.size(F.array_intersect(F.array_intersect(u, a), b)) / F.size(u).cast("double"))
    return union


def as_text(hashes: Column) -> Column:
    return F.array_join(F.transform(hashes, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def with_guests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, text, bucket, guest: the rows in range buckets of their ids, dealt by
    bucket; the first row of each bucket (largest id) is also a guest in the bucket
    above, that of the highest in the lowest."""
    n = shuffle_partitions(docs.sparkSession)
    ids = F.col(f"`{id_col}`").cast("long")
    cuts = borders(docs, id_col, 16 * n)
    heads = (docs.select(ids.alias("id")).withColumn("bucket", bucket_of(F.col("id"), cuts))
                 .groupBy("bucket").agg(F.max("id").alias("_h")))
    up = Window.orderBy("bucket")
    lowest = F.first("bucket").over(up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = written(heads.select(F.col("bucket").alias("_b"), "_h", F.coalesce(F.lead("bucket").over(up), lowest).alias("above")), "fingerprint-heads")
    rows = docs.select(ids.alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")).withColumn("bucket", bucket_of(F.col("id"), cuts))
    # heads: 16 n + 1 rows of three numbers at most, n set by the cluster
    rows = rows.join(F.broadcast(heads), (F.col("bucket") == F.col("_b")) & F.col("id").eqNullSafe(F.col("_h")), "left")
    here = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guest"))
    there = F.struct(F.col("above").alias("bucket"), F.lit(True).alias("guest"))
    rows = rows.withColumn("at", F.explode(F.when(F.col("_b").isNull(), F.array(here)).otherwise(F.array(here, there))))
    return rows.select(F.col("at.bucket").alias("bucket"), F.col("at.guest").alias("guest"), "id", "text").repartition(n, "bucket")


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: id, n_chars, edited (the edited text), sketches
    `own` and `other` (of the edited text), and `next_own` (the next document's)."""
    rows = with_guests(docs, id_col, text_col).withColumn("raw", F.encode("text", "UTF-8")).withColumn("n_chars", F.length("text"))
    rows = rows.withColumn("kept", F.substring("text", F.lit(1), (F.col("n_chars") - F.floor(F.col("n_chars") / 3)).cast("int")))
    rows = rows.withColumn("head", F.octet_length("kept"))
    # what stands before the cut is fingerprinted once, for the text and its edited form
    rows = rows.withColumn("before", sketch(F.substring("raw", F.lit(1), F.col("head"))))

    def completed(raw: str) -> Column:
        rest = F.substring(F.col(raw), F.greatest(F.col("head") - (K - 2), F.lit(1)), F.octet_length(raw))
        return let(together(F.col("before"), sketch(rest)), lambda h: anchored(h, F.col(raw)))
    rows = rows.withColumn("own", completed("raw"))
    order = Window.partitionBy("bucket").orderBy("guest", F.col("id").desc_nulls_last(), F.xxhash64("text"))
    rows = rows.withColumn("next", F.lead("text").over(order)).withColumn("next_own", F.lead("own").over(order)).filter(~F.col("guest"))
    rows = rows.withColumn("edited", F.concat("kept", F.substring("next", F.lit(1), F.floor(F.col("n_chars") / 3).cast("int"))))
    rows = rows.withColumn("raw_edited", F.encode("edited", "UTF-8")).withColumn("other", completed("raw_edited"))
    return rows.select("id", "n_chars", "edited", "own", "other", "next_own").withColumnRenamed("id", id_col)
