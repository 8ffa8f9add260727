"""Mixing sources to target weights (operator 10): DataFrame operations only.

Every row gets a hash-random key (md5 of seed and id). Keys are uniform, so their
first hex digits cut each source into even range buckets whatever its size: word
sums per (source, bucket) give the distributed prefix sums, one bucket per source
holds the cut, and only that bucket's rows are sorted.

Targets: the sources in code-point order (null last) take the weights in turn and
share `share` times all words. A target stops at `max_epochs` times its source;
the excess goes to the others by weight until none is above (water-filling, solved
in closed form over the per-source table, one row per source). A target is met by
whole epochs of the source and then by the rows with the smallest keys; the row at
the border gives just the words that are missing, so the words taken differ from
the target by less than one.

Defined cases: null source is a source of its own; null, empty and blank texts
have size 0 and give nothing; repeated rows are rows of their own (equal keys:
ordered by id and size, which tie only when the rows are equal for the mix);
a null id is keyed like the empty text; an empty table gives an empty result;
other columns pass untouched and may have any name not starting with `_mix_`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrant.llm.common import written

WORD = r"[^\x20\x09-\x0D]+"
#: 16 ** BUCKET_DIGITS range buckets per source; a cut bucket holds about that
#: fraction of its source's rows.
BUCKET_DIGITS = 3


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix_key(id_: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(id_.cast("string"), F.lit(""))))


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, max_epochs: float) -> DataFrame:
    """sizes(source, source_size), one row per source -> with `target`."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    t = sizes.withColumn("w", F.get(F.array(*[F.lit(float(w)) for w in weights]),
                                    (F.row_number().over(order) - 1) % len(weights)))
    t = t.withColumn("cap", F.lit(float(max_epochs)) * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("w"))
    every = Window.partitionBy()
    before = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    t = (t.withColumn("total", F.lit(float(share)) * F.sum("source_size").over(every))
          .withColumn("w_all", F.sum("w").over(every))
          .withColumn("c0", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
          .withColumn("w0", F.coalesce(F.sum("w").over(before), F.lit(0.0)))
          .withColumn("full", F.col("ratio") <= (F.col("total") - F.col("c0")) / (F.col("w_all") - F.col("w0"))))
    spent = F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(every), F.lit(0.0))
    w_spent = F.coalesce(F.sum(F.when(F.col("full"), F.col("w"))).over(every), F.lit(0.0))
    return (t.withColumn("spent", spent).withColumn("w_spent", w_spent)
             .select("source", "source_size",
                     F.when(F.col("full"), F.col("cap"))
                      .otherwise((F.col("total") - F.col("spent")) * F.col("w") / (F.col("w_all") - F.col("w_spent")))
                      .alias("target")))


def cuts(slim: DataFrame, weights: tuple[float, ...], share: float, max_epochs: float) -> DataFrame:
    """slim(source, size, bucket) -> one row per source: its size, target, whole
    epochs, the bucket that holds the cut and the words still wanted from it."""
    per = slim.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    targets = source_targets(per.groupBy("source").agg(F.sum("n").alias("source_size")), weights, share, max_epochs)
    targets = (targets.withColumn("budget", F.floor("target"))
                      .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size")))
                                  .otherwise(F.lit(0)).cast("long"))
                      .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size")))
    upto = Window.partitionBy("source").orderBy("bucket")
    run = per.withColumn("after", F.sum("n").over(upto))
    t = targets.alias("t")
    # the cut lies in the first bucket that goes beyond the rest (none if the rest is 0)
    hit = (run.alias("r").join(t, F.col("r.source").eqNullSafe(F.col("t.source")))
              .filter((F.col("after") > F.col("rest")) & (F.col("after") - F.col("n") <= F.col("rest")) & (F.col("n") > 0))
              .select(F.col("r.source").alias("s"), F.col("bucket").alias("cut"), (F.col("rest") - F.col("after") + F.col("n")).alias("want")))
    return (targets.join(hit, targets["source"].eqNullSafe(hit["s"]), "left").drop("s", "budget", "rest"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, max_epochs: float = 2.0,
        seed: str = "mix", keep: tuple[str, ...] | None = None) -> DataFrame:
    """`docs` with `_mix_size`, `_mix_source_size`, `_mix_target` and `_mix_taken`
    (words the mix takes from the row, repeats counted). `keep` narrows the columns."""
    key = mix_key(F.col(f"`{id_col}`"), seed)
    slim = written(docs.select(F.col(f"`{source_col}`").alias("source"), words_of(F.col(f"`{text_col}`")).alias("size"),
                               F.substring(key, 1, BUCKET_DIGITS).alias("bucket"), F.col(f"`{id_col}`").alias("id"),
                               key.alias("key")), "mix-slim")
    cut = written(cuts(slim, weights, share, max_epochs).coalesce(1).select(  # one row per source
        F.col("source").alias("_mix_s"), F.col("source_size").alias("_mix_source_size"), F.col("target").alias("_mix_target"),
        F.col("epochs").alias("_mix_epochs"), F.col("cut").alias("_mix_cut"), F.col("want").alias("_mix_want")), "mix-cuts")
    cols = list(keep if keep is not None else docs.columns)
    if set(cols) <= {id_col, source_col}:  # no need to read the texts again
        rows = slim.select(F.col("id").alias(id_col), F.col("source").alias(source_col), F.col("size").alias("_mix_size"), F.col("key").alias("_mix_key"))
    else:
        rows = docs.select(*[F.col(f"`{c}`") for c in cols], words_of(F.col(f"`{text_col}`")).alias("_mix_size"), key.alias("_mix_key"))
    src = F.col(f"`{source_col}`")
    rows = (rows.join(cut, src.eqNullSafe(F.col("_mix_s")))
                .withColumn("_mix_bucket", F.substring("_mix_key", 1, BUCKET_DIGITS)))
    at_cut = F.coalesce(F.col("_mix_bucket") == F.col("_mix_cut"), F.lit(False))
    first = F.coalesce(F.col("_mix_bucket") < F.col("_mix_cut"), F.lit(False)).cast("long")
    whole = rows.filter(~at_cut).withColumn("_mix_taken", (F.col("_mix_epochs") + first) * F.col("_mix_size"))
    upto = (Window.partitionBy(source_col, "_mix_bucket").orderBy("_mix_key", id_col, "_mix_size")
                  .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    part = rows.filter(at_cut).withColumn("_mix_before", F.sum("_mix_size").over(upto) - F.col("_mix_size"))
    part = part.withColumn("_mix_taken", F.col("_mix_epochs") * F.col("_mix_size") + F.greatest(
        F.lit(0), F.least(F.col("_mix_size"), F.col("_mix_want") - F.col("_mix_before")))).drop("_mix_before")
    return whole.unionByName(part).select(*[F.col(f"`{c}`") for c in cols], "_mix_size", "_mix_source_size", "_mix_target", "_mix_taken")


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **params) -> DataFrame:
    """The mix itself, with the columns of `docs`: a row for each whole epoch, and
    for the one row at a source's border its first words up to the budget (joined
    by one space)."""
    taken = mix(docs, id_col, text_col, source_col, **params)
    words = F.regexp_extract_all(F.col(f"`{text_col}`"), F.lit(f"({WORD})"), F.lit(1))
    size = F.nullif(F.col("_mix_size"), F.lit(0))
    left = F.col("_mix_taken") % size
    sized = taken.filter(F.col("_mix_taken") > 0)
    whole = (sized.withColumn("_mix_i", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.floor(F.col("_mix_taken") / size)).cast("int"))))
                  .filter(F.col("_mix_taken") >= F.col("_mix_size")))
    part = sized.filter(left > 0).withColumn(text_col, F.array_join(F.slice(words, F.lit(1), left.cast("int")), " "))
    return whole.drop("_mix_i").unionByName(part).select(*[F.col(f"`{c}`") for c in docs.columns])
