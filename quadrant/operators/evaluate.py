"""Label-agreement scoring: corpus split (E1), F1 (E2), Krippendorff's alpha
(E3) and confusion matrices (E4). All are joins and two-level aggregations:
partial aggregates are combined map-side, nothing is gathered per unit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrant.session import written


def corpus_split(texts: DataFrame, labels: DataFrame, key: str = "doc_id",
                 dev_bucket: int = 8, test_bucket: int = 9, buckets: int = 10) -> DataFrame:
    """Join two corpus outputs and assign train / dev / test by arithmetic
    on the id (stable across runs and engines)."""
    b = F.pmod(F.col(key), F.lit(buckets))
    split = F.when(b == test_bucket, "test").when(b == dev_bucket, "dev").otherwise("train")
    return texts.join(labels, key).withColumn("split", split)


def f1_scores(truth: DataFrame, pred: DataFrame, unit: str = "unit", label: str = "label",
              universe: DataFrame | None = None) -> DataFrame:
    """Per-label, micro and macro precision / recall / F1 of binary decisions
    (unit, label, value). A decision that one side lacks counts as 0 there, so
    positive pairs alone can be given; `universe` (unit) limits the units scored
    (default: those of either side). One pass counts by label; the rest works on
    that table of one row per label."""
    j = truth.select(unit, label, F.col("value").alias("t")).join(
        pred.select(unit, label, F.col("value").alias("p")), [unit, label], "full_outer").fillna(0, ["t", "p"])
    if universe is not None:
        j = j.join(universe.select(unit).distinct(), unit, "left_semi")
    n = lambda t, p: F.count_if((F.col("t") == t) & (F.col("p") == p))
    per = written(j.groupBy(label).agg(n(1, 1).alias("tp"), n(0, 1).alias("fp"), n(1, 0).alias("fn")), "f1")

    def ratios(df):
        tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
        return (df.withColumn("precision", F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0))
                  .withColumn("recall", F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0))
                  .withColumn("f1", F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn)).otherwise(0.0)))

    sums = [F.sum(c).alias(c) for c in ("tp", "fp", "fn")]
    none = F.lit(None).cast("string").alias(label)
    cols = ["scope", label, "tp", "fp", "fn", "precision", "recall", "f1"]
    labels = ratios(per).withColumn("scope", F.lit("label"))
    micro = ratios(per.agg(*sums)).select("*", none, F.lit("micro").alias("scope"))
    macro = labels.agg(*sums, *[F.avg(c).alias(c) for c in ("precision", "recall", "f1")]).select("*", none, F.lit("macro").alias("scope"))
    out = labels.select(cols).unionByName(micro.select(cols)).unionByName(macro.select(cols))
    return out.select("scope", label, "tp", "fp", "fn", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


def krippendorff_alpha(ratings: DataFrame, unit: str = "unit", value: str = "value",
                       by: list[str] | None = None) -> DataFrame:
    """Nominal Krippendorff's alpha for any set of raters, missing ratings
    allowed, computed for every group of `by` (e.g. several rater sets) in one
    pass. With n_uc ratings of value c on unit u, m_u = sum_c n_uc >= 2 and
    n = sum_u m_u:  alpha = 1 - D_o / D_e where
      D_o = sum_u (m_u^2 - sum_c n_uc^2) / (m_u - 1)
      D_e = (n^2 - sum_c n_c^2) / (n - 1).
    A unit is aggregated once and carries its (value, count) list; its own terms
    go with the first of them. Returns (by..., alpha, n_units, n_values)."""
    keep = list(by or [])
    by = keep or ["_all"]
    if not keep:
        ratings = ratings.withColumn("_all", F.lit(0))
    nuc = ratings.groupBy(*by, unit, value).agg(F.count(F.lit(1)).alias("n"))
    units = nuc.groupBy(*by, unit).agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.col("n")).alias("s2"),
                                       F.collect_list(F.struct(F.col(value).alias("c"), "n")).alias("values")).where(F.col("m") >= 2)
    each = units.select(*by, "m", ((F.col("m") * F.col("m") - F.col("s2")) / (F.col("m") - 1)).alias("do"), F.posexplode("values").alias("i", "v"))
    once = lambda c: F.sum(F.when(F.col("i") == 0, c))
    per = each.groupBy(*by, F.col("v.c").alias("c")).agg(F.sum("v.n").alias("nc"), once(F.col("do")).alias("do"),
                                                         once(F.col("m")).alias("n"), once(F.lit(1)).alias("n_units"))
    out = per.groupBy(*by).agg(F.sum(F.col("nc") * F.col("nc")).alias("snc2"), F.sum("do").alias("do"),
                               F.sum("n").alias("n"), F.sum("n_units").alias("n_units"))
    de = (F.col("n") * F.col("n") - F.col("snc2")) / (F.col("n") - 1)
    return out.select(*keep, F.round(F.when(de > 0, 1 - F.col("do") / de), 6).alias("alpha"),
                      F.col("n_units").cast("bigint").alias("n_units"), F.col("n").cast("bigint").alias("n_values"))


def confusion_matrix(truth: DataFrame, pred: DataFrame, unit: str = "unit", label: str = "label") -> DataFrame:
    """Per label, counts of (truth, prediction) as rows with one column per
    predicted value (0 / 1)."""
    j = truth.select(unit, label, F.col("value").alias("truth")).join(
        pred.select(unit, label, F.col("value").alias("pred")), [unit, label])
    m = j.groupBy(label, "truth").pivot("pred", [0, 1]).agg(F.count(F.lit(1)))
    return m.select(label, F.col("truth").cast("bigint").alias("truth"),
                    F.coalesce(F.col("0"), F.lit(0)).cast("bigint").alias("pred_0"),
                    F.coalesce(F.col("1"), F.lit(0)).cast("bigint").alias("pred_1"))
