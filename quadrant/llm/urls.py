"""URL filters (operator 8): path rules first, then gradient-boosted trees on
lexical features, trained from labelled URLs.

Features are DataFrame expressions: lengths, depth, digit ratio, character
entropy, parameter counts, host shape, and how often the labelled URLs with the
same host suffix (last label, last two labels) and first path part were blocked
(smoothed counts). The trees are Spark ML's gradient-boosted classifier.

The suffix tables count all labelled rows, whatever their number: written tables
that grow with the hosts, joined as the planner sees fit. A row that trains the trees
gets them out of fold: without the labelled rows of its own fifth of the URL hashes, so
that its label doesn't reach its features, and a host that was seen once looks like one
never seen. Only the trees are fitted on a bounded sample: about `max_train` different
labelled URLs, those with the smallest hashes.

Defined cases: a null url, or one without `://`, has empty host and path, no rule
and the features of its text (null: of the empty text); repeated rows are judged
alike; with no labelled URL the score is 0.5, with labels of one kind that kind;
an empty table gives an empty result; other columns pass untouched and may have
any name not starting with `_url_`.
"""

from __future__ import annotations

import string

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrant.llm.common import hashed_sample, written

MAX_TRAIN = 20000
TREES, DEPTH, STEP, SEED = 20, 4, 0.2, 7
SUFFIXES = ("_url_s1", "_url_s2", "_url_p1")
FOLDS = 5


def split_url(df: DataFrame, url: str = "url") -> DataFrame:
    """With `_url_host` and `_url_path`."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(F.col(f"`{url}`").cast("string"), F.lit(""))
    host = F.translate(F.regexp_extract(text, pattern, 1), string.ascii_uppercase, string.ascii_lowercase)
    return df.withColumn("_url_host", host).withColumn("_url_path", F.regexp_extract(text, pattern, 2))


def rule_fits(rule: str) -> Column:
    """Does `host/path` fit the split url: the host or a subdomain, and a path
    that starts with the rule's."""
    host, slash, path = rule.partition("/")
    return (((F.col("_url_host") == host) | F.col("_url_host").endswith(f".{host}"))
            & F.col("_url_path").startswith(slash + path))


def with_rule(df: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """With `_url_rule` and `_url_ruled` of the longest rule that fits (verdict,
    host/path); a rule list is configuration, tested in one expression."""
    ordered = sorted(rules, key=lambda r: (-len(r[1]), r[1]))
    if not ordered:
        return df.withColumn("_url_rule", F.lit(None).cast("string")).withColumn("_url_ruled", F.lit(None).cast("string"))
    rule = F.coalesce(*[F.when(rule_fits(r), F.lit(r)) for _, r in ordered])
    verdict = F.element_at(F.create_map(*[F.lit(x) for v, r in ordered for x in (r, v)]), F.col("_url_rule"))
    return df.withColumn("_url_rule", rule).withColumn("_url_ruled", F.when(F.col("_url_rule").isNotNull(), verdict))


def entropy(text: Column) -> Column:
    """Bits a character, from the run lengths of the sorted characters."""
    n = F.greatest(F.length(text), F.lit(1)).cast("double")
    gain = lambda run: F.when(run > 0, run * F.log2(run)).otherwise(F.lit(0.0))
    start = F.struct(F.lit("").alias("c"), F.lit(0.0).alias("run"), F.lit(0.0).alias("sum"))

    def step(s, c):
        same = s["c"] == c
        return F.struct(c.alias("c"), F.when(same, s["run"] + 1.0).otherwise(F.lit(1.0)).alias("run"),
                        F.when(same, s["sum"]).otherwise(s["sum"] + gain(s["run"])).alias("sum"))
    total = F.aggregate(F.array_sort(F.split(text, "")), start, step, lambda s: s["sum"] + gain(s["run"]))
    return F.log2(n) - total / n


def lexical(df: DataFrame, url: str) -> tuple[DataFrame, list[str]]:
    """Split urls with feature columns, and the names of those columns."""
    text = F.coalesce(F.col(f"`{url}`").cast("string"), F.lit(""))
    host, path = F.col("_url_host"), F.col("_url_path")
    query = F.regexp_extract(text, r"(?s)\?([^#]*)", 1)
    count = lambda c, p: F.coalesce(F.regexp_count(c, F.lit(p)), F.lit(0)).cast("double")
    share = lambda c, p: count(c, p) / F.greatest(F.length(c), F.lit(1))
    made = {
        "_url_len": F.length(text).cast("double"), "_url_host_len": F.length(host).cast("double"),
        "_url_path_len": F.length(path).cast("double"), "_url_depth": count(path, "/[^/]"),
        "_url_digits": share(text, "[0-9]"), "_url_path_digits": count(path, "[0-9]"), "_url_entropy": entropy(text),
        "_url_host_entropy": entropy(host), "_url_params": count(query, "[^&]+"), "_url_labels": count(host, "[^.]+"),
        "_url_hyphens": count(host, "-"), "_url_secure": text.startswith("https://").cast("double"),
        "_url_fragment": F.contains(text, F.lit("#")).cast("double"), "_url_slash": path.endswith("/").cast("double"),
        "_url_ext": path.rlike(r"\.[A-Za-z0-9]{1,5}$").cast("double"),
    }
    return with_suffixes(df.withColumns(made)), list(made)


def with_suffixes(df: DataFrame) -> DataFrame:
    """Split urls with the columns of SUFFIXES."""
    host, path = F.col("_url_host"), F.col("_url_path")
    return df.withColumns({"_url_s1": F.substring_index(host, ".", -1), "_url_s2": F.substring_index(host, ".", -2),
                           "_url_p1": F.regexp_extract(path, r"(?s)^/([^/]*)", 1)})


def fold_of(url: str = "url") -> Column:
    return F.pmod(F.shiftright(F.xxhash64(url), 8), F.lit(FOLDS)).cast("int")


def smoothed(blocked: Column, n: Column) -> tuple[Column, Column]:
    """Rate and logarithm of the number."""
    return (blocked + 1.0) / (n + 2.0), F.log1p(n.cast("double"))


def suffix_statistics(labelled: DataFrame) -> dict[str, DataFrame]:
    """By each suffix, the smoothed share of blocked labelled urls and the logarithm
    of their number, over all of `labelled`, and both without each of the folds."""
    def of(key: str) -> DataFrame:
        blocked, n = F.sum("_url_y"), F.count("*")
        rate, size = smoothed(blocked, n)
        out = []
        for i in range(FOLDS):
            own = F.col("_url_fold") == i
            r, m = smoothed(blocked - F.sum(F.when(own, F.col("_url_y")).otherwise(0.0)), n - F.count_if(own))
            out.append(F.struct(r.alias("rate"), m.alias("n")))
        return labelled.withColumn("_url_fold", fold_of()).groupBy(F.col(key).alias(f"{key}_k")).agg(
            rate.alias(f"{key}_rate"), size.alias(f"{key}_n"), F.array(*out).alias(f"{key}_out"))
    return {key: written(of(key), "url-suffixes") for key in SUFFIXES}


def with_suffix_statistics(df: DataFrame, statistics: dict[str, DataFrame], fold: Column | None = None) -> tuple[DataFrame, list[str]]:
    """Joins the statistics of each suffix: over all labelled rows, or without those
    of the row's `fold`."""
    names: list[str] = []
    for key, stats in statistics.items():
        df = df.join(stats if fold is not None else stats.drop(f"{key}_out"), F.col(key) == F.col(f"{key}_k"), "left").drop(f"{key}_k")
        if fold is not None:
            out = F.get(f"{key}_out", fold)
            df = df.withColumns({f"{key}_rate": out["rate"], f"{key}_n": out["n"]}).drop(f"{key}_out")
        df = df.fillna({f"{key}_rate": 0.5, f"{key}_n": 0.0})
        names += [f"{key}_rate", f"{key}_n"]
    return df, names


def judge(pages: DataFrame, rules: list[tuple[str, str]], labelled: DataFrame | None = None, url: str = "url",
          max_train: int = MAX_TRAIN, limit: float = 0.5) -> DataFrame:
    """`pages` with `_url_host`, `_url_path`, `_url_rule`, `_url_score` (of being
    unwanted, 0 to 1) and `_url_verdict`: the rule's, else block from `limit` on.
    `labelled` (url, label: 1 unwanted) trains the trees; without it the pages
    that a rule decides do."""
    ruled = with_rule(split_url(pages, url), rules)
    if labelled is None:
        labelled = ruled.filter(F.col("_url_ruled").isNotNull()).select(
            F.col(f"`{url}`").alias("url"), (F.col("_url_ruled") == "block").cast("int").alias("label"))
    labelled = labelled.filter(F.col("label").isNotNull()).select("url", F.col("label").cast("double").alias("_url_y"))
    sample = labelled.withColumn("_url_h", F.xxhash64("url", "_url_y"))
    sample = written(hashed_sample(sample, "_url_h", max_train).drop("_url_h"), "url-sample")
    sample, columns = lexical(split_url(sample), "url")
    kinds = [r["_url_y"] for r in sample.select("_url_y").distinct().collect()]  # two at most
    out, _ = lexical(ruled, url)
    keep = [F.col(f"`{c}`") for c in pages.columns]
    score = F.lit(float(kinds[0]) if kinds else 0.5)
    if len(kinds) > 1:
        statistics = suffix_statistics(with_suffixes(split_url(labelled)))
        train, more = with_suffix_statistics(sample, statistics, fold_of())
        out, _ = with_suffix_statistics(out, statistics)
        assemble = VectorAssembler(inputCols=columns + more, outputCol="_url_features")
        trees = GBTClassifier(featuresCol="_url_features", labelCol="_url_y", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=SEED)
        model = trees.fit(assemble.transform(train).select("_url_features", "_url_y").coalesce(2))
        model.setPredictionCol("").setRawPredictionCol("").setProbabilityCol("_url_p")
        out = model.transform(assemble.transform(out))
        score = F.get(vector_to_array("_url_p"), F.lit(1))
    verdict = F.coalesce(F.col("_url_ruled"), F.when(F.col("_url_score") >= limit, F.lit("block")).otherwise(F.lit("allow")))
    return (out.withColumn("_url_score", score).withColumn("_url_verdict", verdict)
               .select(*keep, "_url_host", "_url_path", "_url_rule", "_url_score", "_url_verdict"))
