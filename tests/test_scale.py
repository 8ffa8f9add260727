"""Skew: a group holding a third of all rows is numbered / scanned by many
tasks and still gets exact results."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from quadrant.operators.catalog import keep_first
from quadrant.operators.positions import carry_forward, dense_position


def _skewed(spark, n=30000):
    # group 0 holds a third of the rows, the rest spread over 1000 groups
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1).alias("g"),
        ((F.col("id") * 7919) % n).alias("o"), F.col("id"))


def test_dense_position_hot_group(spark):
    df = _skewed(spark)
    got = dense_position(df, ["o", "id"], group=["g"], name="pos", num_partitions=8)
    ref = df.withColumn("ref", F.row_number().over(Window.partitionBy("g").orderBy("o", "id")) - 1)
    j = got.join(ref, ["g", "o", "id"])
    assert j.count() == df.count()
    assert j.where("pos <> ref").count() == 0
    # the hot group is split over several range partitions
    parts = (df.repartitionByRange(8, "g", "o", "id").where("g = 0")
               .select(F.spark_partition_id().alias("p")).distinct().count())
    assert parts > 1


def test_carry_forward_hot_group(spark):
    df = _skewed(spark).withColumn("line_no", F.col("id")).withColumn(
        "head", F.when(F.col("id") % 97 == 0, F.col("id")))
    got = carry_forward(df, ["g"], "line_no", "head", "island", block_rows=1000)
    w = Window.partitionBy("g").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.withColumn("ref", F.max("head").over(w))
    j = got.join(ref.select("id", "ref"), "id")
    assert j.where("NOT (island <=> ref)").count() == 0


def test_keep_first_hot_key(spark):
    df = _skewed(spark)
    got = keep_first(df, "g", ["o", "id"])
    ref = df.groupBy("g").agg(F.min(F.struct("o", "id")).alias("m")).select("g", "m.o", "m.id")
    assert sorted(map(tuple, got.select("g", "o", "id").collect())) == sorted(map(tuple, ref.collect()))


def test_deliver_batches(spark):
    import pandas as pd
    from quadrant.operators.quads import deliver_batches, update_batches
    rows = [(f"http://s/{i}", "http://p", str(i), "http://g", "literal", None, None, i % 2) for i in range(1200)]
    q = spark.createDataFrame(rows, "s string, p string, o string, g string, o_kind string, o_datatype string, "
                                    "o_lang string, bucket long")
    acks = deliver_batches(update_batches(q), lambda reqs: pd.Series([r.startswith("INSERT DATA {") for r in reqs]))
    got = acks.collect()
    assert all(r.ok for r in got) and sum(r.n_quads for r in got) == 1200


def test_lookup_titles_hot_title(spark):
    """A title asked and borne often: its rows are made by many tasks, and not shuffled."""
    from quadrant.functions import constants as K
    from quadrant.operators.catalog import lookup_titles
    # segments 0..299 bear `hot`, the others a title of their own; every media has two segments, media 0 has no url
    title = [("hot" if i < 300 else f"t{i}", i) for i in range(320)]
    rows = [(f"seg{i}", K.DC_TITLE, t, "fr" if i % 10 else "en") for t, i in title]
    rows += [(f"layer{i // 2}", K.CORE_SEGMENT, f"seg{i}", None) for i in range(320)]
    rows += [(f"layer{i}", K.CORE_DOCUMENT, f"m{i}", None) for i in range(160)]
    rows += [(f"m{i}", K.CORE_INSTANCE, f"i{i}", None) for i in range(160)] + [(f"i{i}", K.CORE_HTTP_URL, f"u{i}", None) for i in range(1, 160)]
    quads = spark.createDataFrame(rows, "s string, p string, o string, o_lang string")
    asked = [*[(i, "hot") for i in range(40)], (3, "hot"), (None, "hot"), *[(i, f"t{i}") for i in range(310, 330)], (1, None), (2, "none")]
    titles = spark.createDataFrame(asked, "line_no long, title string").repartition(1)
    want = sorted((str(n), t, f"m{i // 2}", f"u{i // 2}") for n, t in asked for x, i in title if x == t and i % 10 and i > 1)
    for cell in (1, 16, 1000):
        got = lookup_titles(quads, titles, cell=cell)
        assert sorted((str(r.line_no), r.title, r.media, r.url) for r in got.collect()) == want
    got = lookup_titles(quads, titles, cell=16)
    assert got.where("title = 'hot'").select(F.spark_partition_id()).distinct().count() > 1
    top = got._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    assert "Repartition" not in top and got._jdf.queryExecution().optimizedPlan().toString().count("Join Inner") == 1
    assert lookup_titles(quads, titles.where("false")).count() == 0


def test_documents_are_unknown_to_the_driver(spark):
    """One file per key, written and read by the executors; keys, line ends and order as before."""
    import os

    from quadrant.operators import transcripts as TR
    from quadrant.session import work_dir
    keys = [f"k{i}" for i in range(40)] + ["a=b", "x/y:z%20", "[1]*?", "é {q}", "007", "", None]
    rows = [(k, n, f"{k} line {n}") for k in keys for n in range(5)] + [("odd", 0, "a\rb\r\nc\n\nd"), ("odd", 1, None), ("odd", 2, ""), ("odd", 3, "e f\x0bg\r")]
    rows.append(("long", 0, "\r\n".join(["é" * 300_000] * 5)))
    path = work_dir(spark, "documents")
    for _ in range(2):  # the second time replaces the first
        TR.write_documents(spark.createDataFrame(rows, "k string, n int, line string").repartition(5), "k", ["n", "line"], "line", path, num_partitions=6)
    got = TR.read_documents(spark, path, "k")
    assert got.columns == ["k", "line", "line_no"] and got.inputFiles() == []
    found = {}
    for r in got.orderBy("k", "line_no").collect():
        found.setdefault(r.k, []).append(r.line)
        assert r.line_no == len(found[r.k]) - 1
    for k in keys[:-2]:
        assert found[k] == [f"{k} line {n}" for n in range(5)]
    assert sorted(found[None]) == sorted([f" line {n}" for n in range(5)] + [f"None line {n}" for n in range(5)])
    assert found["odd"] == ["a", "b", "c", "", "d", "", "", "e f\x0bg"]
    assert found["long"] == ["é" * 300_000] * 5
    local = path.removeprefix("file:")
    assert len(os.listdir(local)) == len(keys) - 1 + 2 and all(os.listdir(f"{local}/{f}") == ["part-00000.txt"] for f in os.listdir(local))
    # Spark's own reader sees the same
    spark_rows = spark.read.schema("value string, k string").text(path).where("k <> 'long'")
    assert sorted(map(tuple, spark_rows.select("k", "value").collect())) == sorted(tuple(r) for r in got.where("k <> 'long'").select("k", "line").collect())
    TR.write_documents(spark.createDataFrame([], "k string, n int, line string"), "k", ["n"], "line", path)
    assert TR.read_documents(spark, path, "k").count() == 0
