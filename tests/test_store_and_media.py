"""The quad store bucketed by subject, and media files read by byte range."""

import os
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from quadrant.functions import constants as K
from quadrant.operators import catalog as C
from quadrant.sources.media import media_ranges, read_ranges
from quadrant.sources.store import QUAD_COLUMNS, read_store, store_quads
from conftest import SF_SMALL


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_star_join_moves_no_texts(spark, no_broadcast):
    from quadrant.sources.store import catalog_store
    q = catalog_store(spark, SF_SMALL)
    star = (C.pattern(q, K.RDFS_LABEL, "media_seg", "lab1").join(C.pattern(q, K.DC_DESCRIPTION, "media_seg", "presentation"), "media_seg")
            .join(C.pattern(q, K.DC_SUBJECT, "media_seg", "keyword"), "media_seg")
            .groupBy("media_seg", "presentation").agg(F.count("*").alias("n")))
    assert "Exchange" not in plan_of(star)
    for df in (C.text_documents(q), C.temporal_documents(q)):
        keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan_of(df))
        assert keys and all(re.fullmatch(r"(media_seg|media|layer|instance|o)#\d+, \d+", k) for k in keys), keys
        assert "presentation" not in "".join(keys)


def test_store_holds_a_set_of_quads(spark):
    rows = [("a", "p1", "x", "g", "uri", None, None)] * 3 + [("a", "p 2/ü", None, "g", "literal", None, "fr"), (None, "p1", "x", "g", "uri", None, None)]
    quads = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in QUAD_COLUMNS))
    for n in (1, 3):
        back = read_store(spark, store_quads(spark, quads, "set-of-quads", distinct=True, buckets=n))
        assert sorted(map(str, back.collect())) == sorted(map(str, quads.dropDuplicates().collect()))
    empty = read_store(spark, store_quads(spark, quads.limit(0), "no-quads", distinct=True))
    assert empty.columns == QUAD_COLUMNS and empty.count() == 0


def test_buckets_grow_with_the_input(spark):
    """A bucket is one task's share, so its planned size is bounded: 2 GiB make 32 buckets."""
    from quadrant.sources.store import bucket_count
    assert bucket_count(spark, spark.range(1 << 28)) >= 32
    assert bucket_count(spark, spark.range(10)) == spark.sparkContext.defaultParallelism


def test_ranges_rebuild_every_file(spark):
    folder = tempfile.mkdtemp(prefix="quadrant-media-")
    files = {"a.bin": bytes(range(256)) * 41, "b c+é%20.bin": b"\x00" * 1000, "exact.bin": b"x" * 3000, "none.bin": b"", "other.txt": b"no"}
    os.mkdir(f"{folder}/deep")
    for name, content in files.items():
        with open(f"{folder}/deep/{name}", "wb") as f:
            f.write(content)
    got = read_ranges(media_ranges(spark, folder, range_bytes=1000, suffix="*.bin")).collect()
    assert max(len(r["content"]) for r in got) == 1000
    built = {}
    for r in sorted(got, key=lambda r: (r["path"], r["start"])):
        assert r["start"] == r["range_no"] * 1000 and r["n_bytes"] == len(r["content"])
        name = r["path"].rsplit("/", 1)[1]
        assert r["length"] == len(files[name])
        built[name] = built.get(name, b"") + bytes(r["content"])
    assert built == {n: c for n, c in files.items() if n.endswith(".bin") and c}
    assert len([r for r in got if r["path"].endswith("a.bin")]) == 11


def test_a_shortened_file_fails(spark):
    folder = tempfile.mkdtemp(prefix="quadrant-media-")
    with open(f"{folder}/a.bin", "wb") as f:
        f.write(b"abc" * 1000)
    rows = media_ranges(spark, folder, range_bytes=1000).withColumn("n_bytes", F.col("n_bytes") + 5000)
    with pytest.raises(Exception, match="bytes at"):
        read_ranges(rows).collect()
