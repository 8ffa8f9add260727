"""Semantic checks for the keys that have no SQL oracle."""

from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL

Q = E.queries()


def test_work_dirs_are_removed(spark):
    import os
    from quadrant.session import clean_work_dirs, written
    other = spark.newSession()
    path = written(spark.range(3), "gone").inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path)
    from quadrant import session
    kept, session._MADE[:] = list(session._MADE[:-1]), session._MADE[-1:]
    clean_work_dirs(other)
    session._MADE[:] = kept
    assert not os.path.exists(path)


def test_transcribe_plugin_segments_are_contiguous(spark):
    seg = Q["transcribe_plugin"](spark, SF_SMALL)
    w = Window.partitionBy("media_key").orderBy("ord")
    gaps = (seg.withColumn("prev_end", F.lag("end_ms").over(w))
               .where(F.col("prev_end").isNotNull() & (F.col("prev_end") != F.col("start_ms"))))
    assert seg.count() > 0 and gaps.count() == 0
    assert seg.where((F.length("text") == 0) | (F.col("end_ms") <= F.col("start_ms"))).count() == 0


def test_binary_media_one_file_per_media(spark):
    files = Q["src_binary_media"](spark, SF_SMALL)
    assert files.count() == files.select("media").distinct().count() > 0
    assert files.where(F.col("length") <= 0).count() == 0


def test_one_document_file_per_media(spark):
    import glob
    import os
    from quadrant.operators import transcripts as TR
    from quadrant.plans.q_transcripts import seg_keyed
    from quadrant.session import work_dir
    path = work_dir(spark, "srt-files")
    TR.write_documents(TR.srt_cues(seg_keyed(spark, SF_SMALL)), "media_key", ["start_ms", "end_ms", "ord"], "line", path)
    local = path[len("file:"):] if path.startswith("file:") else path
    dirs = glob.glob(os.path.join(local, "media_key=*"))
    assert dirs and all(len(glob.glob(os.path.join(d, "part-*"))) == 1 for d in dirs)
