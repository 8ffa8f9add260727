"""Resumed, redone and replayed runs lose nothing and double nothing."""

from pyspark.sql import functions as F

from quadrant.operators import incremental as INC
from quadrant.operators.commits import CommitLog
from quadrant.session import work_dir
from quadrant.streaming import ingest as ST


def test_offset_runs_over_a_growing_input(spark):
    work = work_dir(spark, "t1-grow")
    rows = spark.range(1300).select(F.col("id").alias("pos"))
    res, state = f"{work}/results", f"{work}/state"
    for grown in (rows.where("pos < 700"), rows):
        while INC.run_offset_batch(spark, grown, lambda df: df, res, state):
            pass
    got = spark.read.parquet(res)
    assert got.count() == 1300 == INC.committed_rows(spark, state)
    assert sorted(r.batch_id for r in got.select("batch_id").distinct().collect()) == [0, 500, 700, 1200]


def test_many_offset_runs_by_one_job(spark, monkeypatch):
    """The same partitions, commits and rows as run by run; a death between two commits
    leaves the runs before it, and nothing of the others."""
    import os

    import pytest
    rows = spark.range(2300).select(F.col("id").alias("pos"))
    works, plain = [work_dir(spark, f"t1-jobs-{i}") for i in range(2)], lambda df: df.where("pos % 7 > 0")
    for grown in (rows.where("pos < 700"), rows):
        while INC.run_offset_batch(spark, grown, plain, f"{works[0]}/results", f"{works[0]}/state"):
            pass
    res, state, publish, made = f"{works[1]}/results", f"{works[1]}/state", CommitLog.publish, []

    def dies(log, number, *rest):
        if number == 1 and not made:
            made.append(number)
            raise KeyboardInterrupt
        publish(log, number, *rest)
    with monkeypatch.context() as m:
        m.setattr(CommitLog, "publish", dies)
        with pytest.raises(KeyboardInterrupt):
            INC.run_offset_batches(spark, rows.where("pos < 700"), plain, res, state)
    assert INC.committed_rows(spark, state) == spark.read.parquet(res).agg(F.max("pos")).first()[0] + 1 == 500
    assert INC.run_offset_batches(spark, rows.where("pos < 700"), plain, res, state) == 200
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    assert [INC.run_offset_batches(spark, rows, plain, res, state, runs=2) for _ in range(3)] == [1000, 600, 0]
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - jobs <= 3
    one, many = (sorted(map(tuple, spark.read.parquet(f"{w}/results").select("pos", "batch_id").collect())) for w in works)
    assert one == many and sorted({b for _, b in many}) == [0, 500, 700, 1200, 1700, 2200]
    assert CommitLog(spark, state).latest()[0] == 5 and len(os.listdir(f"{state}.attempts".removeprefix("file:"))) == 1  # of the run that died


def test_death_between_commit_and_rename_among_many_runs(spark, monkeypatch):
    import pytest
    work, rows = work_dir(spark, "t1-death"), spark.range(1200).select(F.col("id").alias("pos"))
    res, state = f"{work}/results", f"{work}/state"

    def die(*_):
        raise KeyboardInterrupt
    with monkeypatch.context() as m:
        m.setattr(CommitLog, "_promote", die)
        with pytest.raises(KeyboardInterrupt):
            INC.run_offset_batches(spark, rows, lambda df: df, res, state)
    assert INC.committed_rows(spark, state) == 500
    assert INC.run_offset_batches(spark, rows, lambda df: df, res, state) == 700
    assert spark.read.parquet(res).select("pos").distinct().count() == spark.read.parquet(res).count() == 1200


def test_interrupted_dated_run_redone_a_day_later(spark):
    work = work_dir(spark, "t2-redo")
    rows = spark.range(1, 32).select(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") - 1).cast("int")).alias("d"))
    res, state = f"{work}/results", f"{work}/state"
    keep = lambda df: df.select(F.col("d").cast("string").alias("d"))
    INC.run_date_batch(spark, rows, "d", "2024-01-11", keep, res, state)
    INC.run_date_batch(spark, rows, "d", "2024-01-21", keep, res, state, commit_state=False)
    INC.run_date_batch(spark, rows, "d", "2024-01-22", keep, res, state)
    got = spark.read.schema("d string, run_date string").parquet(res)
    assert got.count() == got.distinct().count() == got.select("d").distinct().count() == 21


def test_unreadable_state_is_not_a_first_run(spark):
    import os

    import pytest
    path = work_dir(spark, "bad-state")
    with open(os.path.join(path.removeprefix("file:"), "part-0.parquet"), "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception):
        INC.committed_rows(spark, path)


def test_replayed_batches_replace_themselves(spark):
    work = work_dir(spark, "t5-replay")
    recs = spark.createDataFrame([(f"http://example.org/doc/{i}", "b") for i in range(5)], "media string, body string")
    fn = ST.publish_each_batch("media", lambda pdf, attempt: pdf["media"].str.len() > 0, work, f"{work}/state")
    fn(recs, 0)
    fn(recs, 0)
    assert spark.read.parquet(f"{work}/status").count() == 5
    assert spark.read.parquet(f"{work}/state").count() == 1
    keep = ST.keep_first_batches("media", "body", f"{work}/sink")
    keep(recs, 0)
    keep(recs, 1)
    keep(recs, 1)
    assert spark.read.parquet(f"{work}/sink").count() == 5


def test_media_is_the_unit_of_retries(spark):
    work = work_dir(spark, "k8-media")
    recs = spark.createDataFrame([("m1", "s1"), ("m1", "s2"), ("m2", "s3")], "media string, media_seg string")

    def publisher(pdf, attempt):
        return (pdf["media_seg"] != "s2") | (attempt >= 3)
    got = {r.media: (r.status, r.attempts) for r in INC.publish_with_retry(spark, recs, "media", publisher, f"{work}/acks").collect()}
    assert got == {"m1": ("published", 3), "m2": ("published", 1)}


def test_publisher_gets_bounded_batches(spark):
    """Whatever lies in a task: a worker's memory follows the batch, not the input."""
    recs = spark.range(0, 600, 1, 1).select(F.concat(F.lit("m"), F.col("id")).alias("media"), F.repeat(F.lit("s"), 100_000).alias("media_seg"))
    small = lambda pdf, attempt: (pdf["media"] != "") & (pdf["media_seg"].str.len().sum() < 32 << 20)
    status = INC.publish_with_retry(spark, recs, "media", small, f"{work_dir(spark, 'k8-size')}/acks")
    assert [(r.status, r.attempts, r["count"]) for r in status.groupBy("status", "attempts").count().collect()] == [("published", 1, 600)]
