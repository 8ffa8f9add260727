"""Versioned archive, keyed stream state, stores changed in place, the N-Quads grammar,
commit log and delivery sink."""

import os

import pytest
from pyspark.sql import functions as F

from quadrant.functions import constants as K
from quadrant.operators import incremental as INC
from quadrant.operators import quads as QD
from quadrant.operators.commits import CommitConflict, CommitLog
from quadrant.session import work_dir
from quadrant.sources import delivery as DL
from quadrant.sources import files as FS
from quadrant.sources.store import QUAD_COLUMNS, GraphStore
from quadrant.streaming import ingest as ST


def local(path):
    return path.removeprefix("file:")


def put(folder, name, body, at=None):
    os.makedirs(local(folder), exist_ok=True)
    path = f"{local(folder)}/{name}{K.TRANSCRIPT_FILE_SUFFIX}"
    with open(path, "w", encoding="utf-8") as f:
        f.write(body)
    if at:
        os.utime(path, (at, at))
    return path


def one(text):
    return f'[{{"start": 0.5, "end": 1.5, "text": "{text}"}}]'


# ---------------------------------------------------------------- K10, S2
def test_corrected_file_under_the_same_name(spark):
    work = work_dir(spark, "again")
    inbox, sink, ckpt, archive = (f"{work}/{x}" for x in ("inbox", "sink", "ckpt", "archive"))

    def run():
        ST.ingest_and_archive(spark, inbox, sink, ckpt, archive)
        return {r.media_key: r.text for r in ST.latest_segments(spark, sink).collect()}
    put(inbox, "m1", one("first"), 1_700_000_000)
    put(inbox, "m2", one("other"), 1_700_000_000)
    assert run() == {"m1": "first", "m2": "other"}
    put(inbox, "m1", one("corrected"), 1_700_000_100)
    assert run()["m1"] == "corrected"
    assert FS.list_files(spark, archive).count() == 3 and not os.listdir(local(inbox))
    # the same delivery once more (name, time, length): taken out of the inbox, not ingested twice
    put(inbox, "m1", one("corrected"), 1_700_000_100)
    assert run()["m1"] == "corrected" and FS.list_files(spark, archive).count() == 3 and not os.listdir(local(inbox))
    assert spark.read.parquet(f"{sink}/segments").count() == 3
    log = spark.read.parquet(f"{archive}.log").groupBy("status").count().collect()
    assert {r.status: r["count"] for r in log} == {"moved": 6, "known": 1}


def test_claims_of_a_run_that_died(spark):
    work = work_dir(spark, "died")
    inbox, sink, ckpt, archive = (f"{work}/{x}" for x in ("inbox", "sink", "ckpt", "archive"))
    for path in (inbox, f"{archive}.claimed", archive):
        ST.make_dir(spark, path)
    put(inbox, "m1", one("first"))
    put(inbox, "empty", "")
    ST.claim_files(spark, inbox, f"{archive}.claimed", archive, f"{archive}.log")  # and then nothing
    put(inbox, "m2", one("second"))
    ST.ingest_and_archive(spark, inbox, sink, ckpt, archive)
    assert {r.text for r in ST.latest_segments(spark, sink).collect()} == {"first", "second"}
    assert FS.list_files(spark, archive).count() == 3 and FS.list_files(spark, f"{archive}.claimed").count() == 0


def test_archive_in_bounded_batches(spark, monkeypatch):
    """The driver knows the names of one micro-batch's files only; names are no patterns; a
    run that died between its batches is continued, and nothing is ingested twice."""
    monkeypatch.setattr(ST, "BATCH_FILES", 2, raising=False)
    work = work_dir(spark, "bounded")
    inbox, sink, ckpt, archive = (f"{work}/{x}" for x in ("inbox", "sink", "ckpt", "archive"))
    names = ["m1", "m[2]", "m{3,4}", "k=v", "with space", "100%25", "m*"]
    for name in names:
        put(inbox, name, one(name))
    put(inbox, "cut", one("x")[:-4])
    tries = []
    with monkeypatch.context() as m:
        def write_batch(*args, write=ST.write_batch):
            tries.append(args[1])
            if args[1] == 2:
                raise RuntimeError("out of power")
            write(*args)
        m.setattr(ST, "write_batch", write_batch)
        with pytest.raises(Exception, match="out of power"):
            ST.ingest_and_archive(spark, inbox, sink, ckpt, archive)
    assert max(tries) == 2 and FS.list_files(spark, archive).count() == 0
    put(inbox, "late", one("late"))
    ST.ingest_and_archive(spark, inbox, sink, ckpt, archive)
    ST.ingest_and_archive(spark, inbox, sink, ckpt, archive)  # nothing new
    got = spark.read.parquet(f"{sink}/segments")
    assert sorted(r.text for r in got.collect()) == sorted([*names, "late"])
    bad = spark.read.parquet(f"{sink}/rejects")
    assert [(r.media_key, r.reason) for r in bad.collect()] == [("cut", "damaged file")]
    files = got.select("file", "batch_id").unionByName(bad.select("path", "batch_id").withColumnRenamed("path", "file"))
    assert files.groupBy("batch_id").count().agg(F.max("count")).first()[0] <= 2
    assert FS.list_files(spark, archive).count() == 9 and FS.list_files(spark, f"{archive}.claimed").count() == 0


def test_damaged_transcripts(spark):
    path = work_dir(spark, "damaged")
    put(path, "whole", one("a"))
    put(path, "cut", one("b")[:-3])
    put(path, "error", '{"error": "busy"}')
    put(path, "none", "[]")
    put(path, "verbose", '{"segments": [null, {"start": 1, "end": 2, "text": null}]}')
    put(path, "word", '[{"start": "soon", "end": 2, "text": "c"}]')
    put(path, "empty", "")
    put(path, "sure", '[{"start": 1, "end": 2, "text": "d", "confidence": "high"}]')
    assert sorted((r.media_key, r.start_ms) for r in FS.read_segment_files(spark, path).collect()) == [("verbose", 1000), ("whole", 500)]
    bad = {(r.media_key, r.reason) for r in FS.rejected_segment_files(spark, path).collect()}
    assert bad == {("cut", "damaged file"), ("error", "no segments"), ("verbose", "no times"), ("word", "no times"), ("empty", "empty file"), ("sure", "damaged file")}


# ---------------------------------------------------------------- T4
def test_keyed_state_expires(spark):
    work = work_dir(spark, "state")
    schema = "k string, n long, at timestamp"
    os.makedirs(local(f"{work}/in"))
    stream = spark.readStream.schema(schema).parquet(f"{work}/in")
    sizes = []

    def run(rows):
        df = spark.createDataFrame(rows, "k string, n long, day string").select("k", "n", F.to_timestamp("day").alias("at"))
        df.write.mode("append").parquet(f"{work}/in")
        q = (ST.keep_first_stream(stream, "k", "n", "at", "10 days").writeStream.format("parquet").option("path", f"{work}/out")
             .option("checkpointLocation", f"{work}/ckpt").outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()
        sizes.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
    run([("a", 2, "2024-01-01"), ("a", 1, "2024-01-02"), ("b", 5, "2024-01-01"), (None, 1, "2024-01-01")])
    run([("a", 0, "2024-01-03"), ("b", 6, "2024-01-02"), ("c", 1, "2024-01-03")])
    for month in range(2, 7):
        run([(f"x{month}", 1, f"2024-{month:02d}-01"), (f"x{month}", 0, f"2024-{month:02d}-02")])
    got = sorted((r.k or "", r.n) for r in spark.read.schema(schema).parquet(f"{work}/out").collect())
    assert got == [("", 1), ("a", 1), ("b", 5), ("c", 1), *[(f"x{m}", 0) for m in range(2, 7)]]
    assert max(sizes) >= 3 and sizes[-1] <= 2  # old keys are gone


def test_keyed_state_in_groups(spark):
    """State has a row per group of keys, not per key; keys of one group live and expire each by its own time."""
    schema = "k string, n long, at timestamp"
    for name, options in (("many", {}), ("one", {"buckets": 1})):
        work = work_dir(spark, f"groups-{name}")
        os.makedirs(local(f"{work}/in"))
        stream, progress = spark.readStream.schema(schema).parquet(f"{work}/in"), []

        def run(rows):
            rows.select("k", "n", F.to_timestamp("day").alias("at")).write.mode("append").parquet(f"{work}/in")
            q = (ST.keep_first_stream(stream, "k", "n", "at", "10 days", **options).writeStream.format("parquet").option("path", f"{work}/out")
                 .option("checkpointLocation", f"{work}/ckpt").outputMode("append").trigger(availableNow=True).start())
            q.awaitTermination()
            progress.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
        n = F.col("id")
        # key 0 has most rows and stays in use; odd keys end in January, the others on the 9th of February
        first = spark.range(3000).select(F.concat(F.lit("k"), n).alias("k"), (n + 10).alias("n"), F.when(n % 2 == 1, "2024-01-25").otherwise("2024-02-09").alias("day"))
        hot = spark.range(5000).select(F.lit("k0").alias("k"), (n + 5).alias("n"), F.lit("2024-02-10").alias("day"))
        none = spark.sql("SELECT CAST(NULL AS STRING) AS k, x AS n, '2024-02-10' AS day FROM VALUES (3L), (2L) AS t(x)")
        run(first.unionByName(hot).unionByName(none))
        # the watermark is at the 31st of January: odd keys are forgotten, the others known
        run(spark.range(4).select(F.concat(F.lit("k"), n).alias("k"), (n * 0 + 1).alias("n"), F.lit("2024-02-11").alias("day")))
        got = [tuple(r) for r in spark.read.schema(schema).parquet(f"{work}/out").select("k", "n").collect()]
        assert sorted(got, key=str) == sorted([("k0", 5), (None, 2), ("k1", 1), ("k3", 1), *[(f"k{i}", i + 10) for i in range(1, 3000)]], key=str)
        assert max(progress) <= (1 if options else 1024)


# ---------------------------------------------------------------- J11 / J12
def quads_of(spark, media, texts):
    rows = [(m, f"{i}.0", f"{i + 1}.0", i * 1000, i * 1000 + 1000, t, None) for m in media for i, t in enumerate(texts)]
    return QD.segments_to_quads(spark.createDataFrame(rows, "media string, start_raw string, end_raw string, start_ms long, end_ms long, text string, confidence double"))


def test_store_changed_in_place(spark):
    media = [f"http://example.org/media/{i}" for i in range(12)]
    path = work_dir(spark, "graphs")
    store = GraphStore(spark, path, buckets=16).create(quads_of(spark, media, ["a", "b"]))

    def files():
        return {(d, f): os.stat(f"{d}/{f}").st_mtime_ns for d, _, fs in os.walk(local(path)) for f in fs if f.endswith(".parquet")}
    before = files()
    one_media = spark.createDataFrame([(media[3],)], "media string")
    touched = store.replace(one_media, quads_of(spark, [media[3]], ["new"]))
    assert len(touched["quads"]) == 1 and len(touched["layers"]) == 1
    changed = {d.rsplit("/", 2)[1] + "/" + d.rsplit("/", 1)[1] for (d, f) in before.keys() ^ files().keys()}
    assert changed == {f"{n}/bucket={b}" for n in ("quads", "layers") for b in touched[n]}

    def want(kept, new=()):
        out = quads_of(spark, kept, ["a", "b"]).select(QUAD_COLUMNS)
        out = out.unionByName(quads_of(spark, new, ["new"]).select(QUAD_COLUMNS)) if new else out
        return sorted(map(str, out.collect()))
    others = [m for m in media if m != media[3]]
    assert sorted(map(str, store.read().select(QUAD_COLUMNS).collect())) == want(others, [media[3]])
    store.replace(one_media, quads_of(spark, [media[3]], ["new"]))  # twice is once
    assert sorted(map(str, store.read().select(QUAD_COLUMNS).collect())) == want(others, [media[3]])
    plan = store.read().where(F.col("bucket").isin(touched["quads"]))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
    store.delete(spark.createDataFrame([(m,) for m in media[1:]] + [("http://example.org/media/unknown",)], "media string"))
    assert sorted(map(str, store.read().select(QUAD_COLUMNS).collect())) == want(media[:1])
    store.delete(spark.createDataFrame([(media[0],)], "media string"))
    assert store.read().count() == store.index().count() == 0


# ---------------------------------------------------------------- S7
def test_nquads_grammar(spark):
    lines = ['_:a <http://p> "x" <http://g> .', "<http://s> <http://p> _:b.c .", '<http://s> <http://p> "no graph"@fr-CA .', '<http://s> <http://p> "1"^^<http://t> <http://g> . # why. <x>',
             "_:a<http://p><http://o>_:g.", '<http://s> <http://p> "a \\"b\\" \\\\ \\u00e9 . # not a comment \x01" <http://g>.', "# a comment", "  ", "",
             "<http://s> <http://p> .", '"x" <http://p> <http://o> .', "<http://s> _:p <http://o> .", "<http://s> <http://p> <http://o> <http://g>", "<a b> <http://p> <http://o> .",
             '<http://s> <http://p> "open <http://g> .', "<http://s> <http://p> <http://o> <http://g> . more"]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    got = [tuple(r) for r in QD.parse_nquads(df, scope=F.lit("f")).collect()]
    node = QD.SKOLEM + "8fa14cdd754f91cc6554c9e71929cce7:"  # md5 of the scope
    assert got == [(node + "a", "http://p", "x", "http://g", "literal", None, None), ("http://s", "http://p", node + "b.c", None, "uri", None, None),
                   ("http://s", "http://p", "no graph", None, "literal", None, "fr-CA"), ("http://s", "http://p", "1", "http://g", "literal", "http://t", None),
                   (node + "a", "http://p", "http://o", node + "g", "uri", None, None), ("http://s", "http://p", 'a "b" \\ é . # not a comment \x01', "http://g", "literal", None, None)]
    assert [r.value for r in QD.rejected_nquads(df).collect()] == lines[9:]
    again = QD.parse_nquads(QD.to_nquads(QD.parse_nquads(df, scope=F.lit("f"))))
    assert [tuple(r) for r in again.collect()] == got
    long = spark.createDataFrame([('<http://s> <http://p> "' + 'a\\"b' * 100_000 + '" .',)], "value string")
    assert len(QD.parse_nquads(long).first().o) == 300_000


def test_blank_nodes_are_scoped_by_file(spark):
    path = work_dir(spark, "blank")
    for name in ("a", "b"):
        with open(f"{local(path)}/{name}.nq", "w") as f:
            f.write('_:n <http://p> "x" .\n_:n <http://q> _:n .\n')
    got = QD.parse_nquads(spark.read.text(path)).collect()
    assert len({r.s for r in got}) == 2 and all(r.o == r.s for r in got if r.p == "http://q")


def test_default_graph_in_updates(spark):
    df = spark.createDataFrame([("s", "p", "o", None, "uri", None, None, 1), ("s", "p", "o", "g", "uri", None, None, 1)],
                               "s string, p string, o string, g string, o_kind string, o_datatype string, o_lang string, bucket int")
    assert QD.update_batches(df).first().request == "INSERT DATA {<s> <p> <o> . GRAPH <g> {<s> <p> <o>}}"


# ---------------------------------------------------------------- K11 / T1
def test_commit_log(spark):
    log = CommitLog(spark, work_dir(spark, "log") + "/log")
    assert log.latest() == (-1, {})
    for i in range(40):
        log.commit(i, {"n": i})
    assert log.latest() == (39, {"n": 39}) and len(log._numbers()) <= CommitLog.KEPT + 1
    for taken in (39, 3):
        with pytest.raises(CommitConflict):
            log.commit(taken, {"n": -1})
    assert log.latest() == (39, {"n": 39})
    assert not [f for f in os.listdir(local(log.path)) if not f.endswith(".json") and not f.endswith(".crc")]


def test_two_runs_at_once(spark):
    """Both take offset 0; the one that commits second is told, and leaves nothing."""
    work = work_dir(spark, "twice")
    rows = spark.range(1200).select(F.col("id").alias("pos"))
    res, state = f"{work}/results", f"{work}/state"

    def meanwhile(part):
        INC.run_offset_batch(spark, rows, lambda df: df.withColumn("who", F.lit("winner")), res, state)
        return part.withColumn("who", F.lit("loser"))
    with pytest.raises(CommitConflict):
        INC.run_offset_batch(spark, rows, meanwhile, res, state)
    while INC.run_offset_batch(spark, rows, lambda df: df.withColumn("who", F.lit("later")), res, state):
        pass
    got = spark.read.parquet(res).groupBy("who").count().collect()
    assert {r.who: r["count"] for r in got} == {"winner": 500, "later": 700}
    assert not os.listdir(local(f"{state}.attempts"))


def test_death_between_commit_and_rename(spark, monkeypatch):
    work = work_dir(spark, "death")
    rows = spark.range(700).select(F.col("id").alias("pos"))
    res, state = f"{work}/results", f"{work}/state"

    def die(*_):
        raise KeyboardInterrupt
    with monkeypatch.context() as m:
        m.setattr(CommitLog, "_promote", die)
        with pytest.raises(KeyboardInterrupt):
            INC.run_offset_batch(spark, rows, lambda df: df, res, state)
    assert INC.committed_rows(spark, state) == 500 and not os.path.exists(local(res))
    assert INC.run_offset_batch(spark, rows, lambda df: df, res, state) == 200
    assert spark.read.parquet(res).select("pos").distinct().count() == 700


# ---------------------------------------------------------------- K7
def requests(spark, n):
    return spark.range(n).select((F.col("id") % 3).alias("bucket"), F.col("id").alias("batch"), F.lit(1).cast("bigint").alias("n_quads"),
                                 F.concat(F.lit("INSERT "), F.col("id")).alias("request"))


def test_delivery_commits_all_or_nothing(spark):
    journal = work_dir(spark, "journal")
    with pytest.raises(Exception, match="refused"):
        QD.deliver_requests(requests(spark, 300).repartition(4), journal, sender="quadrant.plans.senders:refuse_250")
    assert not os.listdir(local(journal)) and not os.listdir(local(journal) + ".staging")
    QD.deliver_requests(requests(spark, 250).repartition(4), journal, sender="quadrant.plans.senders:refuse_250")
    QD.deliver_requests(requests(spark, 0), journal)
    got = spark.read.schema(DL.SCHEMA).json(journal)
    assert got.count() == got.distinct().count() == 250


def test_delivery_of_a_stream(spark):
    work = work_dir(spark, "delivery-stream")
    QD.register(spark, DL.QuadDelivery)
    for _ in range(2):
        requests(spark, 100).write.mode("append").parquet(f"{work}/in")
        stream = spark.readStream.schema(DL.SCHEMA).parquet(f"{work}/in")
        (stream.writeStream.format("quad_delivery").option("path", f"{work}/journal").option("checkpointLocation", f"{work}/ckpt")
         .trigger(availableNow=True).start().awaitTermination())
    assert spark.read.schema(DL.SCHEMA).json(f"{work}/journal").count() == 200
    writer = DL.DeliveryStreamWriter({"path": f"{work}/journal"}, "stream")
    rows = [r for r in requests(spark, 100).collect()]
    writer.commit([writer.write(iter(rows)), None], 1)  # a replayed batch replaces its files
    assert spark.read.schema(DL.SCHEMA).json(f"{work}/journal").count() == 200
