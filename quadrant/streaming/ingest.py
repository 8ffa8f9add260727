"""Structured Streaming: new-file ingestion (T3) with a versioned archive (K10),
keep-first dedupe across runs (T4, by keyed state or by batch), and per-micro-batch publish with state
written after success (T5).

Each run uses `trigger(availableNow=True)`: it processes whatever arrived since
the checkpoint and stops, which is how the scheduled scripts behaved -- but the
checkpoint, not a hand-kept offset, decides what is new, and a re-run adds
nothing. What a micro-batch writes is partitioned by its batch id and replaced
when the batch is replayed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from quadrant.functions import constants as K
from quadrant.operators.catalog import keep_first
from quadrant.operators.incremental import publish_with_retry
from quadrant.session import ship_package, written
from quadrant.sources.files import (CORRUPT, SEGMENT_FILE_SCHEMA, executor_filesystem, flat_segments, list_files,
                                    rejects_of, segment_files, segments_of, sorted_segments)


def raw_segment_stream(spark: SparkSession, input_dir: str, max_files: int | None = None) -> DataFrame:
    r = (spark.readStream.schema(SEGMENT_FILE_SCHEMA).option("columnNameOfCorruptRecord", CORRUPT).option("multiLine", True)
              .option("pathGlobFilter", "*" + K.TRANSCRIPT_FILE_SUFFIX).option("recursiveFileLookup", True))
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.json(input_dir)


def segment_stream(spark: SparkSession, input_dir: str, max_files: int | None = None) -> DataFrame:
    """Transcript JSON files arriving in `input_dir` as a stream of segments."""
    return flat_segments(raw_segment_stream(spark, input_dir, max_files))


def run_available(stream: DataFrame, sink_path: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Process everything available now into an append-only sink, then stop."""
    q = (stream.writeStream.format(fmt).option("path", sink_path)
               .option("checkpointLocation", checkpoint).outputMode("append")
               .trigger(availableNow=True).start())
    q.awaitTermination()


def write_batch(df: DataFrame, batch_id: int, path: str) -> None:
    """Write a micro-batch; a replay replaces what it wrote before."""
    (df.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def move_files(moves: DataFrame) -> DataFrame:
    """Rename each file (path, target) on the executors. status: `moved`; `known` if
    the target is there already (the other copy goes); `missing` if neither is there.
    A repeated task finds its targets in place and says `moved` again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for source, target in zip(batch.column("path").to_pylist(), batch.column("target").to_pylist()):
                fs, old = executor_filesystem(source)
                _, new = executor_filesystem(target)
                here, there = (info.is_file for info in fs.get_file_info([old, new]))
                if here and not there:
                    fs.create_dir(new.rsplit("/", 1)[0], recursive=True)
                    fs.move(old, new)
                elif here:
                    fs.delete_file(old)
                found.append("known" if here and there else "moved" if here or there else "missing")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], ["path", "target", "status"])
    ship_package(moves.sparkSession)
    # the names fill few partitions, but each is a rename
    return moves.select("path", "target").repartition(moves.sparkSession.sparkContext.defaultParallelism, "path").mapInArrow(run, "path string, target string, status string")


def make_dir(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(place)


def claim_files(spark: SparkSession, inbox: str, claimed: str, archive: str, log: str) -> None:
    """Take what lies in the inbox: each file moves to `<claimed>/<name>/<version>/`,
    where the version is its time and length. A corrected file under a known name is
    thus another path, which the stream hasn't seen; the very same file again (name,
    time and length) is not taken twice. The log says what became of each file."""
    files = list_files(spark, inbox, "*" + K.TRANSCRIPT_FILE_SUFFIX)
    version = F.concat_ws("-", F.date_format("modified", "yyyyMMddHHmmssSSSSSS"), F.lpad(F.col("length").cast("string"), 15, "0"))
    files = files.withColumn("place", F.concat_ws("/", F.regexp_replace("file", r"[.]lintoai[.]json$", ""), version, "file"))
    done = list_files(spark, archive).select(F.concat_ws("/", F.slice(F.split("path", "/"), -3, 3)).alias("place"), F.lit(True).alias("done"))
    target = F.concat_ws("/", F.when(F.col("done"), F.lit(archive)).otherwise(F.lit(claimed)), "place")
    files = written(files.join(done, "place", "left").select("path", target.alias("target")), "claims")
    move_files(files).withColumn("at", F.current_timestamp()).write.mode("append").parquet(log)


#: files of one micro-batch of `ingest_and_archive`; the driver knows the names of no more at a time
BATCH_FILES = 8192
#: what opening a small file counts when files are dealt to tasks
OPEN_COST = 1 << 16


def list_claims(spark: SparkSession, pending: DataFrame, lists: str, per_batch: int) -> None:
    """Add the claimed files that no list has yet to the lists, at most `per_batch` in each.
    A run that died leaves its lists to the next; the checkpoint knows which are done."""
    pending = pending.where(F.col("path").endswith(K.TRANSCRIPT_FILE_SUFFIX))
    fresh = written(pending.select("path").join(spark.read.schema("path string").parquet(lists), "path", "left_anti"), "unlisted")
    n = fresh.count()
    if n:
        fresh.repartition(-(-n // per_batch)).write.mode("append").option("maxRecordsPerFile", per_batch).parquet(lists)


def ingest_and_archive(spark: SparkSession, input_dir: str, sink_path: str, checkpoint: str, archive_dir: str,
                       max_files: int | None = None) -> None:
    """Ingest what is there, then move every ingested file to the archive, beside
    its earlier versions (`<archive>/<name>/<version>/<file>`).

    Files are claimed first, so a run sees a fixed set under paths that no later
    delivery can take; they move on after the run, when all its batches are
    committed, so a replay always finds them. A run that died leaves its claims to
    the next. The stream's source are lists of the claimed files, each of them a
    micro-batch (of `max_files`, if given), so the driver never holds the names of all
    files. Segments go to `<sink>/segments`, damaged input to `<sink>/rejects`, with
    the version they came from; `latest_segments` reads the newest of each media."""
    claimed, log, lists = f"{archive_dir}.claimed", f"{archive_dir}.log", f"{archive_dir}.lists"
    for path in (input_dir, claimed, archive_dir, lists):
        make_dir(spark, path)
    claim_files(spark, input_dir, claimed, archive_dir, log)
    keep = F.concat_ws("/", F.lit(archive_dir), F.slice(F.split("path", "/"), -3, 3))  # name, version, file
    pending = written(list_files(spark, claimed).select("path", keep.alias("target")), "pending")
    list_claims(spark, pending, lists, max_files or BATCH_FILES)

    def batch_of(batch: DataFrame, i: int) -> None:
        session = batch.sparkSession  # the stream's own: its settings are no one else's
        session.conf.set("spark.sql.files.openCostInBytes", str(OPEN_COST))
        session.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(session.sparkContext.defaultParallelism))
        files = segment_files(session, [r["path"] for r in batch.collect()], glob=False)
        items = written(sorted_segments(files), "batch-items")  # two results of one read
        write_batch(segments_of(items, keep=("file", "version")), i, f"{sink_path}/segments")
        write_batch(rejects_of(items, keep=("version",)), i, f"{sink_path}/rejects")
    run_foreach_batch(spark.readStream.schema("path string").option("maxFilesPerTrigger", 1).parquet(lists), batch_of, checkpoint)
    move_files(pending).withColumn("at", F.current_timestamp()).write.mode("append").parquet(log)


def latest_segments(spark: SparkSession, sink_path: str) -> DataFrame:
    """Segments of the newest version of each media's file."""
    rows = spark.read.parquet(f"{sink_path}/segments").drop("batch_id")
    newest = rows.groupBy("media_key").agg(F.max("version").alias("version"))
    return rows.join(newest, ["media_key", "version"], "left_semi")


def run_foreach_batch(stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    q = (stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start())
    q.awaitTermination()


def keep_first_batches(key: str, order: str, sink_path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch body for T4: the first row per key in the batch (a map-side
    combined aggregate), unless an earlier batch has written the key."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        first = keep_first(batch, key, [order])
        if batch_id > 0:
            known = batch.sparkSession.read.schema(f"`{key}` {batch.schema[key].dataType.simpleString()}, batch_id bigint").parquet(sink_path)
            first = first.join(known.where(F.col("batch_id") < batch_id).select(key), key, "left_anti")
        write_batch(first, batch_id, sink_path)
    return fn


#: groups of keys that `keep_first_stream` keeps state for; fixed for the life of a checkpoint
KEY_BUCKETS = 1024


def keep_first_stream(stream: DataFrame, key: str, order: str, event_time: str, delay: str = "30 days", buckets: int = KEY_BUCKETS) -> DataFrame:
    """T4 with keyed state: the row of least `order` of each key, from the micro-batch in
    which the key first comes; the key is then known until the watermark (the latest
    event time less `delay`) has passed its last event. State holds each live key and
    one time for it, whatever the stream's age, and no sink is read.

    Keys lie in `buckets` groups by their hash. One call of Python handles all keys of a
    group in a micro-batch, as columns, so calls don't grow with the keys; a group times
    out when the first of its keys does, and then loses the keys that are due.

    Rows older than the watermark are late and dropped. Each Arrow batch sends its
    first row per key only, so a key that holds most rows doesn't gather in the task
    that keeps its state."""
    schema: StructType = stream.schema
    sort = [order, *[c for c in schema.names if c not in (order, key)]]
    kind = to_arrow_type(schema[key].dataType)

    def first_of(pdf: pd.DataFrame) -> pd.DataFrame:
        """The first row of each key, `_last` being the latest time among the key's rows."""
        again = pdf.duplicated(key, keep=False)
        if not again.any():
            return pdf
        some = pdf[again]
        some = some.assign(_last=some.groupby(key, dropna=False)["_last"].transform("max"))
        return pd.concat([pdf[~again], some.sort_values(sort, kind="stable").drop_duplicates(key)])

    def thin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield first_of(pdf)[[*schema.names, "_last"]]

    def packed(keys: pa.Array) -> bytes:
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, pa.schema([("key", kind)])) as to:
            to.write_batch(pa.RecordBatch.from_arrays([keys], ["key"]))
        return out.getvalue().to_pybytes()

    def step(_: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        """State: the keys, and of each the time (ms) that the watermark must pass."""
        known, until = pa.array([], kind), np.empty(0, np.int64)
        if state.exists:
            held = state.get
            known = pa.ipc.open_stream(bytes(held[0])).read_all().column("key").combine_chunks()
            until = np.frombuffer(bytes(held[1]), np.int64).copy()
        now = state.getCurrentWatermarkMs()
        if not state.hasTimedOut:
            best = first_of(pd.concat(list(parts), ignore_index=True))
            keys = pa.Array.from_pandas(best[key], type=kind)
            times = np.maximum(best["_last"].to_numpy(np.int64), now) + 1
            place = pc.index_in(keys, value_set=known, skip_nulls=False)
            there = place.is_valid().to_numpy(zero_copy_only=False)
            at = place.drop_null().to_numpy()
            until[at] = np.maximum(until[at], times[there])
            known = pa.concat_arrays([known, keys.filter(pa.array(~there))])
            until = np.concatenate([until, times[~there]])
            if not there.all():
                yield best.loc[~there, schema.names]
        live = until >= now
        if not live.any():
            state.remove()
            return
        if not live.all():
            known, until = known.filter(pa.array(live)), until[live]
        state.update((packed(known), until.tobytes()))
        state.setTimeoutTimestamp(int(until.min()))
    times = stream.withColumn("_last", F.coalesce(F.unix_millis(event_time), F.lit(0).cast("bigint")))
    return (times.mapInPandas(thin, times.schema).withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
                 .withWatermark(event_time, delay).groupBy("_bucket")
                 .applyInPandasWithState(step, schema, "keys binary, until binary", "append", GroupStateTimeout.EventTimeTimeout))


def publish_each_batch(key: str, publisher, work: str, state_path: str):
    """foreachBatch body for T5: publish the batch's records with retries, then
    record the batch in the state table; the streaming checkpoint commits last,
    so a failure before it replays the batch: acks, status and state of the batch
    are replaced, and the quads are a set."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        status = publish_with_retry(spark, batch, key, publisher, f"{work}/acks-{batch_id}")
        write_batch(status, batch_id, f"{work}/status")
        write_batch(spark.createDataFrame([(batch_id,)], "done bigint"), batch_id, state_path)
    return fn
