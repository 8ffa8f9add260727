"""Resumable batch runs (T1, T2), truncate-and-redo (O4), publish with retry
(K8) and the dead-letter table (K9).

Run state lives in a commit log next to the results, both in the shared folder
(`commits.py`). Results are partitioned by the run's start offset (or run date); they
come into their place with the commit of the state, so a run that died before it
leaves nothing that counts and is simply redone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quadrant.functions import constants as K
from quadrant.functions.expressions import nq_line, percent_encode_path
from quadrant.operators.commits import CommitConflict, CommitLog, write_attempt
from quadrant.operators.positions import dense_position
from quadrant.session import python_ready, ship_package

# runs that one job prepares where many are due
RUNS_PER_JOB = 1024


# ------------------------------------------------------------------ T1
def stage_positions(rows: DataFrame, order: list[str], path: str) -> DataFrame:
    """Number the input once (range-partitioned scan) and store it, so each
    run reads only its slice through a pushed-down filter on `pos`."""
    dense_position(rows, order, name="pos").write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.parquet(path)


def committed_rows(spark: SparkSession, state_path: str) -> int:
    return int(CommitLog(spark, state_path).latest()[1].get("committed", 0))


def run_offset_batch(spark: SparkSession, staged: DataFrame, process: Callable[[DataFrame], DataFrame],
                     results_path: str, state_path: str, size: int = K.ROWS_PER_BATCH,
                     commit_state: bool = True) -> int:
    """One run: the next `size` rows after the committed offset (dense `pos`) -> results
    partition `batch_id`, with the new offset. `batch_id` is the start offset: it is
    unique to a run, also after a short one, and the same when a run is redone.

    Results count from the commit of the offset on (`CommitLog.publish`): of two runs
    that take the same offset one commits, and the other raises CommitConflict and
    leaves nothing. Returns rows processed (0 when everything is done)."""
    log = CommitLog(spark, state_path)
    number, state = log.recover()
    start = int(state.get("committed", 0))
    part = staged.where((F.col("pos") >= start) & (F.col("pos") < start + size))
    seen = Observation()
    attempt = write_attempt(process(part.observe(seen, F.max("pos").alias("last"))), log)
    last = seen.get["last"]
    if last is None or not commit_state:
        if last is None:
            log.discard(attempt)
        return 0 if last is None else int(last) + 1 - start
    log.publish(number + 1, {"committed": int(last) + 1}, attempt, f"{results_path}/batch_id={start}")
    return int(last) + 1 - start


def run_offset_batches(spark: SparkSession, staged: DataFrame, process: Callable[[DataFrame], DataFrame],
                       results_path: str, state_path: str, size: int = K.ROWS_PER_BATCH, runs: int = RUNS_PER_JOB) -> int:
    """The next `runs` runs of `run_offset_batch` (fewer at the end) by one job, as a run
    of few rows costs a job's start and little else. `process` gets the rows with their
    run's `batch_id`, works row by row and keeps that column.

    Each run still has its own results partition and its own commit, made in order: where
    this dies, the runs committed so far count and the others are redone. On a
    CommitConflict nothing of the run in conflict and those behind it is left. Returns
    rows processed."""
    log = CommitLog(spark, state_path)
    number, state = log.recover()
    start = int(state.get("committed", 0))
    part = staged.where((F.col("pos") >= start) & (F.col("pos") < start + size * runs))
    seen = Observation()
    own = F.col("pos") - F.pmod(F.col("pos") - start, F.lit(size))
    rows = part.observe(seen, F.max("pos").alias("last")).withColumn("batch_id", own.cast("bigint"))
    attempt = write_attempt(process(rows), log, "batch_id")
    last = seen.get["last"]
    end = start if last is None else int(last) + 1
    try:
        for first in range(start, end, size):
            number += 1
            log.publish(number, {"committed": min(first + size, end)}, f"{attempt}/batch_id={first}", f"{results_path}/batch_id={first}")
    except CommitConflict:  # after any other failure `recover` may need a run that is committed and not in its place
        log.discard(attempt)
        raise
    log.discard(attempt)
    return end - start


# ------------------------------------------------------------------ T2
def window_days(as_of: str, last_run: str | None, lookback: int = K.FIRST_RUN_LOOKBACK_DAYS) -> int:
    """First run looks back `lookback` days, later runs cover since the last run."""
    from datetime import date
    if last_run is None:
        return lookback
    return (date.fromisoformat(as_of) - date.fromisoformat(last_run)).days


def last_run_date(spark: SparkSession, state_path: str) -> str | None:
    return CommitLog(spark, state_path).latest()[1].get("run_date")


def run_date_batch(spark: SparkSession, rows: DataFrame, date_col: str, as_of: str,
                   process: Callable[[DataFrame], DataFrame], results_path: str, state_path: str,
                   commit_state: bool = True) -> int:
    """One dated run: rows with datediff(as_of, date) < days and date <= as_of, days
    from the state; results partitioned by run_date. Results of a run that was
    interrupted before its commit never count, whatever day it is redone; a second
    run the same day is a no-op."""
    log = CommitLog(spark, state_path)
    number, state = log.recover()
    days = window_days(as_of, state.get("run_date"))
    if days <= 0:
        return 0
    d = F.to_date(F.col(date_col))
    asof = F.lit(as_of).cast("date")
    attempt = write_attempt(process(rows.where((F.datediff(asof, d) < days) & (d <= asof))), log)
    if commit_state:
        log.publish(number + 1, {"run_date": as_of}, attempt, f"{results_path}/run_date={as_of}")
    return days


# ------------------------------------------------------------------ K8 / K9
Publisher = Callable[[pd.DataFrame, int], pd.Series]


def with_request(records: DataFrame, endpoint: str, mimetype: str, segment_type: str, threshold: float = 0.0,
                 unlock: bool = True, media_col: str = "media", seg_col: str = "media_seg") -> DataFrame:
    """What a publisher sends for each record: `request_url` (the media URI and
    the segment type percent-encoded, '/' kept) and `body`, the segment's graph
    as sorted N-Quads lines (one quad per predicted label, as a set)."""
    tail = F.concat(F.lit(f"&mimetype={mimetype}&segmenttype="), percent_encode_path(F.lit(segment_type)),
                    F.lit(f"&threshold={threshold}&unlock={str(unlock).lower()}"))
    none = F.lit(None).cast("string")
    quads = F.transform("predicted_labels", lambda x: nq_line(
        F.col(seg_col), x["uriclass"], x["entity"], F.col(seg_col), F.lit("uri"), none, none))
    return (records.withColumn("request_url", F.concat(F.lit(f"{endpoint}?uri="), percent_encode_path(media_col), tail))
                   .withColumn("body", F.array_join(F.array_sort(F.array_distinct(quads)), "\n")))


def _attempt(records: DataFrame, key: str, publisher: Publisher, attempt: int) -> DataFrame:
    """One ack per key: ok if all its records were accepted. Records hold lists and
    graphs, so a publisher gets bounded batches of them."""
    ship_package(records.sparkSession)
    python_ready(records.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ok = publisher(pdf, attempt).astype(bool).values
            yield pd.DataFrame({key: pdf[key].values, "ok": ok})
    sent = records.mapInPandas(run, f"{key} string, ok boolean")
    return sent.groupBy(key).agg(F.lit(attempt).alias("attempt"), F.every("ok").alias("ok"))


def publish_with_retry(spark: SparkSession, records: DataFrame, key: str, publisher: Publisher,
                       acks_path: str, locked: DataFrame | None = None,
                       rounds: int = K.RETRY_ROUNDS, retries: int = K.RETRIES_PER_MEDIA) -> DataFrame:
    """K8: a first pass, then up to `rounds` retry rounds, each media (`key`) tried
    at most 1 + `retries` times with all its segments. Locked media are never
    attempted and are reported apart. Every round's acks are written to a table in
    the shared folder (the first replaces what an earlier try of the same
    publication left), and the next round is `pending` anti-joined with the
    successes read back, so a lost executor never replays a round and publishing
    stays at-least-once on idempotent (set) quads.

    Returns (key, status, attempts) with status published / dead / locked.
    """
    schema = f"{key} string, attempt int, ok boolean"
    todo = records if locked is None else records.join(locked.select(key).distinct(), key, "left_anti")
    attempt = 1
    _attempt(todo, key, publisher, attempt).write.mode("overwrite").parquet(acks_path)
    for _ in range(rounds):
        attempt += 1
        if attempt > 1 + retries:
            break
        acks = spark.read.schema(schema).parquet(acks_path)
        pending = todo.join(acks.where("ok").select(key), key, "left_anti")
        if pending.isEmpty():
            break
        _attempt(pending, key, publisher, attempt).write.mode("append").parquet(acks_path)
    acks = spark.read.schema(schema).parquet(acks_path)
    summary = acks.groupBy(key).agg(
        F.min(F.when(F.col("ok"), F.col("attempt"))).alias("_ok_at"), F.max("attempt").alias("_last"))
    status = summary.select(
        key,
        F.when(F.col("_ok_at").isNotNull(), F.lit("published")).otherwise(F.lit("dead")).alias("status"),
        F.coalesce(F.col("_ok_at"), F.col("_last")).cast("bigint").alias("attempts"))
    if locked is not None:
        status = status.unionByName(locked.select(key, F.lit("locked").alias("status"),
                                                  F.lit(0).cast("bigint").alias("attempts")).distinct())
    return status


def dead_letter(records: DataFrame, status: DataFrame, key: str, path: str) -> DataFrame:
    """K9: the full (nested) records that exhausted their retries, deduplicated
    on the whole record, written as JSON for manual indexing."""
    dead = records.join(status.where(F.col("status") == "dead").select(key), key, "left_semi").dropDuplicates()
    dead.write.mode("overwrite").json(path)
    return dead
