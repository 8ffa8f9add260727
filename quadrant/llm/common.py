"""Shared helpers of the llm operators: tables, work tables, id ranges, bounded Arrow batches."""

from __future__ import annotations

import ctypes
import functools
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrant.session import python_ready, work_dir  # noqa: F401

#: Python-side slices of an Arrow batch hold about this many text bytes
#: (one row at least), so numpy temporaries stay small whatever the row count.
SLICE_BYTES = 2 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to a fresh table in the shared folder and read it back: cuts
    the lineage with a copy that survives lost executors."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def borders(df: DataFrame, key: str, n: int) -> list[int]:
    """At most n - 1 sorted, distinct upper borders that cut the values of an
    integer column into about equal row counts (one pass over that column; the
    driver gets n - 1 numbers, a count set by the cluster and not by the data)."""
    if n < 2:
        return []
    cuts = ", ".join(f"{i / n:.9f}D" for i in range(1, n))
    found = df.select(F.expr(f"percentile_approx(`{key}`, array({cuts}), {20 * n})").alias("b")).first()["b"]
    return sorted(set(found or []))


def hashed_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """About `n` rows (all, if fewer) of different `key`, an evenly spread 64-bit hash:
    those below the border that the number of keys sets. The number is an HyperLogLog
    estimate (2 %) and rows are chosen by a filter, so no task gathers what others chose.
    Of rows with one key any stays: let the key cover all that matters of a row."""
    total = df.select(F.approx_count_distinct(key, 0.02)).first()[0]
    if total > n:
        df = df.filter(F.col(key) < -(1 << 63) + (n << 64) // total)
    return df.dropDuplicates([key])


def bucket_of(key: Column, cuts: list[int]) -> Column:
    """0 for null, else 1 + the number of borders below the key (binary search)."""
    if not cuts:
        return F.when(key.isNull(), F.lit(0)).otherwise(F.lit(1))
    arr = F.lit(cuts).cast("array<bigint>")
    steps = F.sequence(F.lit(1), F.lit(len(cuts).bit_length()))
    init = F.struct(F.lit(0).alias("lo"), F.lit(len(cuts)).alias("hi"))

    def step(s, _):
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        below = (s["lo"] < s["hi"]) & (F.get(arr, mid) < key)
        return F.struct(F.when(below, mid + 1).otherwise(s["lo"]).alias("lo"),
                        F.when(below | (s["lo"] >= s["hi"]), s["hi"]).otherwise(mid).alias("hi"))
    found = F.aggregate(steps, init, step, lambda s: s["lo"])
    return F.when(key.isNull(), F.lit(0)).otherwise(found + 1)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into row slices of about `limit` bytes in `column`."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = total = 0
        for i, size in enumerate(sizes):
            if total and total + size > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < len(sizes):
            yield batch.slice(start, len(sizes) - start)


def give_back() -> None:
    """Hand the memory that this process has freed back to the system: allocators keep
    it, and a Python worker that waits for its next task would hold it beside the JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`run`, a function for mapInArrow, with its memory given back after each task."""
    @functools.wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()
    return task


_BLANK = re.compile("[ \\t\\n\\x0b\\x0c\\r]")


def batches_of(texts: list[str | None], limit: int = SLICE_BYTES) -> Iterator[tuple[list[int], list[str]]]:
    """Lists of (text number, piece) of about `limit` characters: texts that are
    longer are cut behind white space (a run without any stays whole), in order."""
    numbers: list[int] = []
    parts: list[str] = []
    size = 0
    for i, text in enumerate(texts):
        text, at = text or "", 0
        while True:
            gap = _BLANK.search(text, at + limit) if len(text) - at > limit else None
            part = text[at:gap.end()] if gap else text[at:] if at else text
            if size and size + len(part) > limit:
                yield numbers, parts
                numbers, parts, size = [], [], 0
            numbers.append(i)
            parts.append(part)
            size += len(part)
            if not gap:
                break
            at = gap.end()
    if parts:
        yield numbers, parts


def most_frequent(counts: DataFrame, key: str, most: int) -> list:
    """Keys (with n) of the count classes, eighths of a power of two, that fit into
    `most` rows from the top; only they and the class sizes reach the driver."""
    counts = written(counts, "counts").withColumn("class", F.floor(8 * F.log2(F.col("n").cast("double"))).cast("int"))
    sizes = {r["class"]: r["count"] for r in counts.groupBy("class").count().collect()}  # 512 classes at most
    least, total = None, 0
    for c in sorted(sizes, reverse=True):
        total += sizes[c]
        if total > most:
            break
        least = c
    return [] if least is None else counts.filter(F.col("class") >= least).select(key, "n").collect()
