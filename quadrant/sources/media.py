"""Media files by byte range (S5): a recording of any length is read in ranges of a
bounded size, in parallel, so that no file has to fit into one value.

The scan lists the files without opening them (path and length are metadata of the
binary file source); each range is then read where its row lies. Ranges of one file
are rows like any other and spread over the tasks, so one huge file isn't one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import BinaryIO
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrant.session import ship_package

RANGE_BYTES = 8 << 20
RANGE_COLUMNS = "path string, length long, range_no long, start long, n_bytes long"


def open_media(path: str) -> BinaryIO:
    """Open a file as the scan names it: local paths, and the stores pyarrow knows."""
    from pyarrow import fs
    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + path[len("file:"):].lstrip("/"))
    store, place = fs.FileSystem.from_uri(quote(path, safe="/:@"))
    return store.open_input_file(place)


def media_ranges(spark: SparkSession, folder: str, range_bytes: int = RANGE_BYTES, suffix: str = "*") -> DataFrame:
    """(path, length, range_no, start, n_bytes): the ranges of every file under `folder`
    whose name fits `suffix`. No file is opened; Spark's listing leaves files without bytes
    out, so they have no range."""
    if range_bytes < 1:
        raise ValueError("range_bytes must be positive")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", suffix)
                  .load(folder).select("path", "length"))
    last = F.expr(f"(length - 1) div {range_bytes}")
    return (files.withColumn("range_no", F.explode(F.sequence(F.lit(0).cast("long"), last)))
                 .withColumn("start", F.col("range_no") * range_bytes)
                 .withColumn("n_bytes", F.least(F.lit(range_bytes).cast("long"), F.col("length") - F.col("start"))))


def read_ranges(ranges: DataFrame, opener: Callable[[str], BinaryIO] = open_media) -> DataFrame:
    """Ranges with their bytes (`content`). A task holds one range at a time; a file
    that has become shorter than its listing fails the task instead of giving fewer
    bytes. `opener` opens a path of a store that `open_media` doesn't know."""
    ship_package(ranges.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, rows in batch.sort_values(["path", "start"]).groupby("path", sort=False):
                with opener(path) as file:
                    for row in rows.itertuples(index=False):
                        file.seek(row.start)
                        content = file.read(row.n_bytes)
                        if len(content) != row.n_bytes:
                            raise OSError(f"{path}: {len(content)} of {row.n_bytes} bytes at {row.start}")
                        yield pd.DataFrame([(*row, content)], columns=[*batch.columns, "content"])

    spread = ranges.select("path", "length", "range_no", "start", "n_bytes").repartition("path", "range_no")
    return spread.mapInPandas(run, f"{RANGE_COLUMNS}, content binary")
