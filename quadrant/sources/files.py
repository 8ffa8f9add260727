"""File sources (S1-S4, S6, S8) and the writers that land such files.

Every reader takes an explicit schema: nothing is inferred, and JSON numbers
that must keep their exact text (segment start / end) are read as STRING. Damaged
input is routed: a reader returns the rows it can vouch for, and its `rejected_*`
twin the others, with the file they came from, the reason and the raw record.
"""

from __future__ import annotations

from collections.abc import Iterator
from fnmatch import fnmatch

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow.fs import FileSelector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrant.functions import constants as K
from quadrant.functions.expressions import seconds_text_to_ms
from quadrant.operators.positions import group_position
from quadrant.session import ship_package

SEGMENT = "start string, end string, text string, confidence double"
# a file is an array of segments, or an object that holds them (verbose responses)
CORRUPT = "_corrupt_record"
SEGMENT_FILE_SCHEMA = f"{SEGMENT}, segments array<struct<{SEGMENT.replace(' string', ':string').replace(' double', ':double')}>>, {CORRUPT} string"


def executor_filesystem(uri: str):
    """The pyarrow filesystem of a folder (hdfs://, s3://, file:) and its path there."""
    from pyarrow import fs as pafs
    if "://" not in uri or uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)


# ------------------------------------------------------------------ S1 / K1
def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    (df.write.mode(mode).option("header", True).option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .option("encoding", "UTF-8").csv(path))


def _csv(spark: SparkSession, path: str, schema: str, header: bool) -> DataFrame:
    return (spark.read.schema(f"{schema}, {CORRUPT} string").option("columnNameOfCorruptRecord", CORRUPT).option("header", header)
                 .option("multiLine", True).option("escape", '"').option("encoding", "UTF-8").csv(path))


def read_csv(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    """Header row, UTF-8, quoted fields that may span lines; `rejected_csv` has the
    records with too few or too many fields, or with fields of another type."""
    return _csv(spark, path, schema, header).where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def rejected_csv(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    """S1 rejects: path, reason, record."""
    rows = _csv(spark, path, schema, header)
    # the second condition always holds: Spark refuses to read the raw record alone
    bad = rows.where(F.col(CORRUPT).isNotNull() & (F.hash(F.col(f"`{rows.columns[0]}`")) >= F.lit(-2**31)))
    return bad.select(F.col("_metadata.file_path").alias("path"), F.lit("damaged record").alias("reason"), F.col(CORRUPT).alias("record"))


# ------------------------------------------------------------------ S2 / S4
def segment_documents(seg: DataFrame, key_col: str = "media_key", verbose: Column | None = None) -> DataFrame:
    """(key, body, n_segments): one transcript file per media, an array of segments
    or (where `verbose` holds) an object with the array in it; start / end stay the
    raw JSON numbers.

    One file per media is the exchange format, so each media's segments meet in
    one row: bounded by the length of one recording, not by the archive."""
    rest = F.to_json(F.struct("text", "confidence"))
    item = F.concat(F.lit('{"start": '), F.col("start_raw"), F.lit(', "end": '), F.col("end_raw"), F.lit(", "), F.substr(rest, F.lit(2)))
    rows = seg.select(key_col, "start_ms", "end_ms", "ord", item.alias("item"), (verbose if verbose is not None else F.lit(False)).alias("verbose"))
    items = F.transform(F.array_sort(F.collect_list(F.struct("start_ms", "end_ms", "ord", "item"))), lambda x: x["item"])
    body = F.concat(F.lit("["), F.array_join(items, ",\n"), F.lit("]"))
    return rows.groupBy(key_col).agg(
        F.when(F.any_value("verbose"), F.concat(F.lit('{"task": "transcribe", "segments": '), body, F.lit("}"))).otherwise(body).alias("body"),
        F.count(F.lit(1)).alias("n_segments"))


def land_documents(documents: DataFrame, path: str, key_col: str = "media_key") -> DataFrame:
    """Write each (key, body) as `<path>/<key>.lintoai.json`, the way the transcriber
    leaves them. A file is written under a hidden name and renamed, so readers see
    whole files only and a repeated task replaces its file. Returns (key, n_segments)."""
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filesystem, root = executor_filesystem(path)
        filesystem.create_dir(root, recursive=True)
        for pdf in batches:
            for key, body in zip(pdf[key_col], pdf["body"]):
                hidden, name = f"{root}/.{key}.{id(body):x}", f"{root}/{key}{K.TRANSCRIPT_FILE_SUFFIX}"
                with filesystem.open_output_stream(hidden) as out:
                    out.write(body.encode("utf-8"))
                filesystem.move(hidden, name)
            yield pdf[[key_col, "n_segments"]]

    ship_package(documents.sparkSession)
    return documents.select(key_col, "body", "n_segments").mapInPandas(write, f"{key_col} string, n_segments long")


def land_segment_files(seg: DataFrame, path: str, key_col: str = "media_key", verbose: Column | None = None) -> DataFrame:
    """`segment_documents`, landed."""
    return land_documents(segment_documents(seg, key_col, verbose), path, key_col)


def sorted_segments(raw: DataFrame) -> DataFrame:
    """All items of transcript files of either form, with `reason` where they are no
    segments: a file that can't be parsed to its end, a document that holds no
    segments, an item without times. The media key is the file name without its
    suffix; `version` is the folder that the file lies in."""
    name, path = F.col("_metadata.file_name"), F.col("_metadata.file_path")
    one = F.struct("start", "end", "text", "confidence")
    bare = F.coalesce(F.col("start"), F.col("end"), F.col("text"), F.col("confidence").cast("string")).isNull()
    whole = F.when(F.col(CORRUPT).isNotNull(), "damaged file").when(F.col("segments").isNull() & bare, "no segments")
    items = F.when(whole.isNotNull() | F.col("segments").isNull(), F.array(one)).otherwise(F.col("segments"))
    s = raw.select(F.regexp_replace(name, r"[.]lintoai[.]json$", "").alias("media_key"), name.alias("file"), path.alias("path"),
                   F.element_at(F.split(path, "/"), -2).alias("version"), whole.alias("whole"), F.col(CORRUPT).alias("record"), F.inline(items))
    s = s.withColumns({"start_ms": seconds_text_to_ms("start"), "end_ms": seconds_text_to_ms("end")})
    late = F.when(F.col("start_ms").isNull() | F.col("end_ms").isNull(), "no times")
    return s.withColumn("reason", F.coalesce("whole", late)).withColumn("record", F.coalesce("record", F.to_json(one)))


SEGMENT_COLUMNS = ["media_key", "start_raw", "end_raw", "text", "confidence", "start_ms", "end_ms"]


def segments_of(items: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The segments among `sorted_segments`."""
    good = items.where(F.col("reason").isNull()).withColumnsRenamed({"start": "start_raw", "end": "end_raw"})
    return good.select(*SEGMENT_COLUMNS, *keep)


def rejects_of(items: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The others: media_key, path, reason, record."""
    return items.where(F.col("reason").isNotNull()).select("media_key", "path", "reason", "record", *keep)


def flat_segments(raw: DataFrame) -> DataFrame:
    """Segments of transcript files; nothing of a damaged file is one."""
    return segments_of(sorted_segments(raw))


def segment_files(spark: SparkSession, path: str | list[str], glob: bool = True) -> DataFrame:
    """Raw items of the transcript files below a folder, or of given files, whose names
    are taken as they are without `glob`."""
    return (spark.read.schema(SEGMENT_FILE_SCHEMA).option("columnNameOfCorruptRecord", CORRUPT).option("multiLine", True)
                 .option("pathGlobFilter", "*" + K.TRANSCRIPT_FILE_SUFFIX).option("recursiveFileLookup", True)
                 .option("__globPaths__", glob).json(path))


def read_segment_files(spark: SparkSession, path: str) -> DataFrame:
    """Transcript files -> segments; other files in the folder are skipped by
    the suffix filter (S4). The position within a media is bounded by a recording."""
    return group_position(flat_segments(segment_files(spark, path)), ["start_ms", "end_ms", "text"], group=["media_key"], name="ord")


def rejected_segment_files(spark: SparkSession, path: str) -> DataFrame:
    """What `read_segment_files` doesn't return, empty files included."""
    empty = list_files(spark, path, "*" + K.TRANSCRIPT_FILE_SUFFIX).where("length = 0").select(
        F.regexp_replace("file", r"[.]lintoai[.]json$", "").alias("media_key"), "path", F.lit("empty file").alias("reason"), F.lit("").alias("record"))
    return rejects_of(sorted_segments(segment_files(spark, path))).unionByName(empty)


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, file, modified, length) of the files below a folder, empty ones too, which
    Spark's own scans skip. The folder's entries are listed by one task, what lies
    below them by many; contents aren't read."""
    kinds = pa.schema([("path", pa.string()), ("file", pa.string()), ("modified", pa.timestamp("us", "UTC")), ("length", pa.int64())])

    def rows(prefix: str, infos: list) -> pa.RecordBatch:
        files = [i for i in infos if i.is_file and fnmatch(i.base_name, pattern) and i.base_name[0] not in "._"]
        return pa.RecordBatch.from_pylist([{"path": prefix + i.path, "file": i.base_name, "modified": i.mtime_ns // 1000, "length": i.size} for i in files], kinds)

    def entries(_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = executor_filesystem(path)
        infos = filesystem.get_file_info(FileSelector(root, allow_not_found=True))
        prefix = path.removesuffix(root) if path.endswith(root) else ""
        for at in range(0, len(infos), 10_000):
            some = infos[at:at + 10_000]
            yield rows(prefix, some)
            yield pa.RecordBatch.from_pylist([{"path": prefix + i.path} for i in some if not i.is_file], kinds)

    def below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files = pc.is_valid(batch.column("file"))
            yield batch.filter(files)
            for folder in batch.filter(pc.invert(files)).column("path").to_pylist():
                filesystem, root = executor_filesystem(folder)
                yield rows(folder.removesuffix(root), filesystem.get_file_info(FileSelector(root, recursive=True, allow_not_found=True)))
    ship_package(spark)
    schema = "path string, file string, modified timestamp, length long"
    return spark.range(0, 1, 1, 1).mapInArrow(entries, schema).repartition(spark.sparkContext.defaultParallelism, "path").mapInArrow(below, schema)


# ------------------------------------------------------------------ S6
BINDING = "struct<type:string,value:string>"


def sparql_schema(variables: list[str]) -> str:
    fields = ",".join(f"{v}:{BINDING}" for v in variables)
    return f"head struct<vars:array<string>>, results struct<bindings:array<struct<{fields}>>>"


ROWS_PER_PAGE = 10_000


def write_sparql_json(rows: DataFrame, variables: list[str], path: str,
                      rows_per_page: int = ROWS_PER_PAGE) -> None:
    """Land a result set as SPARQL-JSON documents (JSON lines), each page
    holding about `rows_per_page` bindings: the page count follows the row
    count, so no page grows with the data."""
    pages = max(1, -(-rows.count() // rows_per_page))
    binding = F.struct(*[F.struct(F.lit("literal").alias("type"), F.col(v).alias("value")).alias(v)
                         for v in variables])
    docs = (rows.withColumn("_page", F.pmod(F.xxhash64(*variables), F.lit(pages)))
                .groupBy("_page")
                .agg(F.to_json(F.struct(
                    F.struct(F.array(*[F.lit(v) for v in variables]).alias("vars")).alias("head"),
                    F.struct(F.collect_list(binding).alias("bindings")).alias("results"))).alias("value")))
    docs.select("value").write.mode("overwrite").text(path)


def _sparql_pages(spark: SparkSession, path: str, variables: list[str]) -> DataFrame:
    return (spark.read.schema(f"{sparql_schema(variables)}, {CORRUPT} string").option("columnNameOfCorruptRecord", CORRUPT).json(path)
                 .withColumn("path", F.col("_metadata.file_path")))


def read_sparql_json(spark: SparkSession, path: str, variables: list[str]) -> DataFrame:
    """Each binding {var: {value}} -> one row with one column per variable; nothing
    of a page that can't be parsed to its end (see `rejected_sparql_json`)."""
    docs = _sparql_pages(spark, path, variables).where(F.col(CORRUPT).isNull())
    b = docs.select(F.explode("results.bindings").alias("b"))
    return b.select(*[F.col(f"b.{v}.value").alias(v) for v in variables])


def rejected_sparql_json(spark: SparkSession, path: str, variables: list[str]) -> DataFrame:
    """S6 rejects: path, reason, record of pages that are damaged or hold no bindings."""
    reason = F.when(F.col(CORRUPT).isNotNull(), "damaged page").when(F.col("results.bindings").isNull(), "no bindings")
    return (_sparql_pages(spark, path, variables).withColumn("reason", reason).where(F.col("reason").isNotNull())
            .select("path", "reason", F.coalesce(F.col(CORRUPT), F.to_json(F.struct("head", "results"))).alias("record")))


# ------------------------------------------------------------------ S8
def fold_list_name(option: str) -> str:
    """Vocabulary option name -> list name: lower case, accents and spaces folded."""
    return option.lower().replace("é", "e").replace("è", "e").replace(" ", "")


def write_vocabulary_registry(vocab: DataFrame, path: str) -> None:
    """All controlled lists in one table, partitioned by list_name."""
    vocab.write.mode("overwrite").partitionBy("list_name").parquet(path)


def select_vocabulary(spark: SparkSession, path: str, option: str) -> DataFrame:
    """Pick one list (partition pruning on list_name), dedupe, keep file order."""
    from quadrant.operators.textprep import vocab_dedupe
    v = spark.read.parquet(path).where(F.col("list_name") == fold_list_name(option)).drop("list_name")
    return vocab_dedupe(v)


# ------------------------------------------------------------------ K2
def append_batch(df: DataFrame, path: str) -> None:
    """K2: add (or redo) batches; only the batch_id partitions present in `df`
    are replaced, so a re-run batch never duplicates rows."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("batch_id").parquet(path))
