"""Transcripts: time codes (X3), corrected-line merge (W2), TXT / SRT documents
(K4, K5), layer statistics (A8), media keys and lookups (F7, J7, J9, J10), and
the pluggable transcriber (X2)."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyarrow.fs import FileSelector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrant.functions import constants as K
from quadrant.functions.expressions import (media_key, ms_to_duration, ms_to_srt_stamp,
                                            ms_to_timecode, seconds_text_to_ms, strip_punctuation, trim_space)
from quadrant.operators.positions import carry_forward, group_position
from quadrant.operators.theta import contains_join
from quadrant.session import python_ready, ship_package
from quadrant.sources.files import executor_filesystem



# ------------------------------------------------------------------ X3
def segment_timecodes(seg: DataFrame) -> DataFrame:
    """Begin / end / duration as time codes and integer ms time refs."""
    s = (seg.withColumn("begin_tr", seconds_text_to_ms("start_raw"))
            .withColumn("end_tr", seconds_text_to_ms("end_raw")))
    return (s.withColumn("duration_tr", F.col("end_tr") - F.col("begin_tr"))
             .withColumn("begin_tc", ms_to_timecode("begin_tr"))
             .withColumn("end_tc", ms_to_timecode("end_tr"))
             .withColumn("duration_tc", ms_to_duration("duration_tr")))


# ------------------------------------------------------------------ W2
LINE_RE = r"(?s)^([^-:]*)-([^-:]*)[^:]*:(.*)$"


def classify_lines(lines: DataFrame) -> DataFrame:
    """Tag each corrected line: 'text' (opens a segment), 'cont' (blank text,
    extends the segment above with its end if any) or 'noise' (ends a run)."""
    stripped = trim_space("line")
    ok = stripped.rlike(LINE_RE)
    body = trim_space(F.regexp_extract(stripped, LINE_RE, 3))
    kind = (F.when(stripped == "", F.lit("cont"))
             .when(ok & (body != ""), F.lit("text"))
             .when(ok, F.lit("cont"))
             .otherwise(F.lit("noise")))
    return lines.select(
        "file", "line_no", kind.alias("kind"),
        F.when(ok, trim_space(F.regexp_extract(stripped, LINE_RE, 1))).alias("start"),
        F.when(ok, trim_space(F.regexp_extract(stripped, LINE_RE, 2))).otherwise(F.lit("")).alias("end"),
        F.when(ok, body).alias("text"))


def coalesce_transcript(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Merge blank-text continuation lines into the text line above.

    Returns (segments(file, head_line_no, start, end, text), rejects(file, line_no, kind)).
    The island of a line is the last 'text' or 'noise' line at or before it,
    found by a block-wise carry-forward scan, so no file is ever gathered into
    a single task.
    """
    c = classify_lines(lines)
    heads = c.withColumn("_head", F.when(F.col("kind") != "cont", F.col("line_no")))
    isl = carry_forward(heads, ["file"], "line_no", "_head", "island")
    is_head = F.col("line_no") == F.col("island")
    seg = (isl.where(F.col("island").isNotNull())
              .groupBy("file", "island")
              .agg(F.max_by("kind", is_head).alias("head_kind"),
                   F.max_by("start", is_head).alias("start"),
                   F.max_by("text", is_head).alias("text"),
                   F.max_by("end", F.when(F.col("end") != "", F.col("line_no"))).alias("end")))
    segments = (seg.where(F.col("head_kind") == "text")
                   .select("file", F.col("island").alias("head_line_no"), "start", F.coalesce("end", F.lit("")).alias("end"), "text"))
    rejects = c.where(F.col("kind") == "noise").select("file", "line_no", "kind")
    return segments, rejects


# ------------------------------------------------------------------ K4 / K5
def txt_lines(seg: DataFrame, key_col: str = "media_key") -> DataFrame:
    """One 'start-end : text' line per segment, ordered by time."""
    return seg.select(key_col, "start_ms", "end_ms", "ord",
                      F.concat(F.col("start_raw"), F.lit("-"), F.col("end_raw"), F.lit(" : "), F.col("text")).alias("line"))


def srt_cues(seg: DataFrame, key_col: str = "media_key") -> DataFrame:
    """Numbered SRT cues (one row = one cue block, blank line added by the writer)."""
    numbered = group_position(seg, ["start_ms", "end_ms", "ord"], group=[key_col], name="cue")
    return numbered.select(key_col, "start_ms", "end_ms", "ord", F.concat(
        (F.col("cue") + 1).cast("string"), F.lit("\n"),
        ms_to_srt_stamp("start_ms"), F.lit(" --> "), ms_to_srt_stamp("end_ms"), F.lit("\n"),
        F.col("text"), F.lit("\n")).alias("line"))


# what Spark escapes in the name of a partition folder, and the folder of rows without a key
ESCAPED = re.compile("[\x01-\x1f\"#%'*/:=?\\\\\x7f{\\[\\]^]")
NO_KEY = "__HIVE_DEFAULT_PARTITION__"
READ_BYTES = 1 << 20


def write_documents(rows: DataFrame, key_col: str, order: list[str], line_col: str, path: str,
                    num_partitions: int | None = None) -> None:
    """Exactly one text file per key (a media's TXT or SRT document), lines in
    order: range-partition on the key alone (rows of one key never straddle a
    bound), sort within partitions by (key, order), and let each task write the files of
    its keys, `<path>/<key_col>=<key>/part-00000.txt`; neighbouring keys share a task.

    One file per media is the deliverable, and a file has one writer: a task
    writes the documents of its key range, each bounded by one recording's
    length, never by the archive's size. Executors write the files, so the driver knows
    none of them: to a folder beside `path`, which takes its place when all are written. A
    file is written under a hidden name and renamed, so a repeated task replaces it."""
    spark = rows.sparkSession
    python_ready(spark)
    ship_package(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    fresh = f"{path.rstrip('/')}.{uuid.uuid4().hex[:12]}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = executor_filesystem(fresh)
        folder, hidden, out, n_files = None, None, None, 0

        def close() -> None:
            out.close()
            filesystem.move(hidden, f"{folder}/part-00000.txt")
        for batch in batches:
            for key, line in zip(batch.column("key").to_pylist(), batch.column("line").to_pylist()):
                name = NO_KEY if key is None else ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", key)
                if folder != f"{root}/{key_col}={name}":
                    if out:
                        close()
                    folder, n_files = f"{root}/{key_col}={name}", n_files + 1
                    hidden = f"{folder}/.{uuid.uuid4().hex}"
                    filesystem.create_dir(folder, recursive=True)
                    out = filesystem.open_output_stream(hidden, compression=None)
                out.write(line or b"")
                out.write(b"\n")
        if out:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([n_files], pa.int64())], ["n"])

    key = F.col(key_col).cast("string")
    (rows.withColumn(key_col, F.when(key != "", key)).repartitionByRange(n, key_col)
         .sortWithinPartitions(key_col, *order)
         .select(F.col(key_col).alias("key"), F.col(line_col).cast("binary").alias("line"))
         .mapInArrow(write, "n long").agg(F.sum("n")).first())
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    store = at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(at(fresh))  # there may be no rows
    store.delete(at(path), True)
    if not store.rename(at(fresh), at(path)):
        raise OSError(f"can't rename {fresh} to {path}")


def file_lines(stream) -> Iterator[list[bytes]]:
    """The lines of a file, piece by piece; they end with LF, CR or CRLF, as in Spark's text source."""
    rest, first = b"", True
    while block := stream.read(READ_BYTES):
        data = rest + block
        if first and len(data) >= 3:
            data, first = data.removeprefix(b"\xef\xbb\xbf"), False
        # a CR that ends the piece may be half of a CRLF
        whole = max(data.rfind(b"\n"), data.rfind(b"\r", 0, -1)) + 1
        rest = data[whole:]
        if whole:
            yield data[:whole].splitlines()
    if rest:
        yield rest.splitlines()


def read_documents(spark, path: str, key_col: str) -> DataFrame:
    """Read documents back as (key, line, line_no).

    The folders of the keys are listed by one task and read by many, a key's files in the
    order of their names: the position of a line is known as it is read, files are read
    piece by piece, and the driver knows none of them. The key is read as text: `007` and
    `1.10` are keys, not numbers.
    """
    kinds = pa.schema([("key", pa.string()), ("line", pa.binary()), ("line_no", pa.int64())])
    seen = lambda info: info.base_name[0] not in "._"

    def folders(_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = executor_filesystem(path)
        infos = [i for i in filesystem.get_file_info(FileSelector(root)) if seen(i)]
        for i in infos:
            if i.is_file or not i.base_name.startswith(f"{key_col}="):
                raise ValueError(f"{i.path} is no folder of a {key_col}")
        for at in range(0, len(infos), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array([i.base_name for i in infos[at:at + 10_000]], pa.string())], ["folder"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = executor_filesystem(path)
        keys, lines, numbers, size = [], [], [], 0
        for batch in batches:
            for folder in batch.column("folder").to_pylist():
                name = folder.removeprefix(f"{key_col}=")
                key = None if name == NO_KEY else re.sub("%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), name)
                infos = filesystem.get_file_info(FileSelector(f"{root}/{folder}", recursive=True))
                number = 0
                for info in sorted((i for i in infos if i.is_file and seen(i)), key=lambda i: i.base_name):
                    with filesystem.open_input_stream(info.path) as stream:
                        for part in file_lines(stream):
                            lines += part
                            keys += [key] * len(part)
                            numbers += range(number, number + len(part))
                            number += len(part)
                            size += sum(map(len, part))
                            if size >= READ_BYTES or len(lines) >= 10_000:
                                yield pa.RecordBatch.from_pydict({"key": keys, "line": lines, "line_no": numbers}, schema=kinds)
                                keys, lines, numbers, size = [], [], [], 0
        yield pa.RecordBatch.from_pydict({"key": keys, "line": lines, "line_no": numbers}, schema=kinds)
    ship_package(spark)
    names = spark.range(0, 1, 1, 1).mapInArrow(folders, "folder string").repartition(spark.sparkContext.defaultParallelism, "folder")
    return names.mapInArrow(read, "key string, line binary, line_no long").select(
        F.col("key").alias(key_col), F.col("line").cast("string").alias("line"), "line_no")


# ------------------------------------------------------------------ A8
def layer_stats(seg: DataFrame, key_col: str = "media") -> DataFrame:
    return seg.groupBy(key_col).agg(
        F.count(F.lit(1)).alias("n_segments"),
        F.sum(F.col("end_ms") - F.col("start_ms")).cast("bigint").alias("total_ms"),
        F.min("start_ms").alias("first_ms"), F.max("end_ms").alias("last_ms"),
        (F.count(F.lit(1)) - F.countDistinct("start_raw")).alias("shared_starts"))


# ------------------------------------------------------------------ F7 / J7
def with_media_key(df: DataFrame, media_col: str = "media", keep_version: bool = False,
                   name: str = "media_key") -> DataFrame:
    return df.withColumn(name, media_key(media_col, keep_version))


def media_with_transcript(media: DataFrame, file_keys: DataFrame) -> DataFrame:
    """Media whose derived key has a transcript file (semi-join)."""
    m = with_media_key(media)
    return m.join(file_keys.select(F.col("file_key").alias("media_key")).distinct(), "media_key", "left_semi")


# ------------------------------------------------------------------ J9
def file_to_title(files: DataFrame, catalogue: DataFrame) -> DataFrame:
    """File key -> title of the first catalogue row (by ord) whose media
    contains the key (literal); files without a match keep a null title."""
    keys = files.select("file_key", F.col("file_key").alias("_pattern"))
    hits = contains_join(keys, ["file_key"], "_pattern", catalogue.select("ord", "media"), ["ord"], "media")
    best = hits.groupBy("file_key").agg(F.min("ord").alias("ord"))
    titled = best.join(catalogue.select("ord", "title"), "ord").drop("ord")
    first_title = catalogue.select(F.min_by("title", "ord")).scalar()
    out = files.select("file_key").distinct().join(titled, "file_key", "left")
    # an empty key is contained in every media: its answer is the first row overall
    out = out.withColumn("title", F.when(F.col("file_key") == "", first_title).otherwise(F.col("title")))
    return out.withColumn("name", strip_punctuation("title"))


# ------------------------------------------------------------------ J10
def speaker_name(txtname: F.Column) -> F.Column:
    """Text between 'entretien avec ' and the next '(' of a file name."""
    # names without the marker give null (no match) instead of an ANSI error
    after = F.try_element_at(F.split(txtname, K.INTERVIEW_MARKER, 2), F.lit(2))
    return F.split_part(after, F.lit("("), F.lit(1))


def name_to_media(txt: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Corrected TXT file -> transcript JSON name.

    'lintoai' names carry the key after '__.'; other names are matched on the
    speaker name, case-insensitively, against catalogue titles: among hits the
    first whose key ends 'v2', else the first; none -> 'No match found'.
    """
    linto = F.col("txtname").contains("lintoai")
    # '<anything>__.<key>.lintoai.txt' -> '<key>.lintoai.json'
    tail_part = F.try_element_at(F.split(F.col("txtname"), re.escape(K.LINTO_NAME_MARKER), 2), F.lit(2))
    direct = F.concat(F.expr("substring(_tail, 1, length(_tail) - 3)"), F.lit("json"))
    t = (txt.withColumn("_tail", tail_part)
            .select("txtname", F.when(~linto, F.lower(speaker_name(F.col("txtname")))).alias("_name"),
                    F.when(linto, direct).alias("_direct")))
    cat = catalogue.select("ord", F.lower(F.col("title")).alias("_title"),
                           F.element_at(F.split(F.col("media"), ":"), -1).alias("_key"))
    rank = F.struct((~F.col("_key").endswith("v2")).alias("_not_v2"), F.col("ord"))
    # distinct names meet the titles; many files carry the same speaker's name
    names = t.where(F.col("_name").isNotNull()).select("_name", F.col("_name").alias("_pattern")).distinct()
    hits = contains_join(names, ["_name"], "_pattern", cat.select("ord", "_title"), ["ord"], "_title")
    best = (hits.join(cat.select("ord", "_key"), "ord")
                .groupBy("_name").agg(F.min_by("_key", F.struct(~F.col("_key").endswith("v2"), F.col("ord"))).alias("_key")))
    # an empty name is contained in every title: the best row overall answers it
    any_key = cat.select(F.min_by("_key", rank)).scalar()
    # files that carry their key don't meet the join
    named = t.where(F.col("_name").isNotNull()).join(best, "_name", "left").select("txtname", "_name", "_direct", "_key")
    out = named.unionByName(t.where(F.col("_name").isNull()).withColumn("_key", F.lit(None).cast("string")))
    key = F.when(F.col("_name") == "", any_key).otherwise(F.col("_key"))
    json_name = F.coalesce(F.col("_direct"),
                           F.concat(F.coalesce(key, F.lit(K.NO_MATCH)), F.lit(K.TRANSCRIPT_FILE_SUFFIX)))
    return out.select("txtname", json_name.alias("jsonname"))


# ------------------------------------------------------------------ X2
def transcribe(media_files: DataFrame, model: Callable[[bytes, str], list[dict]], language: str = "fr",
               key_col: str = "media_key") -> DataFrame:
    """Pluggable transcriber: (media bytes) -> segments, run in Arrow batches on
    the executors holding the files. `model(content, language)` returns dicts
    with start, end (seconds, as text), text and optional confidence."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for key, content in zip(pdf[key_col], pdf["content"]):
                for i, s in enumerate(model(bytes(content), language)):
                    rows.append({key_col: key, "ord": i, "start_raw": str(s["start"]), "end_raw": str(s["end"]),
                                 "text": s["text"], "confidence": s.get("confidence")})
            yield pd.DataFrame(rows, columns=[key_col, "ord", "start_raw", "end_raw", "text", "confidence"])

    schema = f"{key_col} string, ord bigint, start_raw string, end_raw string, text string, confidence double"
    ship_package(media_files.sparkSession)
    out = media_files.select(key_col, "content").mapInPandas(run, schema)
    return (out.withColumn("start_ms", seconds_text_to_ms("start_raw"))
               .withColumn("end_ms", seconds_text_to_ms("end_raw")))
