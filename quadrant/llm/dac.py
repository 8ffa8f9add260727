"""Token-ID binary output (operator 7): directly addressable codes.

Ids are split into chunks of a few bits, lowest first. Level 0 holds the first
chunk of every id; a continuation bitmap marks the ids that go on, and their next
chunk stands in level 1 at the place that the bitmap's rank gives; and so on. A
rank directory (ones before every 512 bits) makes any id readable by itself,
without decoding a block. The chunk widths of a file are those with the smallest
size for its ids (dynamic programme over their bit lengths).

Files hold ascending, contiguous ranges of ids: documents are dealt to range
buckets (borders from approximate percentiles of doc_id, one pass over that
column), sorted in their task and streamed into files of at most `FILE_TOKENS`
ids beyond the last document. A file is written under a temporary name and then
renamed, and its name follows from the bucket, so a repeated task replaces it.

Defined cases: null and empty texts have the end id only; a null doc_id sorts
first; rows that share a doc_id are ordered by a hash of their texts; a text of
any length is kept whole in one file; an empty table gives no files and an empty
result; only the id and text columns are read, so any other column may have any
name.
"""

from __future__ import annotations

import posixpath
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import SparkFiles
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quadrant.llm import bpe
from quadrant.llm.common import borders, bucket_of, python_ready, shuffle_partitions, slices, written
from quadrant.session import work_dir

FILE_TOKENS = 4 << 20
READ_TOKENS = 1 << 19
BLOCK = 512  # bits between two entries of a rank directory


def best_widths(values: np.ndarray) -> list[int]:
    """Chunk widths, lowest chunk first, that need the fewest bits for these values."""
    lengths = np.bincount(np.maximum(1, np.ceil(np.log2(values.astype(np.float64) + 1)).astype(int)), minlength=2) if len(values) else np.array([0, 1])
    top = len(lengths) - 1
    beyond = [int(lengths[b + 1:].sum()) if b else int(lengths.sum()) for b in range(top + 1)]  # ids with a chunk from bit b on
    cost, cut = [0] * (top + 1), [top] * (top + 1)
    for a in range(top - 1, -1, -1):  # cost[a]: of all bits from a on
        cost[a], cut[a] = min((beyond[a] * (b - a + (b < top)) + cost[b], b) for b in range(a + 1, top + 1))
    widths, at = [], 0
    while at < top:
        widths.append(cut[at] - at)
        at = cut[at]
    return widths


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """`width` bits of each value in a row (8 spare bytes at the end for reads)."""
    out, shifts = [], np.arange(width, dtype=np.uint32)
    for i in range(0, len(values), 1 << 16):
        bits = (values[i:i + (1 << 16), None] >> shifts) & 1
        out.append(np.packbits(bits.astype(np.uint8).reshape(-1), bitorder="little"))
    return np.concatenate([*out, np.zeros(8, np.uint8)])


def unpack(packed: np.ndarray, width: int, at: np.ndarray) -> np.ndarray:
    """The values at the given places."""
    bit = at * width
    byte = bit >> 3
    window = np.zeros(len(at), np.uint64)
    for k in range((width + 14) // 8):
        window |= packed[byte + k].astype(np.uint64) << np.uint64(8 * k)
    return ((window >> (bit & 7).astype(np.uint64)) & np.uint64((1 << width) - 1)).astype(np.int64)


def write_codes(values: np.ndarray) -> dict[str, np.ndarray]:
    """The arrays of a file: widths, and of each level its chunks, bitmap and rank directory."""
    widths = best_widths(values)
    out, rest = {"widths": np.array(widths, np.int32), "n": np.array([len(values)], np.int64)}, values.astype(np.uint32)
    for k, width in enumerate(widths):
        out[f"chunks{k}"] = pack(rest & np.uint32((1 << width) - 1), width)
        if k + 1 < len(widths):
            rest = rest >> np.uint32(width)
            go = rest > 0
            words = np.zeros(-(-(len(go) + 1) // BLOCK) * BLOCK // 8, np.uint8)
            words[:-(-len(go) // 8)] = np.packbits(go, bitorder="little")
            ones = np.bitwise_count(words.view(np.uint64)).reshape(-1, BLOCK // 64).sum(1)
            out[f"bitmap{k}"] = words.view(np.uint64)
            out[f"ranks{k}"] = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype(np.uint32)
            rest = rest[go]
    return out


class Codes:
    """Random access to the ids of a file."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.a, self.widths = arrays, arrays["widths"].tolist()

    def __len__(self) -> int:
        return int(self.a["n"][0])

    def bits(self, level: int, at: np.ndarray) -> np.ndarray:
        return (self.a[f"bitmap{level}"][at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0

    def rank(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones of the level's bitmap before each place."""
        words, first = self.a[f"bitmap{level}"], at // BLOCK * (BLOCK // 64)
        out = self.a[f"ranks{level}"][at // BLOCK].astype(np.int64)
        last = at >> 6
        for k in range(BLOCK // 64):
            inside = first + k < last
            out += np.where(inside, np.bitwise_count(words[np.minimum(first + k, len(words) - 1)]), 0)
        return out + np.bitwise_count(words[last] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)))

    def get(self, at: np.ndarray, level: int = 0) -> np.ndarray:
        """The ids at any places, each found by itself."""
        out = unpack(self.a[f"chunks{level}"], self.widths[level], at)
        if level + 1 < len(self.widths) and len(at):
            go = np.flatnonzero(self.bits(level, at))
            if len(go):
                out[go] |= self.get(self.rank(level, at[go]), level + 1) << self.widths[level]
        return out

    def range(self, start: int, stop: int) -> np.ndarray:
        """The ids from start to stop: one rank a level, as neighbours stay neighbours."""
        return self._run(start, stop, 0)

    def _run(self, start: int, stop: int, level: int) -> np.ndarray:
        at = np.arange(start, stop)
        out = unpack(self.a[f"chunks{level}"], self.widths[level], at)
        if level + 1 < len(self.widths) and len(at):
            go = np.flatnonzero(self.bits(level, at))
            if len(go):
                first = int(self.rank(level, at[go[:1]])[0])
                out[go] |= self._run(first, first + len(go), level + 1) << self.widths[level]
        return out


class LibraryVocabulary(bpe.Vocabulary):
    """Words are encoded by the tokenizers library's own model."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        super().__init__(path)
        self.model = Tokenizer.from_file(path).model

    def merge_all(self, words: list[str]) -> list[list[int]]:
        letters = self.letters
        return [[t.id for t in self.model.tokenize("".join([letters[b] for b in w.encode("utf-8", "surrogatepass")]))] for w in words]


_encoders: dict[str, bpe.Encoder] = {}


def library_encoder(file: str) -> bpe.Encoder:
    """Each distinct word goes through the library; a worker remembers the last ones."""
    if file not in _encoders:
        _encoders[file] = bpe.Encoder(LibraryVocabulary(SparkFiles.get(file)), bpe.NO_LEXICON)
    return _encoders[file]


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def write_files(docs: DataFrame, path: str, folder: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the token ids of all documents in ascending id order; the manifest
    (bucket, part, name, docs, tokens), one row per file."""
    spark = docs.sparkSession
    python_ready(spark)
    file = bpe.ship_vocabulary(spark, path)
    n = shuffle_partitions(spark)
    cuts = borders(docs, id_col, 4 * n)
    rows = docs.select(bucket_of(F.col(f"`{id_col}`"), cuts).alias("bucket"), F.col(f"`{id_col}`").cast("long").alias("id"),
                       F.col(f"`{text_col}`").alias("text"))
    rows = rows.repartition(n, "bucket").sortWithinPartitions("bucket", F.col("id").asc_nulls_first(), F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = library_encoder(file)
        fs, base = filesystem(folder)
        fs.create_dir(base, recursive=True)
        bucket, part, ids, counts, names = None, 0, [], [], []

        def close() -> pa.RecordBatch:
            values, n_ids = np.concatenate(ids), np.concatenate(counts)
            arrays = write_codes(values) | {"doc_id": np.array([x or 0 for x in names], np.int64),
                                            "doc_null": np.array([x is None for x in names], np.uint8),
                                            "doc_start": np.concatenate([[0], np.cumsum(n_ids)]).astype(np.int64)}
            name = f"{bucket:07d}-{part:05d}.dac"
            with fs.open_output_stream(posixpath.join(base, f".{name}.{id(values):x}")) as f:
                f.write(bpe.to_file(arrays))
            fs.move(posixpath.join(base, f".{name}.{id(values):x}"), posixpath.join(base, name))
            return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([part], pa.int32()), pa.array([name]),
                                               pa.array([len(names)], pa.int64()), pa.array([len(values)], pa.int64())],
                                              ["bucket", "part", "name", "docs", "tokens"])
        for piece in slices(batches, "text"):
            got, at = e.encode(piece.column("text").to_pylist())
            buckets = piece.column("bucket").to_numpy()
            doc_ids = piece.column("id").to_pylist()
            edges = [0, *(np.flatnonzero(np.diff(buckets)) + 1).tolist(), len(buckets)]
            for a, b in zip(edges, edges[1:], strict=False):
                if bucket is not None and (buckets[a] != bucket or sum(map(len, ids)) >= FILE_TOKENS):
                    yield close()
                    part = part + 1 if buckets[a] == bucket else 0
                    ids, counts, names = [], [], []
                bucket = int(buckets[a])
                ids.append(np.insert(got[at[a]:at[b]], at[a + 1:b + 1] - at[a], end_id).astype(np.uint32))
                counts.append(np.diff(at[a:b + 1]) + 1)
                names += doc_ids[a:b]
        if bucket is not None:
            yield close()
    return written(rows.mapInArrow(run, "bucket int, part int, name string, docs long, tokens long"), "dac-manifest")


def blocks(start: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of documents of about READ_TOKENS ids (one document at least)."""
    first = 0
    while first < len(start) - 1:
        last = max(first + 1, int(np.searchsorted(start, start[first] + READ_TOKENS, "right")) - 1)
        yield first, last
        first = last


def read_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Documents of the files: doc_id, start (ids before it in all files), n_tokens, ids_crc32."""
    spark = manifest.sparkSession
    before = Window.orderBy("bucket", "part").rowsBetween(Window.unboundedPreceding, -1)
    bases = manifest.select("name", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.dac").load(folder)
    rows = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content").join(bases, "name").select("base", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, content in zip(batch.column("base").to_pylist(), batch.column("content"), strict=True):
                arrays = bpe.from_bytes(np.frombuffer(content.as_buffer(), np.uint8))
                codes, start = Codes(arrays), arrays["doc_start"]
                sums = []
                for first, last in blocks(start):
                    ids = codes.range(int(start[first]), int(start[last])).astype("<u4")
                    at = (start[first:last + 1] - start[first]).tolist()
                    sums += [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(at, at[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(arrays["doc_id"], mask=arrays["doc_null"] != 0), pa.array(start[:-1] + base),
                     pa.array(np.diff(start)), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])
    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def store_tokens(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """Write the files to a fresh shared folder; the manifest and the folder."""
    folder = work_dir(docs.sparkSession, "tokens")
    return write_files(docs, path, folder, end_id, id_col, text_col), folder
