"""Cross-tokenizer alignment (operator 12) with an identity-map fast path.

Each text is encoded by a byte-level BPE (A) and a piece BPE (B). Byte offsets at
which tokens of both end cut them into groups; the last tokens of a group are
linked. `identity` gives the B id that has the bytes of an A id, made once a worker:
a group of one A and one B token with that id is counted in a vector as long as A's
vocabulary; only the pairs of the other groups are counted by a shuffle.

1. Documents are encoded in slabs (`SLAB_BYTES` of text, one row each), written to
   the shared folder: per document its numbers, the digest of its groups and its
   distinct links with their multiplicity; per slab the identity counts and the
   distinct other pairs.
2. Identity counts are summed to one vector, pairs by (a, b); the best count of each
   B id is a vector as long as B's vocabulary. Both vectors are bounded by the
   vocabularies and go to the tasks; pair counts go back to the slabs that hold the
   pair by a join, one row per slab and distinct pair, so a frequent pair has as
   many rows as slabs and not as occurrences.
3. Each slab sums its documents' counts.

A pair of an irregular group is never an identity pair: equal bytes that end
together also start together, and would be a group of one and one.

A is encoded by byte pair merging over the vocabulary of A's own file, whose ids are
the merge ranks (the loader checks it); the result equals the library's.

Defined cases: null and empty texts, and texts whose joined token bytes differ
from space + text (characters that B normalises or writes with its space sign)
have no tokens: zeros and an empty digest; special tokens' strings are plain text;
a text of any length is encoded whole; repeated rows and ids give repeated
results and count each time; an empty table gives an empty result; only the id
and text columns are read, so any other column may have any name.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrant.llm.bpe import byte_letters, ship_vocabulary
from quadrant.llm.common import python_ready, slices, written

SLAB_BYTES, SLICE_BYTES = 8 << 20, 1 << 20
#: How byte-level vocabularies of this kind cut a text into words (fixed by the file's pre-tokenizer).
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteLevel:
    """Tokenizer A."""

    def __init__(self, path: str):
        import tiktoken
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cut = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or spec["normalizer"] or cut["type"] != "ByteLevel" or cut["add_prefix_space"]:
            raise ValueError(f"{path}: a byte-level BPE vocabulary without prefix space is wanted")
        byte = {c: b for b, c in enumerate(byte_letters())}
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
        merged = [bytes(byte[c] for c in "".join(m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
        if [ranks[m] for m in merged] != sorted(ranks[m] for m in merged) or len(ranks) != len(merged) + 256:
            raise ValueError(f"{path}: ids must follow the merges")
        self.bytes: list[bytes] = [b""] * (max(model["vocab"].values()) + 1)
        for token, i in model["vocab"].items():
            self.bytes[i] = token.encode() if token in special else bytes(byte[c] for c in token)
        self.coder = tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.coder.encode_ordinary(" " + t) for t in texts]


class Pieces:
    """Tokenizer B."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [self._bytes(self.model.id_to_piece(i)) for i in range(self.model.get_piece_size())]

    @staticmethod
    def _bytes(piece: str) -> bytes:
        if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Aligner:
    """Aligns slices of texts."""

    def __init__(self, a, b):
        self.a, self.b = a, b
        self.size_a, self.size_b = (np.array([len(x) for x in t.bytes], np.int64) for t in (a, b))
        by_bytes: dict[bytes, int] = {}
        for i, raw in enumerate(b.bytes):  # a byte's own piece stands before the byte fallback of the same bytes
            if raw and (raw not in by_bytes or b.model.is_byte(by_bytes[raw])):
                by_bytes[raw] = i
        self.identity = np.array([by_bytes.get(raw, -1) for raw in a.bytes], np.int64)

        def table(mark: str, n: int) -> np.ndarray:
            return np.array([f"{mark}{i}" for i in range(n)], object)
        self.next_a, self.first_a = table(",", len(a.bytes)), table(";", len(a.bytes))
        self.next_b, self.first_b = table(",", len(b.bytes)), table("|", len(b.bytes))

    def align(self, texts: list[str | None]) -> dict:
        """Per text n_a, n_b, n_groups and digest; of all groups in a row `text`
        (number of the text), `a` and `b` (linked ids) and `same` (identity)."""
        n = len(texts)
        out = {"n_a": np.zeros(n, np.int64), "n_b": np.zeros(n, np.int64), "n_groups": np.zeros(n, np.int64), "digest": [""] * n}
        some = [i for i, t in enumerate(texts) if t]
        wanted = [texts[i] for i in some]
        ids_a, ids_b = self.a.encode(wanted), self.b.encode(wanted)
        good = []
        for k, text in enumerate(wanted):
            raw = b" " + text.encode("utf-8", "surrogatepass")
            if all(b"".join([t.bytes[i] for i in ids[k]]) == raw for t, ids in ((self.a, ids_a), (self.b, ids_b))):
                good.append(k)
        flat_a, flat_b = (np.fromiter(chain.from_iterable(ids[k] for k in good), np.int32) for ids in (ids_a, ids_b))
        count_a, count_b = (np.array([len(ids[k]) for k in good], np.int64) for ids in (ids_a, ids_b))
        del ids_a, ids_b
        end_a, end_b = np.cumsum(self.size_a[flat_a]), np.cumsum(self.size_b[flat_b])
        at = np.full(int(end_a[-1]) + 1 if len(end_a) else 1, -1, np.int64)
        at[end_b] = np.arange(len(end_b))
        last_a = np.flatnonzero(at[end_a] >= 0)  # of each group
        last_b = at[end_a[last_a]]
        before_a, before_b = (np.concatenate([[-1], x[:-1]]) for x in (last_a, last_b))
        link_a, link_b = flat_a[last_a], flat_b[last_b]
        same = (last_a - before_a == 1) & (last_b - before_b == 1) & (self.identity[link_a] == link_b)
        text = np.repeat(np.arange(len(good)), count_a)[last_a]
        # `a1,a2|b1;a3|b2,b3`: the tokens of both, group by group
        parts = np.empty(len(flat_a) + len(flat_b), object)
        group_a = np.repeat(np.arange(len(last_a)), last_a - before_a)
        group_b = np.repeat(np.arange(len(last_b)), last_b - before_b)
        names_a, names_b = self.next_a[flat_a], self.next_b[flat_b]
        names_a[before_a + 1], names_b[before_b + 1] = self.first_a[flat_a[before_a + 1]], self.first_b[flat_b[before_b + 1]]
        parts[np.arange(len(flat_a)) + before_b[group_a] + 1] = names_a
        parts[np.arange(len(flat_b)) + last_a[group_b] + 1] = names_b
        names = parts.tolist()
        stops = np.concatenate([[0], np.cumsum(count_a + count_b)]).tolist()
        rows = np.array([some[k] for k in good], np.int64)
        out["n_a"][rows], out["n_b"][rows] = count_a, count_b
        out["n_groups"][rows] = np.bincount(text, minlength=len(good))
        for row, lo, hi in zip(rows.tolist(), stops, stops[1:], strict=False):
            out["digest"][row] = hashlib.sha256("".join(names[lo:hi])[1:].encode()).hexdigest()
        return out | {"text": rows[text].astype(np.int32), "a": link_a, "b": link_b, "same": same}


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a: str, b: str) -> Aligner:
    """The worker's aligner, kept for its next tasks."""
    if (a, b) not in _aligners:
        _aligners.clear()
        _aligners[a, b] = Aligner(ByteLevel(SparkFiles.get(a)), Pieces(SparkFiles.get(b)))
    return _aligners[a, b]


def distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(key, return_counts=True)


def slab_row(slab: int, ids: pa.Array, found: list[dict]) -> pa.RecordBatch:
    """One row of the documents of a slab."""
    base = np.cumsum([0] + [len(f["n_a"]) for f in found])
    text = np.concatenate([f["text"] + b for f, b in zip(found, base, strict=False)]).astype(np.int64)
    a, b, same = (np.concatenate([f[c] for f in found]) for c in ("a", "b", "same"))
    n = int(base[-1])
    # identity links: one distinct (document, a) each; the others by their place in the slab's list of pairs
    doc_same, n_same = distinct(text[same] << 32 | a[same])
    pairs, place = np.unique(a[~same].astype(np.int64) << 32 | b[~same], return_inverse=True)
    doc_pair, n_pair = distinct(text[~same] << 32 | place)
    pair_n = np.bincount(place, minlength=len(pairs))
    ids_same, slab_same = distinct(a[same])
    low = (1 << 32) - 1

    def whole(values: np.ndarray, kind: pa.DataType) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))
    columns = {
        "slab": pa.array([slab], pa.int64()),
        "ids": pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), ids),
        **{c: whole(np.concatenate([f[c] for f in found]), pa.int64()) for c in ("n_a", "n_b", "n_groups")},
        "digest": pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), pa.array([d for f in found for d in f["digest"]], pa.string())),
        "same_docs": whole(np.bincount(doc_same >> 32, minlength=n), pa.int32()), "same_a": whole(doc_same & low, pa.int32()), "same_n": whole(n_same, pa.int32()),
        "pair_docs": whole(np.bincount(doc_pair >> 32, minlength=n), pa.int32()), "pair_at": whole(doc_pair & low, pa.int32()), "pair_n": whole(n_pair, pa.int32()),
        "total_a": whole(ids_same, pa.int32()), "total_n": whole(slab_same, pa.int64()),
        "a": whole(pairs >> 32, pa.int32()), "b": whole(pairs & low, pa.int32()), "n": whole(pair_n, pa.int64()),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def slabs_of(docs: DataFrame, file_a: str, file_b: str, id_col: str, text_col: str, slab_bytes: int = SLAB_BYTES) -> DataFrame:
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, part, number = aligner(file_a, file_b), TaskContext.get().partitionId(), 0
        ids, found, size = [], [], 0
        for piece in slices(batches, "text", SLICE_BYTES):
            ids.append(piece.column("id"))
            found.append(tool.align(piece.column("text").to_pylist()))
            size += piece.column("text").nbytes
            if size >= slab_bytes:
                yield slab_row(part << 32 | number, pa.concat_arrays(ids), found)
                ids, found, size, number = [], [], 0, number + 1
        if ids:
            yield slab_row(part << 32 | number, pa.concat_arrays(ids), found)
    longs, ints = "array<long>", "array<int>"
    schema = (f"slab long, ids array<{kind}>, n_a {longs}, n_b {longs}, n_groups {longs}, digest array<string>, same_docs {ints}, same_a {ints}, same_n {ints}, "
              f"pair_docs {ints}, pair_at {ints}, pair_n {ints}, total_a {ints}, total_n {longs}, a {ints}, b {ints}, n {longs}")
    return written(rows.mapInArrow(run, schema), "alignment-slabs")


def vector(rows: DataFrame, key: str, value: str, size: int) -> np.ndarray:
    """(key, value) rows, at most one per id of a vocabulary, as a vector."""
    out = np.zeros(size, np.int64)
    for r in rows.select(key, value).collect():  # bounded by the vocabulary
        out[r[key]] = r[value]
    return out


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", slab_bytes: int = SLAB_BYTES) -> DataFrame:
    """Per row of `docs`: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    python_ready(spark)
    tool = Aligner(ByteLevel(path_a), Pieces(path_b))
    slabs = slabs_of(docs, ship_vocabulary(spark, path_a), ship_vocabulary(spark, path_b), id_col, text_col, slab_bytes)
    same = vector(slabs.select(F.explode(F.arrays_zip("total_a", "total_n")).alias("x")).groupBy(F.col("x.total_a").alias("a"))
                       .agg(F.sum("x.total_n").alias("total")), "a", "total", len(tool.identity))
    pairs = slabs.select("slab", F.posexplode(F.arrays_zip("a", "b", "n")).alias("place", "x")).select("slab", "place", "x.a", "x.b", "x.n")
    totals = written(pairs.groupBy("a", "b").agg(F.sum("n").alias("total")), "alignment-pairs")
    best = vector(totals.groupBy("b").agg(F.max("total").alias("most")), "b", "most", len(tool.size_b))
    known = tool.identity >= 0
    np.maximum.at(best, tool.identity[known], same[known])
    back = (pairs.drop("n").join(totals, ["a", "b"]).groupBy("slab")
                 .agg(F.collect_list(F.struct("place", "total")).alias("found")))
    rows = slabs.drop("total_a", "total_n", "a", "n").join(back, "slab", "left")
    identity = tool.identity
    kind = rows.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].values for c in batch.schema.names if c != "slab"}
                arrays = {c: row[c].to_numpy() for c in ("same_docs", "same_a", "same_n", "pair_docs", "pair_at", "pair_n", "b", "n_groups")}
                n = len(row["ids"])
                total = np.zeros(len(arrays["b"]), np.int64)
                if row["found"] is not None:
                    total[row["found"].field("place").to_numpy()] = row["found"].field("total").to_numpy()
                n_best, sums = np.zeros(n, np.int64), np.zeros(n, np.int64)
                for docs_of, counts, tops, times in (
                        (arrays["same_docs"], same[arrays["same_a"]], best[identity[arrays["same_a"]]], arrays["same_n"]),
                        (arrays["pair_docs"], total[arrays["pair_at"]], best[arrays["b"][arrays["pair_at"]]], arrays["pair_n"])):
                    doc = np.repeat(np.arange(n), docs_of)
                    np.add.at(n_best, doc, np.where(counts == tops, times, 0))
                    np.add.at(sums, doc, counts * times.astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [row["ids"], row["n_a"], row["n_b"], row["n_groups"], row["n_groups"], pa.array(n_best), pa.array(sums), row["digest"]],
                    ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])
    out = rows.mapInArrow(run, f"id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
    return out.withColumnRenamed("id", id_col)
