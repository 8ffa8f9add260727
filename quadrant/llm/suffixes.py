"""Suffix-array dedup (operator 11): bytes covered by a string of `WINDOW` bytes that
also starts in a document with a smaller id.

The suffix array is sparse: it holds the suffixes that start at anchors. Anchors are
the places whose `GRAM` bytes have the least hash in some window, so two equal
windows hold the same anchors at the same places, and a window repeats only if its
anchor's gram does.

1. Documents are written once as slabs (about `SLAB_BYTES`), in a table bucketed by
   slab, so that later steps read them without a shuffle.
2. Which grams stand under two ids or more: each slab sends its distinct gram hashes
   (48 bits, sorted, delta-coded, a few bytes each) by hash range; the answer goes back
   to the slabs that hold them. Only anchors of such grams go on.
3. Suffixes of these anchors: 50 bytes from the anchor on and up to 16 before it.
   Equal ones of a slab go as one, with the least id. They are range-partitioned by
   their leading bytes; the splitters are percentiles of leading bytes sampled from all
   documents. Each bucket is sorted by multikey sorting (eight bytes at a time, only
   what is still tied goes on). Neighbours with the same gram are compared for each
   place that a window can have around the anchor: the least id that has the window.
   Leading bytes that fill several ranges are dealt out among them by the gram's
   hash, so equal grams always meet in one bucket and nothing is left to compare
   across a boundary. Grams that stand in very many places (`HOT`) are sent as
   their single windows, dealt out by the window's hash, so that none gathers in one
   bucket.
4. The slabs get a bit for each window of their suffixes, and remove the bytes.

Gram hashes only choose candidates; windows are compared byte by byte.

Defined cases: null and empty texts have no bytes and nothing removed; texts shorter
than a window stay whole; documents with equal ids don't shorten each other; a null
id stands after all others; a text of any length is read in blocks; matches never
cross documents; an empty table gives an empty result; only the id (an integer) and
text columns are read, so any other column may have any name.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrant.llm.common import python_ready, shuffle_partitions, slices, written
from quadrant.session import work_dir

WINDOW, GRAM = 50, 34
#: Bytes before the anchor that a window can have, and windows around an anchor.
LEFT = WINDOW - GRAM
SPAN = LEFT + 1
SLAB_BYTES, BLOCK_BYTES = 4 << 20, 1 << 18
HOT = 1 << 14
#: Hash ranges and suffix buckets a shuffle partition.
PARTS = 4
#: Bytes of a suffix as sorted: 50 from the anchor on, 16 before it, the places its
#: windows can have (first, last), filled up to nine words.
WORDS = 9
LAST_ID = (1 << 63) - 1

_RANDOM = np.random.default_rng(20).integers(1, 1 << 62, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = 0x9E3779B97F4A7C15


def _power(k: int) -> np.uint64:
    return np.uint64(pow(_STEP, k, 1 << 64))


def gram_hashes(x: np.ndarray) -> np.ndarray:
    """Mixed hash of the GRAM bytes from each place on (the last places hold rubbish)."""
    h = _RANDOM[x]
    two = h

    def join(a: np.ndarray, b: np.ndarray, size: int, more: int) -> np.ndarray:
        out = a * _power(more)
        out[:-size] += b[size:]
        return out
    size = 1
    while size < 32:
        h = join(h, h, size, size)
        size *= 2
        if size == 2:
            two = h
    h = join(h, two, 32, 2)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _running(x: np.ndarray, how, ahead: bool) -> np.ndarray:
    """Least or largest of SPAN values from each place on (ahead) or up to it."""
    x, size = x.copy(), 1
    while size < SPAN:
        step = min(size, SPAN - size)
        if ahead:
            x[:-step] = how(x[:-step], x[step:])
        else:
            x[step:] = how(x[step:], x[:-step].copy())
        size += step
    return x


class Slab:
    """The documents of a slab: bytes in a row, ids, and anchors."""

    def __init__(self, ids: list[int | None], texts: list[str | None]):
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        self.ids = np.array([LAST_ID if i is None else i for i in ids], np.int64)
        self.stops = np.cumsum([len(r) for r in raw], dtype=np.int64)
        self.starts = self.stops - np.array([len(r) for r in raw], np.int64)
        self.bytes = np.frombuffer(b"".join(raw), np.uint8)
        places, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for lo in range(0, len(self.bytes), BLOCK_BYTES):
            at, key = self._block(lo, min(lo + BLOCK_BYTES, len(self.bytes)))
            places.append(at)
            keys.append(key)
        self.at, self.key = np.concatenate(places), np.concatenate(keys)
        self.doc = np.searchsorted(self.stops, self.at, "right")

    def _block(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """Anchors from lo to hi and the 48-bit hashes of their grams."""
        a, b = max(0, lo - 2 * WINDOW), min(len(self.bytes), hi + 2 * WINDOW)
        if b - a < WINDOW:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        docs = np.arange(np.searchsorted(self.stops, a, "right"), np.searchsorted(self.stops, b - 1, "right") + 1)
        sizes = np.minimum(self.stops[docs], b) - np.maximum(self.starts[docs], a)
        left = np.repeat(self.stops[docs], sizes) - np.arange(a, b)  # bytes from here to the document's end
        h = gram_hashes(self.bytes[a:b])
        top = (h >> np.uint64(32)).astype(np.uint32)  # chooses; the lower bits stay even and deal out
        left[len(left) - GRAM + 1:] = 0
        top[left < GRAM] = (1 << 32) - 1
        least = _running(top, np.minimum, True)  # of each window
        least[left < WINDOW] = 0
        least[len(least) - WINDOW + 1:] = 0
        chosen = (_running(least, np.maximum, False) == top) & (left >= GRAM)
        chosen[:lo - a] = False
        chosen[hi - a:] = False
        at = np.flatnonzero(chosen)
        return at + a, h[at] & np.uint64((1 << 48) - 1)

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct gram hashes, and under how many ids each stands (255 at most)."""
        ids = self.ids[self.doc]
        order = np.lexsort((ids, self.key))
        key, ids = self.key[order], ids[order]
        first = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
        new = first.copy()
        new[1:] |= ids[1:] != ids[:-1]
        where = np.flatnonzero(first)
        return key[where], np.minimum(np.add.reduceat(new.astype(np.int64), where) if len(where) else new, 255).astype(np.uint8)

    def candidates(self, known: np.ndarray) -> None:
        """Suffixes of the anchors whose grams are among `known` (2 x hash + 1 if hot):
        `words` (sorted, distinct), `least` id of each; of each anchor (or window of a
        hot anchor) its place, document and suffix, in `place`, `owner`, `which`."""
        known = np.sort(known)
        slot = np.minimum(np.searchsorted(known >> np.uint64(1), self.key), max(len(known) - 1, 0))
        hit = known[slot] >> np.uint64(1) == self.key if len(known) else np.zeros(len(self.key), bool)
        hot = hit & (known[slot] & np.uint64(1) == 1) if len(known) else hit
        at, doc, hot = self.at[hit], self.doc[hit], hot[hit]
        before, after = at - self.starts[doc], self.stops[doc] - at
        low, high = np.maximum(0, WINDOW - after), np.minimum(LEFT, before)  # bytes before the anchor that a window may have
        # hot anchors: each window by itself
        each = np.flatnonzero(hot)
        count = np.maximum(high[each] - low[each] + 1, 0)
        many = np.repeat(each, count)
        inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        single = at[many] - (low[many] + inner)
        cold = np.flatnonzero(~hot & (low <= high))
        self.place = np.concatenate([at[cold], single])
        self.owner = np.concatenate([doc[cold], doc[many]])
        self.low = np.concatenate([low[cold], np.zeros(len(single), np.int64)])
        self.high = np.concatenate([high[cold], np.zeros(len(single), np.int64)])
        is_hot = np.concatenate([np.zeros(len(cold), bool), np.ones(len(single), bool)])
        m = len(self.place)
        text = np.zeros((m, 8 * WORDS), np.uint8)
        padded = np.concatenate([np.zeros(LEFT, np.uint8), self.bytes, np.zeros(WINDOW, np.uint8)])
        view = np.lib.stride_tricks.sliding_window_view(padded, LEFT + WINDOW)
        for a in range(0, m, 1 << 14):
            b = min(m, a + (1 << 14))
            rows = view[self.place[a:b]]
            text[a:b, :WINDOW] = rows[:, LEFT:]
            text[a:b, WINDOW:WINDOW + LEFT] = rows[:, :LEFT]
        column = np.arange(8 * WORDS)
        after = self.stops[self.owner] - self.place
        text[(column[None, :] >= after[:, None]) & (column < WINDOW)] = 0  # beyond the document
        before = np.where(is_hot, 0, self.place - self.starts[self.owner])
        text[(column[None, :] < WINDOW + LEFT - before[:, None]) & (column >= WINDOW) & (column < WINDOW + LEFT)] = 0
        text[:, WINDOW + LEFT], text[:, WINDOW + LEFT + 1] = self.low, self.high
        words = text.view(">u8").astype(np.uint64)
        order, group = multikey_order(words)
        self.which = np.empty(m, np.int64)
        self.which[order] = group
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if m else np.zeros(0, np.int64)
        self.words, self.hot = words[order[first]], is_hot[order[first]]
        self.least = np.minimum.reduceat(self.ids[self.owner[order]], first) if m else np.zeros(0, np.int64)

    def covered(self, bits: np.ndarray) -> np.ndarray:
        """Whether each byte goes, given the bits of each suffix's windows (bit k: with
        k bytes before the anchor) for its least id."""
        k = np.arange(SPAN)
        own = (bits[self.which, None] >> k) & 1 != 0
        own |= (self.ids[self.owner] > self.least[self.which])[:, None]
        own &= (k >= self.low[:, None]) & (k <= self.high[:, None])
        row, back = np.nonzero(own)
        begin = self.place[row] - back
        change = np.bincount(begin, minlength=len(self.bytes) + 1) - np.bincount(begin + WINDOW, minlength=len(self.bytes) + 1)
        return np.cumsum(change[:len(self.bytes)]) > 0


def multikey_order(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows of words, and the number of each row's class of equal rows in
    that order: rows are sorted by one word, and only those still tied by the next."""
    n = len(words)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(words[:, 0], kind="stable")
    first = words[order, 0]
    new = np.concatenate([[True], first[1:] != first[:-1]])
    for k in range(1, words.shape[1]):
        tied = ~new
        tied[:-1] |= ~new[1:]
        tied = np.flatnonzero(tied)
        if not len(tied):
            break
        group = np.cumsum(new)[tied]
        rows = order[tied]
        inner = np.lexsort((words[rows, k], group))
        rows = rows[inner]
        order[tied] = rows
        value = words[rows, k]
        change = np.concatenate([[True], (value[1:] != value[:-1]) | (group[1:] != group[:-1])])
        new[tied] = change | new[tied]
    return order, np.cumsum(new) - 1


def window_bits(words: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Of each suffix of a bucket, a bit for each of its windows that a smaller id has."""
    order, group = multikey_order(words)
    n = len(order)
    if not n:
        return np.zeros(0, np.uint32)
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    reps, least = words[order[first]], np.minimum.reduceat(ids[order], first)
    # classes of one gram: neighbours in suffix order that share their first GRAM bytes
    full, part = divmod(GRAM, 8)
    cut = np.uint64(8 * (8 - part))
    same = (reps[1:, :full] == reps[:-1, :full]).all(1) & (reps[1:, full] >> cut == reps[:-1, full] >> cut)
    gram = np.cumsum(np.concatenate([[True], ~same])) - 1
    many = np.flatnonzero(np.bincount(gram)[gram] > 1)
    bits = np.zeros(len(first), np.uint32)
    if len(many):
        text = reps[many].astype(">u8").view(np.uint8).reshape(len(many), 8 * WORDS)
        around = np.concatenate([text[:, WINDOW:WINDOW + LEFT], text[:, GRAM:WINDOW]], 1)  # before and behind the gram
        low, high = text[:, WINDOW + LEFT], text[:, WINDOW + LEFT + 1]
        for k in range(SPAN):
            fits = np.flatnonzero((low <= k) & (k <= high))
            if not len(fits):
                continue
            pair = np.ascontiguousarray(around[fits, LEFT - k:2 * LEFT - k]).view(">u8").astype(np.uint64)
            g, mine = gram[many[fits]], least[many[fits]]
            by = np.lexsort((pair[:, 1], pair[:, 0], g))
            p, g = pair[by], g[by]
            start = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (p[1:] != p[:-1]).any(1)]))
            smallest = np.repeat(np.minimum.reduceat(mine[by], start), np.diff(np.append(start, len(by))))
            bits[many[fits[by]]] |= np.where(smallest < mine[by], np.uint32(1 << k), np.uint32(0))
    out = np.empty(n, np.uint32)
    # a suffix that a smaller id has as a whole has all its windows there
    out[order] = np.where(ids[order] > least[group], np.uint32((1 << SPAN) - 1), bits[group])
    return out


# ------------------------------------------------------------------ coding

def to_planes(values: np.ndarray) -> bytes:
    """Sorted unsigned numbers as the byte planes of their differences (high planes are
    all but empty, so any compression removes them)."""
    steps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def from_planes(raw: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<u8").reshape(-1), dtype=np.uint64)


def squeezed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def spread(raw: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), kind)


def _slab(table: pa.Table) -> Slab:
    return Slab(table.column("id").to_pylist(), table.column("text").to_pylist())


def _cut(values: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(part, places) of each part from 0 to n - 1 that has values."""
    order = np.argsort(values, kind="stable")
    edges = np.searchsorted(values[order], np.arange(n + 1))
    for part in np.flatnonzero(np.diff(edges)).tolist():
        yield part, order[edges[part]:edges[part + 1]]


# ------------------------------------------------------------------ Spark jobs

def slab_table(docs: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """(slab, doc, id, text), bucketed by slab into n files' worth."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for piece in slices(batches, "text", SLAB_BYTES):
            slab = pa.array(np.full(piece.num_rows, part << 32 | number), pa.int64())
            yield pa.RecordBatch.from_arrays([slab, *piece.columns], ["slab", *piece.schema.names])
            number += 1
    path, name = work_dir(spark, "suffix-slabs"), f"suffix_slabs_{uuid.uuid4().hex[:12]}"
    rows.mapInArrow(run, f"slab long, doc {kind}, id long, text string").write.bucketBy(n, "slab").option("path", path).option("compression", "zstd").saveAsTable(name)
    return spark.table(name)


def splitters(slabs: DataFrame, n: int) -> np.ndarray:
    """n - 1 sorted borders of leading seven bytes, from one place of each text (repeated
    where one value fills several ranges)."""
    raw, size = F.col("text").cast("binary"), F.octet_length("text")
    at = F.pmod(F.xxhash64("id", "text"), size - 7 + 1) + 1
    head = F.conv(F.hex(F.substring(raw, at.cast("int"), F.lit(7))), 16, 10).cast("long")
    cuts = ", ".join(f"{i / n:.9f}D" for i in range(1, n))
    if n < 2:
        return np.zeros(0, np.uint64)
    found = slabs.filter(size >= 7).select(head.alias("head")).select(F.expr(f"percentile_approx(head, array({cuts}), {20 * n})").alias("b")).first()["b"]
    return np.array(found or [], np.uint64)


def bucket_numbers(words: np.ndarray, hot: np.ndarray, cuts: np.ndarray, n: int) -> np.ndarray:
    """Range of each suffix by its leading bytes; a value that fills several ranges is
    dealt out by its gram, and hot windows by their hash."""
    head = words[:, 0] >> np.uint64(8)
    low, high = np.searchsorted(cuts, head, "left"), np.searchsorted(cuts, head, "right")
    full, part = divmod(GRAM, 8)
    mix = np.zeros(len(words), np.uint64)
    for k in range(full):
        mix = (mix ^ words[:, k]) * np.uint64(_STEP)
        mix ^= mix >> np.uint64(31)
    gram = (mix ^ words[:, full] >> np.uint64(8 * (8 - part))) * np.uint64(_STEP)
    whole = gram
    for k in range(full, 7):
        whole = (whole ^ words[:, k]) * np.uint64(_STEP)
        whole ^= whole >> np.uint64(31)
    ranged = low + (gram >> np.uint64(33)).astype(np.int64) % (high - low + 1)
    return np.where(hot, (whole >> np.uint64(33)).astype(np.int64) % n, ranged)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """Per row of `docs`: id, n_bytes, spans (start, end of the removed runs) and kept
    (the bytes that stay)."""
    spark = docs.sparkSession
    python_ready(spark)
    n = PARTS * shuffle_partitions(spark)
    slabs = slab_table(docs, id_col, text_col, shuffle_partitions(spark))
    cuts = splitters(slabs, n)

    def send_grams(table: pa.Table) -> pa.Table:
        grams, ids = _slab(table).grams()
        slab = table.column("slab")[0].as_py()
        parts = list(_cut(((grams >> np.uint64(16)) * np.uint64(n) >> np.uint64(32)).astype(np.int64), n))
        return pa.table({"part": pa.array([p for p, _ in parts], pa.int32()), "slab": pa.array([slab] * len(parts), pa.int64()),
                         "grams": pa.array([to_planes(grams[at]) for _, at in parts], pa.binary()),
                         "ids": pa.array([ids[at].tobytes() for _, at in parts], pa.binary())})

    def repeated(table: pa.Table) -> pa.Table:
        """Of each slab, its grams that stand under two ids or more (2 x hash + 1 if hot)."""
        grams = [from_planes(x) for x in table.column("grams").to_pylist()]
        row = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        key, ids = np.concatenate(grams), np.frombuffer(b"".join(table.column("ids").to_pylist()), np.uint8).astype(np.int64)
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
        size = np.diff(np.append(first, len(key)))
        total = np.repeat(np.add.reduceat(ids[order], first), size)
        keep = total > 1
        answer = key[order][keep] << np.uint64(1) | (total[keep] >= hot).astype(np.uint64)
        parts = list(_cut(row[order][keep], len(grams)))
        slab = table.column("slab").to_pylist()
        return pa.table({"slab": pa.array([slab[r] for r, _ in parts], pa.int64()),
                         "known": pa.array([to_planes(answer[at]) for _, at in parts], pa.binary())})
    sent = slabs.groupBy("slab").applyInArrow(send_grams, "part int, slab long, grams binary, ids binary")
    known = written(sent.groupBy("part").applyInArrow(repeated, "slab long, known binary"), "suffix-grams")

    def with_candidates(table: pa.Table, answers: pa.Table) -> Slab:
        slab = _slab(table)
        slab.candidates(np.concatenate([np.zeros(0, np.uint64), *[from_planes(x) for x in answers.column("known").to_pylist()]]))
        return slab

    def send_suffixes(table: pa.Table, answers: pa.Table) -> pa.Table:
        slab, number = with_candidates(table, answers), table.column("slab")[0].as_py()
        parts = list(_cut(bucket_numbers(slab.words, slab.hot, cuts, n), n))
        return pa.table({"part": pa.array([p for p, _ in parts], pa.int32()), "slab": pa.array([number] * len(parts), pa.int64()),
                         "words": pa.array([squeezed(slab.words[at].astype(">u8")) for _, at in parts], pa.binary()),
                         "least": pa.array([squeezed(slab.least[at]) for _, at in parts], pa.binary()),
                         "at": pa.array([to_planes(at.astype(np.uint64)) for _, at in parts], pa.binary())})

    def compare(table: pa.Table) -> pa.Table:
        words = np.concatenate([spread(x, ">u8").astype(np.uint64) for x in table.column("words").to_pylist()]).reshape(-1, WORDS)
        ids = [spread(x, np.int64) for x in table.column("least").to_pylist()]
        bits = window_bits(words, np.concatenate(ids))
        edges = np.cumsum([0] + [len(x) for x in ids])
        return pa.table({"slab": table.column("slab"), "at": table.column("at"),
                         "bits": pa.array([squeezed(bits[a:b]) for a, b in zip(edges, edges[1:], strict=False)], pa.binary())})
    suffixes = slabs.groupBy("slab").cogroup(known.groupBy("slab")).applyInArrow(
        send_suffixes, "part int, slab long, words binary, least binary, at binary")
    bits = suffixes.groupBy("part").applyInArrow(compare, "slab long, at binary, bits binary")
    kind = slabs.schema["doc"].dataType.simpleString()
    answers = written(known.select("slab", "known", F.lit(None).cast("binary").alias("at"), F.lit(None).cast("binary").alias("bits"))
                           .unionByName(bits.withColumn("known", F.lit(None).cast("binary"))), "suffix-bits")
    schema = f"{id_col} {kind}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def remove(table: pa.Table, answers: pa.Table) -> pa.Table:
        known = answers.filter(pc.is_valid(answers.column("known")))
        found = answers.filter(pc.is_valid(answers.column("bits")))
        slab = with_candidates(table, known)
        bits = np.zeros(len(slab.words), np.uint32)
        for at, b in zip(found.column("at").to_pylist(), found.column("bits").to_pylist(), strict=True):
            bits[from_planes(at).astype(np.int64)] = spread(b, np.uint32)
        gone = slab.covered(bits)
        spans, kept = [], []
        for a, b in zip(slab.starts.tolist(), slab.stops.tolist(), strict=True):
            out = gone[a:b]
            if out.any():
                edges = np.flatnonzero(np.diff(np.concatenate([[0], out.view(np.int8), [0]])))
                spans.append([{"start": s, "end": e} for s, e in edges.reshape(-1, 2).tolist()])
                kept.append(slab.bytes[a:b][~out].tobytes())
            else:
                spans.append([])
                kept.append(slab.bytes[a:b].tobytes())
        return pa.table({id_col: table.column("doc"), "n_bytes": pa.array(slab.stops - slab.starts), "spans": pa.array(spans, pa.list_(span)),
                         "kept": pa.array(kept, pa.binary())})
    return slabs.groupBy("slab").cogroup(answers.groupBy("slab")).applyInArrow(remove, schema)
