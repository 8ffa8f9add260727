"""N-gram Jaccard join (operator 5) with token-combination prefixes.

Documents link when inter / union of their shingle sets is num / den or more.
Equal sets are one class first, so exact copies are never paired. Shingles are
ordered: rare ones by hash, then the frequent ones by ascending frequency.

Prefix rule. A partner lacks at most e = n - ceil(n num / den) of a set's n
shingles. Rare shingles are a class each of their own: one of them makes a
signature. Frequent shingles fall into C classes by hash, and a pair of them in
one class makes a signature. A prefix is extended until its rare shingles plus,
over the classes, its shingles beyond the first come to e + 1; then, of two
linked sets, that whose prefix ends first shares with the other one signature at
least, whatever shingles it lacks. C follows the set's size (a power of two,
CLASS_SHARE sizes to a class) so that the signatures stay about linear in the
size; sets near a border of sizes use both neighbours' C, as linked sets differ in
size by num / den at most. A set too small for a prefix of e + 1 (one or two
frequent shingles at 0.5) has each of them as a signature too. Sets with e = 0
lose nothing, but a larger set may hold them: only where no larger one can link
either (n den / num below n + 1) are they without signatures.

Frequent shingles are those in FREQUENT sets or more. Tasks sort the shingles of
many sets by hash range into packed arrays, one task per range counts them, and at
most MAX_FREQUENT of them (the most frequent) are broadcast. They decide the order
and the signatures, never the result.

Candidates. Classes that share a signature are candidates, and two sets with only
rare shingles in their prefixes must share as many of these as the overlap bound
asks. First, the classes of a bucket meet only its centres (its smallest classes
by a few hashes); then the components of the links found are followed, and only
candidates in different components meet. In the first round a class takes only
the NEAR centres with which it shares most signatures. So a group of thousands of
near copies costs few pairs, while every candidate pair that could join two components is
verified. Verification is exact, on the sets of 64-bit shingle hashes, pair by
pair. Components come from rounds of smallest-neighbour labels with pointer
jumps, as joins.

Defined cases: null, empty and blank texts have the empty set and link with
nothing; fewer words than a shingle make the whole sequence the only shingle;
texts of any length are read whole; repeated rows are one class; a null id takes
no part in the smallest id (a class of null ids only has a null component); an
empty table gives an empty result; only the id and text columns are read, so any
other column may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quadrant.llm.common import batches_of, lean, most_frequent, python_ready, shuffle_partitions, slices, written
from quadrant.llm.language import mixed

FREQUENT = 8
MAX_FREQUENT = 1 << 18
#: Hashes that a task packs together when shingles are counted.
WINDOW = 1 << 21
#: Text bytes of a slice; numpy's temporaries take some 50 times as much.
SLICE_BYTES = 1 << 20
CLASS_SHARE = 16
CENTRES, NEAR = 3, 4
#: Bits of the filter of wanted classes that is broadcast (1 MB).
FILTER_BITS = 1 << 23
_P = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased words of all texts, and where each text's begin."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = _LOWER[np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)]
    gap = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.diff(gap.astype(np.int8), prepend=1)
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    borders = np.searchsorted(starts, np.cumsum([0] + [len(r) + 1 for r in raw]))
    if not len(starts):
        return np.zeros(0, np.uint64), borders
    sizes = ends - starts
    total = np.concatenate([[0], np.cumsum(sizes)])
    place = np.arange(total[-1]) - np.repeat(total[:-1], sizes)
    chars = data[np.repeat(starts, sizes) + place].astype(np.uint64)
    return mixed(np.add.reduceat(mixed(chars + _P * (place.astype(np.uint64) + np.uint64(1))), total[:-1])), borders


def shingle_sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's n-word shingles."""
    found, count = [np.zeros(0, np.uint64)], np.zeros(len(texts), np.int64)
    for numbers, parts in batches_of(texts):
        words, borders = word_hashes(parts)
        found.append(words)
        np.add.at(count, numbers, np.diff(borders))
    words = np.concatenate(found)
    borders = np.concatenate([[0], np.cumsum(count)])
    factors = np.cumprod(np.full(n, _P, np.uint64))
    rolled = np.zeros(max(len(words) - n + 1, 0), np.uint64)
    for k in range(n):
        rolled += words[k:len(words) - n + 1 + k] * factors[k] if len(rolled) else rolled
    rolled = mixed(rolled)
    out = []
    for a, b in zip(borders.tolist(), borders[1:].tolist(), strict=False):
        if b - a >= n:
            out.append(np.unique(rolled[a:b - n + 1]))
        elif b > a:
            out.append(mixed((words[a:b] * factors[:b - a]).sum(keepdims=True) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def class_of(s: np.ndarray) -> int:
    """64-bit key of a set."""
    with np.errstate(over="ignore"):
        key = mixed(mixed(s ^ _P).sum(keepdims=True) + np.uint64(len(s)) * _P)
    return int(key.view(np.int64)[0])


def lacking(n: int, num: int, den: int) -> int:
    """Shingles of a set of n that a linked set may lack."""
    return n - -(-n * num // den)


def alone(n: int, num: int, den: int) -> bool:
    """Can a set of n shingles only link to equal sets: none smaller, none larger?"""
    return lacking(n, num, den) < 1 and n * den // num == n


def signatures(s: np.ndarray, order: np.ndarray, num: int, den: int) -> tuple[np.ndarray, int, bool]:
    """Signatures of a sorted set, how many of them (the first) are single rare
    shingles, and whether the prefix holds rare shingles only; `order` is the rank
    among the frequent shingles (0: rare)."""
    need = lacking(len(s), num, den) + 1
    rare = s[order == 0]
    if len(rare) >= need:
        return rare[:need], need, True
    frequent = s[order > 0][np.argsort(order[order > 0], kind="stable")]
    parts = [rare]
    n = len(s)
    with np.errstate(over="ignore"):
        for band in {n.bit_length() - 1, (n * den // num).bit_length() - 1}:
            c = max(1, (1 << band) // CLASS_SHARE)
            kind = (mixed(frequent) % np.uint64(c)).astype(np.int64)
            later = np.ones(len(frequent), bool)
            later[np.unique(kind, return_index=True)[1]] = False
            if later.sum() < need - len(rare):
                parts.append(frequent)
            stop = int(np.searchsorted(np.cumsum(later), need - len(rare))) + 1
            near = np.argsort(kind[:stop], kind="stable")
            token, kind = frequent[:stop][near], kind[:stop][near]
            for gap in range(1, len(token)):  # pairs of one class stand together
                same = kind[gap:] == kind[:-gap]
                if not same.any():
                    break
                a, b = token[gap:][same], token[:-gap][same]
                parts.append(mixed(mixed(np.minimum(a, b)) + np.maximum(a, b) * _P + np.uint64(band)))
    return np.concatenate(parts), len(rare), False


def _text(docs: DataFrame, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{text_col}`").alias("text"))


def classes(docs: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """id (a number or a string), size and class of every document."""
    kind = "string" if dict(docs.dtypes)[id_col] == "string" else "long"
    rows = docs.select(F.col(f"`{id_col}`").cast(kind).alias("id"), F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE_BYTES):
            sets = shingle_sets(part.column("text").to_pylist(), n)
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([len(s) for s in sets], pa.int64()),
                                              pa.array([class_of(s) for s in sets], pa.int64())], ["id", "size", "class"])
    return rows.mapInArrow(lean(run), f"id {kind}, size long, class long")


def key_shift(ranges: int) -> int:
    """Hashes are counted by their first bits: those of the range and 32 more."""
    return 32 - (ranges.bit_length() - 1)


def counted_shingles(docs: DataFrame, n: int, text_col: str, ranges: int) -> DataFrame:
    """key (first bits of a shingle's hash) and n of those in FREQUENT sets or more.
    `ranges` is a power of two; a range's packed hashes are counted in one task."""
    shift = np.uint64(key_shift(ranges))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(window: list[np.ndarray]) -> pa.RecordBatch:
            key, times = np.unique(np.concatenate(window) >> shift, return_counts=True)
            cut = np.searchsorted(key >> np.uint64(32), np.arange(ranges + 1, dtype=np.uint64))
            low, many = key.astype(np.uint32), times > 1
            parts = [(low[a:b][~many[a:b]], low[a:b][many[a:b]], times[a:b][many[a:b]].astype(np.uint32)) for a, b in zip(cut, cut[1:], strict=False)]
            return pa.RecordBatch.from_arrays([pa.array(np.arange(ranges, dtype=np.int32)), *[
                pa.array([p[k].tobytes() for p in parts], pa.binary()) for k in range(3)]], ["range", "once", "often", "times"])
        window, seen, held = [], set(), 0
        for part in slices(batches, "text", SLICE_BYTES):
            for s in shingle_sets(part.column("text").to_pylist(), n):
                if len(s) and (c := class_of(s)) not in seen:  # copies in a window count once
                    seen.add(c)
                    window.append(s)
                    held += len(s)
            if held > WINDOW:
                yield packed(window)
                window, seen, held = [], set(), 0
        if window:
            yield packed(window)

    def count(group: pa.Table) -> pa.Table:
        joined = {c: np.frombuffer(b"".join(group.column(c).to_pylist()), np.uint32) for c in ("once", "often", "times")}
        key = np.concatenate([joined["once"], joined["often"]])
        order = np.argsort(key, kind="stable")
        key, times = key[order], np.concatenate([np.ones(len(joined["once"]), np.int64), joined["times"].astype(np.int64)])[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        total = np.add.reduceat(times, first) if len(first) else times
        often = total >= FREQUENT
        base = int(group.column("range")[0].as_py()) << 32
        return pa.table({"key": pa.array(key[first][often].astype(np.int64) + base, pa.int64()), "n": pa.array(total[often], pa.int64())})
    made = _text(docs, text_col).mapInArrow(lean(run), "range int, once binary, often binary, times binary")
    return made.groupBy("range").applyInArrow(count, "key long, n long")


def signature_rows(docs: DataFrame, n: int, num: int, den: int, text_col: str, frequent) -> DataFrame:
    """Signatures of all texts whose set may link to another: sig, single (a rare
    shingle, not a pair), class, size, rare (only rare shingles in the prefix) and
    rest (shingles of the set that no single signature stands for)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ranks, shift = frequent.value
        for part in slices(batches, "text", SLICE_BYTES):
            sig, single, key, size, rare, rest = [], [], [], [], [], []
            done = set()  # copies in a slice give the same rows
            for s in shingle_sets(part.column("text").to_pylist(), n):
                if not len(s) or alone(len(s), num, den) or (c := class_of(s)) in done:
                    continue
                done.add(c)
                order = np.zeros(len(s), np.int64)
                if len(keys):
                    own = s >> shift
                    at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
                    order = np.where(keys[at] == own, ranks[at], 0)
                found, singles, only = signatures(s, order, num, den)
                sig.append(found)
                single.append(np.arange(len(found)) < singles)
                rest.append(np.full(len(found), len(s) - singles, np.int32))
                key.append(np.full(len(found), c, np.int64))
                size.append(np.full(len(found), len(s), np.int32))
                rare.append(np.full(len(found), only))
            if sig:
                columns = [np.concatenate(sig).view(np.int64), *map(np.concatenate, (single, key, size, rare, rest))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["sig", "single", "class", "size", "rare", "rest"])
    return _text(docs, text_col).mapInArrow(lean(run), "sig long, single boolean, class long, size int, rare boolean, rest int")


def sets_of(docs: DataFrame, n: int, text_col: str, wanted: DataFrame) -> DataFrame:
    """class and set (bytes of the sorted hashes) of the wanted(class) classes; a
    filter of fixed size is broadcast so that only their texts give rows."""
    bit = F.pmod("class", F.lit(FILTER_BITS)) + 1
    words = {r["w"]: bytes(r["bits"]) for r in wanted.groupBy(F.bitmap_bucket_number(bit).alias("w"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")).collect()}  # 256 rows of 4 kB at most
    step = 32768 // 8
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for w, b in words.items():
        bits[(w - 1) * step:w * step] = np.frombuffer(b, np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        allowed = shared.value
        for part in slices(batches, "text", SLICE_BYTES):
            found = {}
            for s in shingle_sets(part.column("text").to_pylist(), n):
                c = class_of(s)
                at = c % FILTER_BITS
                if allowed[at >> 3] >> (at & 7) & 1:
                    found[c] = s.tobytes()
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.binary())], ["class", "set"])
    rows = _text(docs, text_col).mapInArrow(lean(run), "class long, set binary")
    return rows.join(wanted, "class", "left_semi").groupBy("class").agg(F.first("set").alias("set"))


def verified(pairs: DataFrame, docs: DataFrame, n: int, num: int, den: int, text_col: str) -> DataFrame:
    """The pairs(a, b) whose sets link."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    sets = written(sets_of(docs, n, text_col, wanted), "jaccard-sets")
    both = (pairs.join(sets.select(F.col("class").alias("a"), F.col("set").alias("x")), "a")
                 .join(sets.select(F.col("class").alias("b"), F.col("set").alias("y")), "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                merged = np.sort(np.concatenate([x, y]), kind="stable")
                inter = int((merged[1:] == merged[:-1]).sum())
                keep.append(den * inter >= num * (len(x) + len(y) - inter))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return both.select("a", "b", "x", "y").mapInArrow(lean(run), "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """links(a, b) -> class, root: the smallest class of its component."""
    edges = written(links.select("a", "b").union(links.select("b", "a")).toDF("a", "b").distinct(), "jaccard-edges")
    labels = written(edges.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("root")), "jaccard-labels")
    while True:
        near = edges.join(labels.select(F.col("a").alias("b"), F.col("root").alias("r")), "b").groupBy("a").agg(F.min("r").alias("r"))
        step = labels.join(near, "a").select("a", "root", F.least("root", "r").alias("low"))
        jump = labels.select(F.col("a").alias("low"), F.col("root").alias("far"))
        step = written(step.join(jump, "low").select("a", F.col("root").alias("old"), F.least("low", "far").alias("root")), "jaccard-labels")
        labels = step.select("a", "root")
        if step.filter(F.col("old") != F.col("root")).isEmpty():
            return labels.withColumnRenamed("a", "class")


def bounds(num: int, den: int):
    """Can a pair of rows (a, b) still link? By size; by what no single signature
    stands for (without any shared single one); with `shared` of these.

    Of a set with frequent shingles in its prefix all rare ones are single
    signatures, so two such sets share `shared` rare shingles and the smaller rest
    at most; a set with a rare prefix shares what lies in its prefix and its rest
    at most; of two such sets, that whose prefix ends first does."""
    small, large = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    wanted = F.ceil((F.col("size_a") + F.col("size_b")) * F.lit(num) / F.lit(num + den) - 1e-9)
    a, b = F.col("rest_a"), F.col("rest_b")
    rest = F.when(F.col("rare_a") & F.col("rare_b"), F.greatest(a, b)).when(F.col("rare_a"), a).when(F.col("rare_b"), b).otherwise(F.least(a, b))
    return small * den >= large * num, rest >= wanted, F.col("shared") + rest >= wanted


def link_components(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles and component_id (smallest id reachable over links) of every
    row of `docs`."""
    if 2 * num < den or num > den:
        raise ValueError("a similarity from 0.5 to 1 is wanted")
    spark = docs.sparkSession
    python_ready(spark)
    members = written(classes(docs, n, id_col, text_col), "jaccard-classes")
    ranges = 1 << (shuffle_partitions(spark) - 1).bit_length()
    top = most_frequent(counted_shingles(docs, n, text_col, ranges), "key", MAX_FREQUENT)
    keys, times = np.array([r["key"] for r in top], np.uint64), np.array([r["n"] for r in top], np.int64)
    ranks = np.empty(len(top), np.int64)
    ranks[np.lexsort((keys, times))] = np.arange(1, len(top) + 1)  # ascending frequency
    by_key = np.argsort(keys)
    frequent = spark.sparkContext.broadcast((keys[by_key], ranks[by_key], np.uint64(key_shift(ranges))))
    sigs = written(signature_rows(docs, n, num, den, text_col, frequent), "jaccard-signatures")
    several = sigs.groupBy("sig").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).filter(F.col("lo") != F.col("hi")).select("sig")
    buckets = written(sigs.join(several, "sig").groupBy("sig", "class").agg(
        *[F.first(c).alias(c) for c in ("single", "size", "rare", "rest")]), "jaccard-buckets")
    by_size, without, by_count = bounds(num, den)
    of_class = ("size", "rare", "rest")

    def met(left: DataFrame, right: DataFrame, cond) -> DataFrame:
        """Pairs (class_a, class_b) that share signatures and may link. A shared pair
        of frequent shingles says nothing about rare ones, so it makes a candidate
        only where none need be shared; all others meet in a single signature."""
        a = left.select("sig", "single", *[F.col(c).alias(f"{c}_a") for c in left.columns if c not in ("sig", "single")])
        b = right.select("sig", *[F.col(c).alias(f"{c}_b") for c in right.columns if c not in ("sig", "single")])
        return (a.join(b, "sig").filter(cond & by_size & (F.col("single") | without)).groupBy("class_a", "class_b")
                 .agg(F.count_if("single").alias("shared"), *[F.first(f"{c}_{x}").alias(f"{c}_{x}") for c in of_class for x in "ab"])
                 .filter(by_count))
    ordered = [F.least("class_a", "class_b").alias("a"), F.greatest("class_a", "class_b").alias("b")]
    # first round: the classes of a bucket meet its centres: that with most frequent
    # shingles (nearest to what a group of near copies has in common), and two by hash
    keys_of = [-F.col("rest") / F.col("size"), *[F.lit(0.0)] * (CENTRES - 1)]
    centre = [F.min_by(F.struct("class", *of_class), F.struct(k, F.xxhash64(F.lit(i), "class"))).alias(f"c{i}") for i, k in enumerate(keys_of)]
    centres = buckets.groupBy("sig").agg(*centre).select("sig", F.explode(F.array_distinct(F.array(*[f"c{i}" for i in range(CENTRES)]))).alias("c")).select("sig", "c.*")
    best = F.row_number().over(Window.partitionBy("class_a").orderBy(F.desc(F.col("rest_b") / F.col("size_b")), F.desc("shared"), F.xxhash64("class_b")))
    one = met(buckets, centres, F.col("class_a") != F.col("class_b")).withColumn("i", best).filter(F.col("i") <= NEAR)
    one = written(one.select(*ordered).distinct(), "jaccard-pairs")
    links = written(verified(one, docs, n, num, den, text_col), "jaccard-links")
    roots = components(links)
    # second round: what is still apart
    apart = buckets.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    mixed_sigs = apart.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter(F.col("lo") != F.col("hi")).select("sig")
    apart = written(apart.join(mixed_sigs, "sig", "left_semi").select("sig", "single", "class", *of_class, "root"), "jaccard-apart")
    two = met(apart, apart, (F.col("class_a") < F.col("class_b")) & (F.col("root_a") != F.col("root_b"))).select(*ordered)
    two = written(two.join(one, ["a", "b"], "left_anti"), "jaccard-pairs")
    if not two.isEmpty():
        more = written(verified(two, docs, n, num, den, text_col), "jaccard-links")
        if not more.isEmpty():
            roots = components(links.unionByName(more))
    smallest = members.filter("size > 0").groupBy("class").agg(F.min("id").alias("id")).join(roots, "class", "left")
    smallest = written(smallest.select("class", F.coalesce("root", "class").alias("root"), "id"), "jaccard-smallest")
    named = smallest.join(smallest.groupBy("root").agg(F.min("id").alias("component_id")), "root").select("class", "component_id")
    out = members.join(named, "class", "left")
    return out.select(F.col("id").alias(id_col), F.col("size").alias("n_shingles"),
                      F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
