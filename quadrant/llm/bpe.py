"""BPE encoding and decoding (operator 9) with a minimal acyclic transducer lexicon.

The frequent words of the corpus (counted over all documents, `max_words` at
most) are compiled into one shared-suffix automaton whose arcs carry
additive outputs; the sum of a word's outputs is its number, which points at its
token ids. The automaton is one file of flat arrays (its arcs in a double array, so
that it grows with the arcs and not with the alphabet) that Spark ships to the
executors and the workers memory-map. All words of a slice of texts walk it
together, one character a step; words that it doesn't hold are merged exactly, by
rank and then from the left, many words side by side, and remembered in a bounded
table.

The lexicon changes speed only: the ids are the same with any lexicon.

The vocabulary is a tokenizer file of the kind "BPE with word ends, lower case,
white space dropped"; its path is a parameter and Spark ships it to the workers.

Defined cases: null and empty texts and texts of white space have no ids and
decode to the empty text; special tokens' strings in a text become their ids;
a text or word of any length is encoded whole (long words through a heap, so the
work doesn't grow with the square of the length); an unknown id decodes to
nothing, as in the library; repeated rows give repeated results; an empty table
gives an empty result; only the id and text columns are read, so any other
column may have any name.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quadrant.llm.common import batches_of, lean, most_frequent, python_ready, slices
from quadrant.llm.segments import SPECIAL_CP, distinct_words, segment
from quadrant.session import work_dir

#: Words in the lexicon at most: its file and the rows the driver gets are bounded.
MAX_WORDS = 1 << 16
#: Longer words are not put in the lexicon.
MAX_LENGTH = 40
#: Words beside the lexicon that a worker remembers.
MEMORY = 200_000
END = "</w>"
#: Words of more bytes are merged one by one, through a heap.
LONG = 64


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return [chr(b) if b in set(plain) else chr(256 + rest.index(b)) for b in range(256)]


class Vocabulary:
    """Tokens, merges and special tokens of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") != END:
            raise ValueError(f"{path}: a BPE vocabulary with word ends ({END}) is wanted")
        self.ids: dict[str, int] = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks: dict[tuple[str, str], int] = {p: i for i, p in enumerate(pairs)}
        self.specials: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens: dict[int, str] = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.specials.items()}
        self.letters = byte_letters()
        # merges as sorted keys of id pairs, for many words at once
        self.width = max(self.tokens) + 1
        self.inner = np.array([self.ids[c] for c in self.letters], np.int64)
        self.last = np.array([self.ids[c + END] for c in self.letters], np.int64)
        keys = np.array([self.ids[a] * self.width + self.ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.pair_keys, self.pair_ranks = keys[order], order
        self.pair_ids = np.array([self.ids[a + b] for a, b in pairs], np.int64)[order]

    def symbols(self, word: str) -> list[str]:
        out = [self.letters[b] for b in word.encode("utf-8", "surrogatepass")]
        out[-1] += END
        return out

    def merge(self, word: str) -> list[int]:
        """Ids of one word: the pair of lowest rank merges first, the leftmost of equals."""
        symbols = self.symbols(word)
        return [self.ids[s] for s in self._merge_heap(symbols)]

    def merge_all(self, words: list[str]) -> list[list[int]]:
        """Ids of many words, merged side by side: each round merges one pair in
        each word that still has one."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        out: list = [(None if len(r) <= LONG else self.merge(w)) if r else [] for w, r in zip(words, raw, strict=True)]
        short = np.array([i for i, x in enumerate(out) if x is None], np.int64)
        if not len(short):
            return out
        sizes = np.array([len(raw[i]) for i in short.tolist()], np.int64)
        data = np.frombuffer(b"".join(raw[i] for i in short.tolist()), np.uint8)
        sym, word = self.inner[data], np.repeat(np.arange(len(short)), sizes)
        stop = np.cumsum(sizes) - 1
        sym[stop] = self.last[data[stop]]
        none = len(self.pair_keys)
        while len(sym):
            key = sym[:-1] * self.width + sym[1:]
            at = np.minimum(np.searchsorted(self.pair_keys, key), none - 1)
            rank = np.full(len(sym), none, np.int64)
            rank[:-1] = np.where((self.pair_keys[at] == key) & (word[:-1] == word[1:]), self.pair_ranks[at], none)
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            lengths = np.diff(np.append(starts, len(sym)))
            best = np.minimum.reduceat(rank, starts)
            done = best == none
            for i, a, n in zip(short[word[starts[done]]].tolist(), starts[done].tolist(), lengths[done].tolist(), strict=True):
                out[i] = sym[a:a + n].tolist()
            hit = np.flatnonzero((rank == np.repeat(best, lengths)) & (rank < none))
            hit = hit[np.concatenate([[True], word[hit][1:] != word[hit][:-1]])] if len(hit) else hit  # the leftmost
            sym[hit] = self.pair_ids[at[hit]]
            stays = ~np.repeat(done, lengths)
            stays[hit + 1] = False
            sym, word = sym[stays], word[stays]
        return out

    def _merge_heap(self, symbols: list[str]) -> list[str]:
        n = len(symbols)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list[tuple[int, int, str, str]] = []

        def offer(i: int) -> None:
            if i >= 0 and right[i] < n and (rank := self.ranks.get((symbols[i], symbols[right[i]]))) is not None:
                heapq.heappush(heap, (rank, i, symbols[i], symbols[right[i]]))
        for i in range(n - 1):
            offer(i)
        gone = bytearray(n)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i]
            if gone[i] or j >= n or symbols[i] != a or symbols[j] != b:
                continue
            symbols[i], gone[j] = a + b, 1
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
            offer(left[i])
            offer(i)
        return [s for s, x in zip(symbols, gone, strict=True) if not x]


def minimal_automaton(words: list[str]) -> tuple[list[dict[str, int]], list[bool]]:
    """Arcs and final flags of the minimal acyclic automaton of sorted, distinct
    words; state 0 is the root. States with equal futures are made one while the
    words are added (only the last word's path is open)."""
    arcs: list[dict[str, int]] = [{}]
    final = [False]
    register: dict[tuple, int] = {}
    path: list[tuple[int, str, int]] = []  # open states: parent, character, child
    free: list[int] = []
    last = ""

    def close(depth: int) -> None:
        while len(path) > depth:
            parent, c, child = path.pop()
            key = (final[child], tuple(arcs[child].items()))
            known = register.setdefault(key, child)
            if known != child:
                arcs[parent][c] = known
                free.append(child)
    for word in words:
        same = len(os.path.commonprefix([word, last]))
        close(same)
        at = path[-1][2] if path else 0
        for c in word[same:]:
            if free:
                new = free.pop()
                arcs[new], final[new] = {}, False
            else:
                new = len(arcs)
                arcs.append({})
                final.append(False)
            arcs[at][c] = new
            path.append((at, c, new))
            at = new
        final[at] = True
        last = word
    close(0)
    return arcs, final


def double_array(arcs: list[dict[int, tuple[int, int]]]) -> dict[str, np.ndarray]:
    """Arcs {symbol: (target, output)} of each state as a double array: the arc of a
    state and symbol stands at `base[state] + symbol` if `check` there is the state."""
    base, check, go, add = np.zeros(len(arcs), np.int32), [-1], [0], [0]
    free = near = 1  # no slot below `free` is free; states of several arcs are tried from `near` on
    for state in sorted(range(len(arcs)), key=lambda s: -len(arcs[s])):
        symbols = sorted(arcs[state])
        if not symbols:
            continue
        while free < len(check) and check[free] >= 0:
            free += 1
        at = free if len(symbols) == 1 else max(near, free)
        tried = 0
        while any(at + c - symbols[0] < len(check) and check[at + c - symbols[0]] >= 0 for c in symbols):
            at, tried = at + 1, tried + 1
        if tried > 50:  # too full below: what is left there is for states of one arc
            near = at
        base[state] = at - symbols[0]
        short = at + symbols[-1] - symbols[0] + 1 - len(check)
        if short > 0:
            check += [-1] * short
            go += [0] * short
            add += [0] * short
        for c in symbols:
            check[base[state] + c] = state
            go[base[state] + c], add[base[state] + c] = arcs[state][c]
    return {"base": base, "check": np.array(check, np.int32), "go": np.array(go, np.int32), "add": np.array(add, np.int32)}


def compile_lexicon(words: list[str], vocabulary: Vocabulary) -> dict[str, np.ndarray]:
    """Flat arrays of the transducer: `alphabet` (sorted code points), the double array of
    its arcs, `final`, and the ids of word number i at `ids[start[i]:start[i + 1]]`."""
    words = sorted(set(words))
    arcs, final = minimal_automaton(words)
    order, number = [0], {0: 0}
    for state in order:  # renumber what can be reached
        for t in arcs[state].values():
            if t not in number:
                number[t] = len(order)
                order.append(t)
    count: dict[int, int] = {}

    stack = [0]
    while stack:  # words that each state accepts, deepest first
        s = stack[-1]
        wait = [t for t in arcs[s].values() if t not in count]
        if wait:
            stack += wait
        else:
            count[s] = final[s] + sum(count[t] for t in arcs[s].values())
            stack.pop()
    alphabet = sorted({c for w in words for c in w})
    symbol = {c: i + 1 for i, c in enumerate(alphabet)}
    numbered: list[dict[int, tuple[int, int]]] = []
    for s in order:
        before, out = int(final[s]), {}
        for c, t in sorted(arcs[s].items()):
            out[symbol[c]] = (number[t], before)
            before += count[t]
        numbered.append(out)
    ids = vocabulary.merge_all(words)
    return {"alphabet": np.array([ord(c) for c in alphabet], np.uint32), **double_array(numbered),
            "final": np.array([final[s] for s in order], np.uint8),
            "start": np.cumsum([0] + [len(x) for x in ids]).astype(np.int32),
            "ids": np.array([i for x in ids for i in x], np.int32)}


#: A lexicon without words.
NO_LEXICON = {"alphabet": np.zeros(0, np.uint32), **double_array([{}]), "final": np.zeros(1, np.uint8),
              "start": np.zeros(1, np.int32), "ids": np.zeros(0, np.int32)}


def to_file(arrays: dict[str, np.ndarray]) -> bytes:
    """A JSON line with name, type, shape and place of each array, then the arrays
    (8-byte aligned)."""
    blobs, at, head = [], 0, []
    for name, a in arrays.items():
        raw = np.ascontiguousarray(a).tobytes()
        head.append([name, a.dtype.str, a.shape, at])
        raw += b"\0" * (-len(raw) % 8)
        blobs.append(raw)
        at += len(raw)
    line = json.dumps(head).encode()
    line += b" " * (-(len(line) + 1) % 8) + b"\n"
    return line + b"".join(blobs)


def from_bytes(raw: np.ndarray) -> dict[str, np.ndarray]:
    """The arrays of a file of `to_file`, as views of its bytes."""
    length = int(np.flatnonzero(raw[:1 << 16] == 10)[0]) + 1
    out = {}
    for name, kind, shape, at in json.loads(raw[:length].tobytes()):
        size = int(np.prod(shape)) * np.dtype(kind).itemsize
        out[name] = raw[length + at:length + at + size].view(kind).reshape(shape)
    return out


def from_file(path: str) -> dict[str, np.ndarray]:
    """The arrays of a file of `to_file`, memory-mapped."""
    return from_bytes(np.memmap(path, np.uint8, "r"))


class Encoder:
    """Ids of slices of texts, through a lexicon (memory-mapped arrays) and exact merges."""

    def __init__(self, vocabulary: Vocabulary, lexicon: dict[str, np.ndarray]):
        self.vocabulary = vocabulary
        self.names = list(vocabulary.specials)
        self.lex = lexicon
        self.symbol = np.zeros(0x110000, np.uint16)
        self.symbol[lexicon["alphabet"]] = np.arange(1, len(lexicon["alphabet"]) + 1)
        self.known = len(lexicon["start"]) - 1
        self._forget()

    def _forget(self) -> None:
        self.memory: dict[str, int] = {}
        self.more, self.more_start = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def numbers(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Number in the lexicon of each word, -1 if it isn't there: all words walk
        the automaton together."""
        found = np.full(len(starts), -1, np.int64)
        at, left, who = starts.astype(np.int64), ends - starts, np.arange(len(starts))
        state, out = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        final, base, check, go, add = (self.lex[c] for c in ("final", "base", "check", "go", "add"))
        while len(who):
            symbol = self.symbol[points[at]].astype(np.int64)
            place = base[state] + symbol
            slot = np.clip(place, 0, len(check) - 1)
            on = (symbol > 0) & (check[slot] == state) & (place == slot)
            slot, left, at, who, out = slot[on], left[on] - 1, at[on] + 1, who[on], out[on]
            state, out = go[slot].astype(np.int64), out + add[slot]
            done = (left == 0) & (final[state] != 0)
            found[who[done]] = out[done]
            on = left > 0
            at, left, who, state, out = at[on], left[on], who[on], state[on], out[on]
        return found

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's begin (and the end)."""
        found, count = [np.zeros(0, np.int32)], np.zeros(len(texts), np.int64)
        for numbers, parts in batches_of(texts):
            ids, at = self._encode(parts)
            found.append(ids)
            np.add.at(count, numbers, np.diff(at[:len(parts) + 1]))
        return np.concatenate(found), np.concatenate([[0], np.cumsum(count)])

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.memory) > MEMORY:
            self._forget()
        points, starts, ends, per_text, whole = segment(texts, self.names)
        first, which = distinct_words(points, starts, ends)
        word = self.numbers(points, starts[first], ends[first])
        missing = np.flatnonzero(word < 0)
        found = [whole[a:b] for a, b in zip(starts[first[missing]].tolist(), ends[first[missing]].tolist(), strict=True)]
        memory, special = self.memory, list(self.vocabulary.specials.values())
        fresh = [w for w in found if w not in memory]
        memory.update(zip(fresh, range(len(memory), len(memory) + len(fresh)), strict=True))
        word[missing] = self.known + np.fromiter(map(memory.__getitem__, found), np.int64, len(found))
        if fresh:
            plain = [w if ord(w[0]) - SPECIAL_CP not in range(len(special)) else "" for w in fresh]
            merged = [ids if w else [special[ord(f[0]) - SPECIAL_CP]] for f, w, ids in zip(fresh, plain, self.vocabulary.merge_all(plain), strict=True)]
            stops = np.cumsum(np.fromiter(map(len, merged), np.int64, len(merged)))
            self.more_start = np.concatenate([self.more_start, stops + len(self.more)])
            self.more = np.concatenate([self.more, np.fromiter(chain.from_iterable(merged), np.int32, int(stops[-1]))])
        begin = np.concatenate([self.lex["start"][:-1], self.more_start[:-1] + len(self.lex["ids"])])
        count = np.concatenate([np.diff(self.lex["start"]), np.diff(self.more_start)])
        ids = np.concatenate([self.lex["ids"], self.more])
        begin, count = begin[word], count[word]  # of each distinct word
        n = count[which]
        stops = np.concatenate([[0], np.cumsum(n)])
        places = np.arange(stops[-1]) + np.repeat(begin[which] - stops[:-1], n)
        return ids[places], stops[per_text]


def ship_vocabulary(spark: SparkSession, path: str) -> str:
    """Ship the tokenizer file to the executors; its name there."""
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def word_counts(docs: DataFrame, text_col: str, file: str) -> DataFrame:
    """(word, n) of all documents, counted in the tasks before the shuffle."""
    rows = docs.select(F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        specials = list(Vocabulary(SparkFiles.get(file)).specials)

        def out(c: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], ["word", "n"])
        counts: Counter = Counter()
        for part in slices(batches, "text"):
            for _, texts in batches_of(part.column("text").to_pylist()):
                points, starts, ends, _, whole = segment(texts, specials)
                short = (ends - starts <= MAX_LENGTH) & (points[starts] // 0x800 != SPECIAL_CP // 0x800)
                starts, ends = starts[short], ends[short]
                first, which = distinct_words(points, starts, ends)
                seen = [whole[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
                for word, n in zip(seen, np.bincount(which, minlength=len(first)).tolist(), strict=True):
                    counts[word] += n
            if len(counts) > MEMORY:
                yield out(counts)
                counts = Counter()
        yield out(counts)
    return rows.mapInArrow(lean(run), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def ship_lexicon(spark: SparkSession, words: list[str], path: str) -> str:
    """Compile the lexicon, write it to the shared folder and ship it; its name."""
    raw = to_file(compile_lexicon(words, Vocabulary(path)))
    folder = work_dir(spark, "lexicon")
    target = f"{folder}/{os.path.basename(folder)}.bin"
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(target)
    stream = place.getFileSystem(conf).create(place, True)
    stream.write(bytearray(raw))
    stream.close()
    spark.sparkContext.addFile(target)
    return os.path.basename(target)


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(file: str, lexicon: str) -> Encoder:
    """The worker's encoder; the last one stays for the worker's next tasks."""
    if (file, lexicon) not in _encoders:
        _encoders.clear()
        _encoders[file, lexicon] = Encoder(Vocabulary(SparkFiles.get(file)), from_file(SparkFiles.get(lexicon)))
    return _encoders[file, lexicon]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", max_words: int = MAX_WORDS) -> DataFrame:
    """One row per row of `docs`: id and `ids`, its text's token ids."""
    spark = docs.sparkSession
    python_ready(spark)
    file = ship_vocabulary(spark, path)
    lexicon = ship_lexicon(spark, [r["word"] for r in most_frequent(word_counts(docs, text_col, file), "word", max_words)], path)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(file, lexicon)
        for part in slices(batches, "text"):
            ids, at = e.encode(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))], ["id", "ids"])
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(lean(run), f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


class Decoder:
    """Texts of token ids (special tokens kept, unknown ids left out)."""

    def __init__(self, vocabulary: Vocabulary):
        self.names = np.full(max(vocabulary.tokens) + 2, None, object)
        self.names[list(vocabulary.tokens)] = list(vocabulary.tokens.values())

    def texts(self, ids: np.ndarray, stops: list[int]) -> list[str]:
        last = len(self.names) - 1
        known = self.names[np.where((ids >= 0) & (ids < last), ids, last)].tolist()

        def text(part: list[str | None]) -> str:
            return " ".join([x for x in part if x is not None] if None in part else part)
        return [text(known[a:b]) for a, b in zip(stops, stops[1:], strict=False)]


def encode_and_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", max_words: int = MAX_WORDS) -> DataFrame:
    """Digests of `encode` and `decode` in one pass: id, n_tokens, ids_sha256 (of the decimal
    ids joined by spaces) and decoded_sha256. No token list leaves a worker."""
    spark = docs.sparkSession
    python_ready(spark)
    file = ship_vocabulary(spark, path)
    lexicon = ship_lexicon(spark, [r["word"] for r in most_frequent(word_counts(docs, text_col, file), "word", max_words)], path)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(file, lexicon)
        back = Decoder(e.vocabulary)
        decimal = np.array([str(i) for i in range(e.vocabulary.width)], object)
        for part in slices(batches, "text"):
            ids, at = e.encode(part.column("text").to_pylist())
            stops = at.tolist()
            numbers = decimal[ids].tolist()
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(np.diff(at), pa.int64()),
                 pa.array([hashlib.sha256(" ".join(numbers[a:b]).encode()).hexdigest() for a, b in zip(stops, stops[1:], strict=False)], pa.string()),
                 pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in back.texts(ids, stops)], pa.string())],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"])
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(lean(run), f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """`encoded` with `decoded`, the text of its ids (special tokens kept)."""
    spark = encoded.sparkSession
    python_ready(spark)
    file = ship_vocabulary(spark, path)
    schema = StructType([*encoded.schema.fields, StructField("decoded", StringType())])
    at = encoded.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        back = Decoder(Vocabulary(SparkFiles.get(file)))
        for batch in batches:
            column = batch.column(at)
            stops = np.cumsum([0] + pc.fill_null(pc.list_value_length(column), 0).to_pylist()).tolist()
            texts = back.texts(column.flatten().fill_null(-1).to_numpy(), stops)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], schema.names)
    return encoded.mapInArrow(lean(run), schema)
