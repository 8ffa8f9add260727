"""Language identification (operator 1): one interpolated Kneser-Ney character
model per language, stored in sorted hash arrays.

Words (runs of letters, lower case) are framed by a begin and an end mark; a model
predicts each character and the end mark from at most ORDER - 1 characters of the
word before it. Counts come from all training rows: tasks count n-gram hashes of
whole texts, Spark sums them, and joins turn the counts into Kneser-Ney
probabilities (continuation counts below the highest order and for all n-grams but
those at a word's begin, one discount per order). The whole model is kept, as a
written table of 64-bit hashes with probabilities and back-off weights that grows
with the input. Texts are scored with sorted arrays searched by bisection: of the
whole model, broadcast, while it has at most MAX_GRAMS entries over all languages;
beyond that, of the entries that the n-grams of a slice of texts ask for, which
reach the slice by joins on n-gram hashes (each n-gram once a slice). Both give the
same scores.

A text gets the language with the lowest cross-entropy per predicted character.
On a calibration fold, kept out of the counts, a logistic curve is fitted from the
lead over the second language to the chance of being right (the score), and for
each language and size class the cross-entropy that hardly any right text exceeds
(quantile REJECT_QUANTILE plus REJECT_SLACK, more for short texts): texts beyond it
are rejected. The calibration uses all rows of the fold: Spark sums them by cells of
evidence for the curve, and the quantiles are exact.

Defined cases: null, empty and letterless texts are `und` with score 0 and are
rejected; training rows with null text, null language or no letters teach nothing;
without any training row all texts are `und`; equal cross-entropies go to the
smaller language name; texts of any length are read whole; repeated rows give
repeated results; an empty table gives an empty result; only the named columns
are read, and the results' names start with `_lid_`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrant.llm.common import SLICE_BYTES, batches_of, give_back, lean, python_ready, slices, written
from quadrant.llm.segments import LETTER, classes, segment

ORDER = 4
#: Entries (n-grams and contexts) of the largest model that is broadcast whole.
MAX_GRAMS = 1 << 20
#: N-gram counts, over all languages, that a task holds before it sums or sends them.
HELD_GRAMS = 1 << 20
REJECT_QUANTILE, REJECT_SLACK = 0.999, 0.35
#: Cells to a unit of evidence in which the curve's rows are summed.
CELLS = 1024
#: Characters that an unseen one is drawn from.
CHARACTERS = 1 << 16
BEGIN, STOP = 2, 3  # marks, as code points no letter has
UNKNOWN = "und"
_BASE = np.uint64(0x9E3779B97F4A7C15)
GRAM = np.dtype([("k", "i4"), ("h", "i8"), ("context", "i8"), ("suffix", "i8"), ("begins", "?"), ("n", "i8")])


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalised 64-bit hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of the texts as one framed array of code points, the place of
    each word's begin mark and its length with marks, and, for each word in the
    texts, the number of its text and of its distinct word."""
    points, starts, ends, per_text, _ = segment(texts, [])
    text = np.repeat(np.arange(len(texts)), np.diff(per_text))
    letters = classes()[points[starts]] == LETTER if len(starts) else np.zeros(0, bool)
    starts, lengths, text = starts[letters], (ends - starts)[letters], text[letters]
    if not len(starts):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none, none
    # 64-bit hash of each word, from its characters and their places
    total = np.concatenate([[0], np.cumsum(lengths)])
    place = np.arange(total[-1]) - np.repeat(total[:-1], lengths)
    flat = points[np.repeat(starts, lengths) + place].astype(np.uint64)
    key = np.add.reduceat(mixed(flat + _BASE * (place.astype(np.uint64) + np.uint64(1))), total[:-1])
    _, first, number = np.unique(key, return_index=True, return_inverse=True)
    size = lengths[first] + 2
    at = np.concatenate([[0], np.cumsum(size)])
    framed = np.full(at[-1], STOP, np.uint64)
    framed[at[:-1]] = BEGIN
    inside = np.arange(at[-1]) - np.repeat(at[:-1], size)
    body = (inside > 0) & (inside < np.repeat(size, size) - 1)
    framed[body] = points[(np.repeat(starts[first], size) + inside - 1)[body]]
    return framed, at[:-1], size, text, number


def hashes(framed: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """For every place: how many characters of its word stand up to it, the hashes
    of the 1 to ORDER characters that end there (0 of none)."""
    upto = np.arange(len(framed)) - np.repeat(starts, sizes) + 1
    raw, out = np.zeros(len(framed), np.uint64), []
    factor = np.uint64(1)
    for k in range(1, ORDER + 1):
        before = np.zeros(len(framed), np.uint64)
        before[k - 1:] = framed[:len(framed) - k + 1]
        with np.errstate(over="ignore"):
            raw = raw + before * factor
            factor = factor * _BASE
        out.append(mixed(raw + np.uint64(k)).view(np.int64))
    return upto, out, np.repeat(np.arange(len(starts)), sizes)


def count_grams(texts: list[str]) -> np.ndarray:
    """N-grams of the texts with their hashes, those of their contexts and suffixes, and counts."""
    parts = [_count_grams(parts) for _, parts in batches_of(texts)]
    return parts[0] if len(parts) == 1 else summed(np.concatenate([np.zeros(0, GRAM), *parts]))


def grouped(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every distinct key a place that holds it, and the sum of its n."""
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, int)
    return order[first], np.add.reduceat(n[order], first) if len(first) else n[:0]


def _count_grams(texts: list[str]) -> np.ndarray:
    framed, starts, sizes, _, number = words_of(texts)
    if not len(starts):
        return np.zeros(0, GRAM)
    times = np.bincount(number, minlength=len(starts))
    upto, h, word = hashes(framed, starts, sizes)
    parts = []
    for k in range(1, ORDER + 1):
        here = np.flatnonzero((upto >= k) & (upto > 1))  # the begin mark is never predicted
        at, n = grouped(h[k - 1][here], times[word[here]])
        at = here[at]
        part = np.zeros(len(at), GRAM)
        part["k"], part["h"], part["n"] = k, h[k - 1][at], n
        part["context"] = h[k - 2][at - 1] if k > 1 else 0
        part["suffix"] = h[k - 2][at] if k > 1 else 0
        part["begins"] = upto[at] == k
        parts.append(part)
    return np.concatenate(parts)


def summed(grams: np.ndarray) -> np.ndarray:
    """One row per n-gram."""
    at, n = grouped(grams["h"] ^ grams["k"].astype(np.int64), grams["n"])
    out = grams[at]
    out["n"] = n
    return out


def gram_counts(rows: DataFrame) -> DataFrame:
    """rows(text, lang) -> n-gram counts by language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, list[np.ndarray]] = {}
        held = 0

        def sent() -> Iterator[pa.RecordBatch]:
            for lang, parts in kept.items():
                g = summed(np.concatenate(parts))
                for i in range(0, len(g), 1 << 16):
                    x = g[i:i + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(x), pa.string()), *[pa.array(np.ascontiguousarray(x[c])) for c in GRAM.names]],
                                                     ["lang", *GRAM.names])
            kept.clear()
        for part in slices(batches, "text"):
            langs = np.array(part.column("lang").to_pylist(), object)
            texts = np.array(part.column("text").to_pylist(), object)
            for lang in sorted(set(langs)):
                mine = kept.setdefault(lang, [])
                mine.append(count_grams(texts[langs == lang].tolist()))
                held += len(mine[-1])
            if held > HELD_GRAMS:
                for lang, mine in kept.items():
                    kept[lang] = [summed(np.concatenate(mine))]
                held = sum(len(mine[0]) for mine in kept.values())
                if held > HELD_GRAMS // 2:  # mostly different ones: Spark adds up what is sent
                    yield from sent()
                    held = 0
        yield from sent()
    made = rows.mapInArrow(lean(run), "lang string, k int, h long, context long, suffix long, begins boolean, n long")
    return made.groupBy("lang", "k", "h").agg(F.first("context").alias("context"), F.first("suffix").alias("suffix"),
                                              F.first("begins").alias("begins"), F.sum("n").alias("n"))


def kneser_ney(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """N-grams with probabilities and contexts with back-off weights."""
    follow = counts.groupBy("lang", (F.col("k") - 1).alias("k"), F.col("suffix").alias("h")).agg(F.count("*").alias("types_before"))
    used = counts.join(follow, ["lang", "k", "h"], "left").withColumn(
        "c", F.when((F.col("k") == ORDER) | (F.col("begins") & (F.col("k") > 1)), F.col("n")).otherwise(F.coalesce("types_before", F.lit(1))).cast("double"))
    once, twice = F.sum((F.col("c") == 1).cast("double")), F.sum((F.col("c") == 2).cast("double"))
    discount = used.groupBy("lang", "k").agg(F.least(F.lit(0.95), F.greatest(F.lit(0.1), (once + 0.5) / (once + 2 * twice + 1.0))).alias("d"))
    context = (used.groupBy("lang", "k", "context").agg(F.sum("c").alias("total"), F.count("*").alias("types"))
                   .join(discount, ["lang", "k"])
                   .select("lang", "k", "context", "total", "d", (F.col("d") * F.col("types") / F.col("total")).alias("weight")))
    context = written(context, "lm-contexts")
    rows = used.join(context, ["lang", "k", "context"]).withColumn("own", F.greatest(F.col("c") - F.col("d"), F.lit(0.0)) / F.col("total"))
    rows = written(rows.select("lang", "k", "h", "suffix", "own", "weight"), "lm-grams")
    done = rows.filter("k = 1").withColumn("p", F.col("own") + F.col("weight") / CHARACTERS).select("lang", "k", "h", "p")
    every = done
    for k in range(2, ORDER + 1):
        below = done.select("lang", F.col("h").alias("suffix"), F.col("p").alias("q"))
        done = (rows.filter(F.col("k") == k).join(below, ["lang", "suffix"])
                    .select("lang", "k", "h", (F.col("own") + F.col("weight") * F.col("q")).alias("p")))
        every = every.unionByName(done)
    return every, context.select("lang", "k", F.col("context").alias("h"), "weight")


class Models:
    """Sorted hash arrays of every language's model."""

    def __init__(self, entries: pd.DataFrame, langs: list[str] | None = None):
        """entries(lang, k, h, value): probabilities of n-grams (k > 0) and back-off
        weights of contexts (k < 0); `langs` if some may have no entry."""
        self.langs = sorted(entries.lang.unique()) if langs is None else langs
        parts, none = dict(list(entries.sort_values("h").groupby(["lang", "k"]))), entries.iloc[:0]
        self.tables = []
        for lang in self.langs:
            orders = []
            for k in range(1, ORDER + 1):
                g, c = parts.get((lang, k), none), parts.get((lang, -k), none)
                orders.append((g.h.to_numpy(np.int64), np.log(g.value.to_numpy(np.float64)).astype(np.float32),
                               c.h.to_numpy(np.int64), np.log(c.value.to_numpy(np.float64)).astype(np.float32)))
            self.tables.append(orders)

    @staticmethod
    def find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(table, keys)
        at[at == len(table)] = 0
        return at, table[at] == keys if len(table) else np.zeros(len(keys), bool)

    def word_scores(self, framed: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Log probability of each framed word in each language."""
        upto, h, _ = hashes(framed, starts, sizes)
        # distinct n-grams in order, and the number of that at each place: looked up once a language
        grams = [np.unique(np.where(upto >= k, x, 0), return_inverse=True) for k, x in enumerate(h, 1)]
        out = np.zeros((len(starts), len(self.langs)))
        for i, orders in enumerate(self.tables):
            log_p = self._places(orders, grams, upto)
            log_p[starts] = 0.0
            out[:, i] = np.add.reduceat(log_p, starts)
        return out

    def looked_up(self, table: np.ndarray, values: np.ndarray, keys: np.ndarray, none: float) -> np.ndarray:
        if not len(table):
            return np.full(len(keys), none, np.float32)
        at, hit = self.find(table, keys)
        return np.where(hit, values[at], np.float32(none))

    def _places(self, orders: list, grams: list[tuple[np.ndarray, np.ndarray]], upto: np.ndarray) -> np.ndarray:
        out = np.zeros(len(upto))
        todo = np.flatnonzero(upto > 1)
        for k in range(ORDER, 0, -1):
            table, log_p, contexts, weights = orders[k - 1]
            distinct, number = grams[k - 1]
            short = upto[todo] < k
            mine = todo[~short] if short.any() else todo
            found = self.looked_up(table, log_p, distinct, np.nan)[number[mine]]
            miss = np.isnan(found)
            out[mine] += np.where(miss, np.float32(0), found)
            miss = mine[miss]
            if k > 1 and len(miss):
                distinct, number = grams[k - 2]
                out[miss] += self.looked_up(contexts, weights, distinct, 0.0)[number[miss - 1]]
            elif k == 1 and len(weights):
                out[miss] += weights[0] - np.log(CHARACTERS)  # the empty context's
            todo = np.concatenate([todo[short], miss])
        return out

    def texts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy of each text in each language (nats a character), and
        the number of characters predicted."""
        total, n = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts))
        for numbers, parts in batches_of(texts):
            framed, starts, sizes, text, number = words_of(parts)
            if not len(starts):
                continue
            text = np.array(numbers)[text]
            n += np.bincount(text, sizes[number] - 1, minlength=len(texts))
            scores = self.word_scores(framed, starts, sizes) if self.langs else None
            for i in range(len(self.langs)):
                total[:, i] += np.bincount(text, scores[number, i], minlength=len(texts))
        return -total / np.maximum(n, 1)[:, None], n


class Tables:
    """A model that is not broadcast: entries as those of Models, and the weights of
    the empty contexts (one row a language)."""

    def __init__(self, entries: DataFrame):
        self.empty = entries.filter("k = -1").toPandas()
        self.langs = sorted(self.empty.lang)
        self.entries = entries.filter("k <> -1")


def fit(rows: DataFrame, max_grams: int = MAX_GRAMS) -> Models | Tables:
    """rows(text, lang): labelled rows -> the whole model, as arrays up to
    `max_grams` entries, else as tables."""
    counts = written(gram_counts(rows), "lm-counts")
    grams, contexts = kneser_ney(counts)
    entries = written(grams.select("lang", "k", "h", F.col("p").alias("value")).unionByName(
        contexts.select("lang", (-F.col("k")).alias("k"), "h", F.col("weight").alias("value"))), "lm-model")
    return Models(entries.toPandas()) if entries.count() <= max_grams else Tables(entries)


def judged(part: pa.RecordBatch, m: Models, left_out: tuple[str, ...] = ("text",)) -> pa.RecordBatch:
    """The rows without the columns `left_out`, with what `measured` adds."""
    h, n = m.texts(part.column("text").to_pylist())
    known = (n > 0) & (len(m.langs) > 0)
    if m.langs:
        best = h.argmin(1)
        low = h[np.arange(len(h)), best]
        second = np.partition(h, 1, 1)[:, 1] if len(m.langs) > 1 else low + 10.0
        names = np.array(m.langs, object)[best]
    else:
        names, low, second = np.full(len(n), UNKNOWN, object), np.zeros(len(n)), np.zeros(len(n))
    names = np.where(known, names, UNKNOWN)
    kept = [c for c in part.schema.names if c not in left_out]
    return pa.RecordBatch.from_arrays(
        [*[part.column(c) for c in kept], pa.array(names.tolist(), pa.string()),
         pa.array(np.where(known, low, 0.0)), pa.array(np.where(known, second - low, 0.0)), pa.array(n)],
        [*kept, "lang_pred", "cross_entropy", "lead", "size"])


def measured(rows: DataFrame, models: Models | Tables) -> DataFrame:
    """rows(key, text) -> key, best language, its cross-entropy, the lead over the
    second, and the number of characters predicted."""
    python_ready(rows.sparkSession)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    schema = f"{kinds}, lang_pred string, cross_entropy double, lead double, size double"
    if isinstance(models, Tables):
        return by_slices(rows, models, schema)
    shared = rows.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            yield judged(part, shared.value)
    return rows.mapInArrow(lean(run), schema)


def by_slices(rows: DataFrame, models: Tables, schema: str) -> DataFrame:
    """`measured` with a model in tables: each slice of texts gets the entries that
    its n-grams ask for."""
    langs, empty = models.langs, models.empty
    limit = max(SLICE_BYTES * 8 // max(8, len(langs)), 1 << 16)  # entries of a slice: n-grams by languages

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size = TaskContext.get().partitionId() << 32, 0
        for part in slices(batches, "text", limit):
            size += part.column("text").nbytes
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.full(len(part), number))], [*part.schema.names, "_slice"])
            if size > limit:
                number, size = number + 1, 0

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column("_slice").to_numpy()
            for i in np.unique(number):
                grams = count_grams(batch.column("text").filter(pa.array(number == i)).to_pylist())
                context = np.unique(grams[["k", "context"]][grams["k"] > 1])
                k, h = np.concatenate([grams["k"], -context["k"]]), np.concatenate([grams["h"], context["context"]])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), i)), pa.array(k), pa.array(h)], ["_slice", "k", "h"])

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        found = right.select(["lang", "k", "h", "value"]).to_pandas()
        m = Models(pd.concat([empty, found]), langs)
        out = pa.Table.from_batches([judged(part, m, ("text", "_slice")) for part in left.to_batches()])
        del found, m
        give_back()
        return out
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    dealt = written(rows.mapInArrow(lean(deal), f"{kinds}, _slice long"), "lm-slices")
    asked = dealt.select("_slice", "text").mapInArrow(lean(ask), "_slice long, k int, h long").distinct()
    found = asked.join(models.entries, ["k", "h"]).select("_slice", "lang", "k", "h", "value")
    return dealt.groupBy("_slice").cogroup(found.groupBy("_slice")).applyInArrow(score, schema)


class Calibration:
    """Score curve and rejection limits, from every row of the calibration fold."""

    def __init__(self, rows: DataFrame):
        """rows(lang, lang_pred, cross_entropy, lead, size), a written table."""
        known = rows.filter(F.col("lang_pred") != UNKNOWN)
        right = F.col("lang_pred") == F.col("lang")
        # every row counts, in a cell of 1/CELLS of the evidence (60 at most) at the mean of the cell's rows
        points = known.select(self.evidence().alias("x"), right.cast("long").alias("y")).groupBy(F.floor(F.col("x") * CELLS).alias("cell")).agg(
            F.avg("x").alias("x"), F.sum("y").alias("y"), F.count("*").alias("n")).orderBy("cell").toPandas()
        x, y, n = (points[c].to_numpy(float) for c in ("x", "y", "n"))
        a = np.zeros(2)
        if len(x):
            m = np.stack([np.ones_like(x), x], 1)
            for _ in range(50):  # Newton's method with a small ridge
                p = 1 / (1 + np.exp(-np.clip(m @ a, -30, 30)))
                grad = m.T @ (y - n * p) - 0.01 * a
                hess = (m * (n * p * (1 - p))[:, None]).T @ m + 0.01 * np.eye(2)
                step = np.linalg.solve(hess, grad)
                a = a + np.clip(step, -5, 5)
                if np.abs(step).max() < 1e-8:
                    break
        self.curve = (float(a[0]), float(a[1]))
        band = F.least(F.lit(12), F.floor(F.log2("size")).cast("int"))
        found = self.quantiles(known.filter(right).select(F.col("lang_pred").alias("lang"), F.explode(F.array(band, F.lit(-1))).alias("band"), "cross_entropy"))
        self.limits: list[tuple[str, int, float]] = []
        for lang, pooled in sorted((lang, own[1]) for (lang, b), own in found.items() if b < 0):
            for b in range(13):
                n_own, own, most = found.get((lang, b), (0, pooled, pooled))
                high = own if n_own >= 200 else max(pooled, most)
                # the entropy of a short text strays as the root of its size
                self.limits.append((lang, b, high + REJECT_SLACK + 4.0 / 2 ** (b / 2)))

    @staticmethod
    def quantiles(rows: DataFrame) -> dict[tuple[str, int], tuple[int, float, float]]:
        """rows(lang, band, cross_entropy) -> per class the number of rows, the exact
        REJECT_QUANTILE quantile (between two rows as numpy has it) and the largest. Of a
        class of many rows the driver gets the distinct values of its upper hundredth:
        an approximate quantile, less than 1/1000 off in rank, tells where that begins."""
        approx = F.percentile_approx("cross_entropy", 0.99, 1000)
        classes = rows.groupBy("lang", "band").agg(F.count("*").alias("n"), F.when(F.count("*") >= 1000, approx).otherwise(F.lit(float("-inf"))).alias("border"))
        upper = (rows.join(F.broadcast(classes), ["lang", "band"]).filter(F.col("cross_entropy") >= F.col("border"))
                 .groupBy("lang", "band", "n", "cross_entropy").agg(F.count("*").alias("times")).toPandas())
        out = {}
        for (lang, b, n), g in upper.sort_values("cross_entropy", ascending=False).groupby(["lang", "band", "n"], sort=False):
            value, down_to = g.cross_entropy.to_numpy(), g.times.cumsum().to_numpy()
            at = REJECT_QUANTILE * (n - 1)
            low, high = (float(value[np.searchsorted(down_to, n - 1 - k, "right")]) for k in (np.floor(at), np.ceil(at)))
            out[lang, int(b)] = (int(n), low + (high - low) * (at % 1), float(value[0]))
        return out

    @staticmethod
    def evidence() -> Column:
        return F.least(F.col("lead") * F.sqrt("size"), F.lit(60.0))

    def score(self) -> Column:
        p = 1 / (1 + F.exp(-(F.lit(self.curve[0]) + self.curve[1] * self.evidence())))
        return F.when(F.col("lang_pred") == UNKNOWN, F.lit(0.0)).otherwise(p)

    def rejected(self) -> Column:
        if not self.limits:
            return F.col("lang_pred") == UNKNOWN
        band = F.least(F.lit(12), F.floor(F.log2(F.greatest(F.col("size"), F.lit(1.0)))).cast("int")).cast("string")
        table = F.create_map(*[F.lit(x) for lang, b, high in self.limits for x in (f"{b} {lang}", high)])
        limit = F.try_element_at(table, F.concat_ws(" ", band, F.col("lang_pred")))
        return (F.col("lang_pred") == UNKNOWN) | F.coalesce(F.col("cross_entropy") > limit, F.lit(False))


def identify(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             max_grams: int = MAX_GRAMS, keep: tuple[str, ...] = ()) -> DataFrame:
    """The `keep` columns (id_col if none) of every row of `docs` with `_lid_lang`,
    `_lid_score`, `_lid_rejected`, `_lid_entropy` and `_lid_size`. Rows with `train` and a
    language teach: a quarter of them, by id hash, calibrates (each of these rows,
    repeated ones once), the others count."""
    python_ready(docs.sparkSession)
    text, lang = F.col(f"`{text_col}`"), F.col(f"`{lang_col}`")
    key = F.xxhash64(F.col(f"`{id_col}`").cast("string"))
    taught = docs.filter(train & lang.isNotNull() & text.isNotNull()).select(text.alias("text"), lang.alias("lang"), key.alias("key"))
    fold = F.pmod(F.shiftright("key", 8), F.lit(4)) == 0
    models = fit(taught.filter(~fold).select("text", "lang"), max_grams)
    held = taught.filter(fold).withColumn("key", F.xxhash64("key", "text", "lang")).dropDuplicates(["key"])
    calibration = Calibration(written(measured(held.select("lang", "text"), models), "lid-calibration"))
    columns = list(keep) or [id_col]
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)], text.alias("text"))
    out = measured(rows, models)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)], F.col("lang_pred").alias("_lid_lang"),
                      calibration.score().alias("_lid_score"), calibration.rejected().alias("_lid_rejected"),
                      F.col("cross_entropy").alias("_lid_entropy"), F.col("size").alias("_lid_size"))
