"""Multi-label indexing: vocabulary chunks (W1), text x chunk requests (J5, P4),
the pluggable classifier (X1), response parsing (F6), accumulation (A5),
entity resolution (J8) and index quads (X5); `index_flow` composes them (X6).

The built-in classifier finds the vocabulary words in each text and joins them
with the vocabulary rows, so its rows follow the matches. The (text, chunk) form
is built only where the answer is per chunk or an external model is asked.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrant.functions import constants as K
from quadrant.functions.expressions import trim_space
from quadrant.operators.positions import dense_position
from quadrant.operators.textprep import vocab_dedupe, with_qualified
from quadrant.session import python_ready, ship_package, written

# words of one Aho-Corasick automaton; a larger vocabulary makes several blocks
WORDS_PER_BLOCK = 100_000
# requests handed to an external model at once
REQUESTS_PER_CALL = 256
# copies of the chunk table in the pairing, so that a chunk's key doesn't hold a copy of every text
PAIR_SALTS = 8


# ------------------------------------------------------------------ W1
def vocab_chunks(vocab: DataFrame, size: int = K.LABELS_PER_CHUNK) -> tuple[DataFrame, int]:
    """Number vocabulary rows in file order and cut them into chunks of `size`.
    Returns (rows with chunk_id / pos_in_chunk, number of chunks)."""
    rows = written(dense_position(vocab, ["ord"], name="pos")
                   .withColumn("chunk_id", F.floor(F.col("pos") / size).cast("bigint"))
                   .withColumn("pos_in_chunk", (F.col("pos") % size).cast("bigint")), "vocabulary")
    last = rows.agg(F.max("chunk_id")).first()[0]
    return rows, 0 if last is None else last + 1


def chunk_table(chunk_rows: DataFrame, label_col: str = "vocas") -> DataFrame:
    """One row per chunk: ordered array of (label, lower-cased match word, published label)."""
    return chunk_rows.groupBy("chunk_id").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("pos_in_chunk", F.col("strLabel"), F.col(label_col).alias("label")))),
            lambda x: F.struct(F.lower(x["strLabel"]).alias("match"), x["label"].alias("label")),
        ).alias("chunk"))


# ------------------------------------------------------------------ J5
def text_chunk_pairs(texts: DataFrame, chunks: DataFrame, n_chunks: int, id_col: str = "media_seg") -> DataFrame:
    """Every text with every chunk: texts expand the chunk ids and join the chunk
    table, which the planner broadcasts by its size; if it shuffles instead, each
    chunk's texts are spread over PAIR_SALTS keys."""
    ids = F.sequence(F.lit(0).cast("bigint"), F.lit(max(n_chunks - 1, 0)).cast("bigint"))
    t = (texts.withColumn("chunk_id", F.explode(ids))
              .withColumn("_salt", F.pmod(F.xxhash64(id_col), F.lit(PAIR_SALTS)).cast("int")))
    if n_chunks == 0:
        t = t.where(F.lit(False))
    salted = chunks.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(PAIR_SALTS - 1))))
    return t.join(salted, ["chunk_id", "_salt"]).drop("_salt")


# ------------------------------------------------------------------ X1 (match)
_AUTOMATA: dict[str, object] = {}


def _automaton(words: list[str], key: str):
    """The automaton of a block of words; a worker keeps the last ones it built."""
    import ahocorasick
    auto = _AUTOMATA.get(key)
    if auto is None:
        auto = ahocorasick.Automaton()
        for w in words:
            auto.add_word(w, w)
        auto.make_automaton()
        if len(_AUTOMATA) >= 4:
            _AUTOMATA.clear()
        _AUTOMATA[key] = auto
    return auto


def word_blocks(rows: DataFrame) -> DataFrame:
    """(block, words): the distinct lower-cased labels in blocks of about
    WORDS_PER_BLOCK. Null labels match nothing."""
    words = rows.select(F.lower("strLabel").alias("w")).where(F.col("w").isNotNull()).distinct()
    n = max(1, -(-words.count() // WORDS_PER_BLOCK))
    return words.groupBy(F.pmod(F.xxhash64("w"), F.lit(n)).alias("block")).agg(F.collect_list("w").alias("words"))


def matched_words(texts: DataFrame, blocks: DataFrame, id_col: str = "media_seg", text_col: str = "text") -> DataFrame:
    """(id, word): the distinct vocabulary words contained in the whole lower-cased
    text. Each block of words is one Aho-Corasick automaton that passes over each
    text once (usually one block in all). Texts are lower-cased in the JVM, as the
    words were, and compared code point by code point, like `contains`."""
    spark = texts.sparkSession
    ship_package(spark)
    python_ready(spark)
    shared = []  # broadcast block by block
    for r in blocks.toLocalIterator():
        words = sorted(r["words"])
        shared.append((hashlib.sha1("\n".join(words).encode()).hexdigest(), spark.sparkContext.broadcast(words)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids, found = [], []
            for key, bc in shared:
                words = [w for w in bc.value if w]
                auto = _automaton(words, key) if words else None
                always = [""] if len(words) < len(bc.value) else []  # the empty word is contained in every text
                for i, low in zip(pdf[id_col], pdf["_low"]):
                    if low is not None:
                        hits = sorted({w for _, w in auto.iter(low)}) if auto else []
                        ids += [i] * (len(hits) + len(always))
                        found += hits + always
            yield pd.DataFrame({id_col: ids, "word": found}, dtype=object)

    src = texts.select(id_col, F.lower(F.col(text_col)).alias("_low"))
    return src.mapInPandas(run, f"{id_col} string, word string")


def lexical_pairs(texts: DataFrame, chunks: DataFrame, n_chunks: int, blocks: DataFrame, id_col: str = "media_seg",
                  text_col: str = "text") -> DataFrame:
    """(text, chunk) pairs ready for `lexical_response`: each pair carries the
    words its text contains (`_matched`), found once per text."""
    ids = texts.select(id_col, F.lit(None).cast("string").alias("word"))
    words = ids.unionByName(matched_words(texts, blocks, id_col, text_col)).groupBy(id_col).agg(F.collect_set("word").alias("_matched"))
    return text_chunk_pairs(words, chunks, n_chunks, id_col)


# ------------------------------------------------------------------ P4
SYSTEM_TASK = ("Classez le texte dans une ou plusieurs des catégories proposées. "
               "Répondez par les noms exacts des catégories, séparés par des virgules, "
               "ou par 'Rien' si aucune ne convient.")
SYSTEM_CHOICES = "Catégories possibles : "


def inference_requests(pairs: DataFrame, id_col: str = "media_seg", text_col: str = "text",
                       list_name: str | None = None) -> DataFrame:
    """One chat request per (text, chunk): system task, user text, system choices.

    The batch variant lists the chunk's labels; the app variant names the
    parent list as well.
    """
    choices = F.array_join(F.transform(F.col("chunk"), lambda x: x["label"]), " ")
    if list_name:
        choices = F.concat(F.lit(f"[{list_name}] "), choices)
    msgs = F.array(
        F.struct(F.lit(0).alias("msg_ord"), F.lit("system").alias("role"), F.lit(SYSTEM_TASK).alias("content")),
        F.struct(F.lit(1).alias("msg_ord"), F.lit("user").alias("role"),
                 F.concat(F.lit("Le texte : "), F.col(text_col)).alias("content")),
        F.struct(F.lit(2).alias("msg_ord"), F.lit("system").alias("role"),
                 F.concat(F.lit(SYSTEM_CHOICES), choices).alias("content")),
    )
    return pairs.select(id_col, "chunk_id", F.inline(msgs))


# ------------------------------------------------------------------ X1
def lexical_response(pairs: DataFrame) -> DataFrame:
    """Deterministic built-in classifier: the chunk labels whose word occurs in
    the whole text, case-insensitively, answered as 'l1, l2' or 'Rien'."""
    hits = F.transform(F.filter(F.col("chunk"), lambda x: F.array_contains(F.col("_matched"), x["match"])), lambda x: x["label"])
    with_hits = pairs.withColumn("_hits", hits)
    resp = F.when(F.size("_hits") > 0, F.array_join("_hits", ", ")).otherwise(F.lit(K.NO_ANSWER))
    return with_hits.withColumn("response", resp).drop("_hits", "_matched")


def plugin_response(texts: DataFrame, chunks: DataFrame, n_chunks: int,
                    model: Callable[[pd.DataFrame], pd.Series],
                    id_col: str = "media_seg", text_col: str = "text") -> DataFrame:
    """External classifier through mapInPandas: one request per (text, chunk).

    `model(pdf)` gets at most REQUESTS_PER_CALL requests with columns id,
    chunk_id, text, labels (list of str) and returns one response string each.
    Returns (id, chunk_id, response, chunk); write it before several consumers
    read it (a model may answer differently on a re-run)."""
    ship_package(texts.sparkSession)
    pairs = text_chunk_pairs(texts.select(id_col, text_col), chunks.select("chunk_id", F.transform("chunk", lambda x: x["label"]).alias("labels")),
                             n_chunks, id_col)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i in range(0, len(pdf), REQUESTS_PER_CALL):
                part = pdf.iloc[i:i + REQUESTS_PER_CALL].reset_index(drop=True)
                out = part[[id_col, "chunk_id"]].copy()
                out["response"] = model(part).astype(str).values
                yield out

    resp = pairs.select(id_col, text_col, "chunk_id", "labels").mapInPandas(run, f"{id_col} string, chunk_id bigint, response string")
    return resp.join(chunks, "chunk_id")


# ------------------------------------------------------------------ F6
def parse_response(resp_col: str = "response", chunk_col: str = "chunk") -> F.Column:
    """Split on ',', strip, keep labels offered in the chunk (exact, case-sensitive,
    duplicates kept). 'Rien' and unknown labels drop out."""
    parts = F.transform(F.split(F.col(resp_col), ","),
                        trim_space)
    offered = F.transform(F.col(chunk_col), lambda x: x["label"])
    return F.filter(parts, lambda x: F.array_contains(offered, x))


# ------------------------------------------------------------------ A5
def collect_predictions(parsed: DataFrame, id_col: str = "media_seg") -> DataFrame:
    """Per text, labels of all chunks in chunk order (no dedupe)."""
    return parsed.groupBy(id_col).agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("chunk_id", "labels"))),
                              lambda x: x["labels"])).alias("labels"))


# ------------------------------------------------------------------ J8
def first_vocab_rows(vocab: DataFrame, match_col: str) -> DataFrame:
    """The first vocabulary row (lowest file position) of every label, as a
    map-side-combined `min_by` aggregate."""
    best = vocab.groupBy(match_col).agg(
        F.min_by(F.struct("strLabel", "subclass", "entity", "uriclass"), "ord").alias("_r"))
    return best.select(F.col(match_col).alias("_match"), "_r.strLabel", "_r.subclass", "_r.entity", "_r.uriclass")


def resolve_entities(predictions: DataFrame, vocab: DataFrame, match_col: str = "vocas",
                     id_col: str = "media_seg") -> DataFrame:
    """Each predicted label -> first vocabulary row with that label; order kept,
    unknown labels dropped, records without labels kept with an empty list.
    Only labels meet the vocabulary; records without any bypass the join."""
    first = first_vocab_rows(vocab, match_col)
    exploded = predictions.select(id_col, F.posexplode("labels").alias("lpos", "_match"))
    hits = exploded.join(first, "_match").select(id_col, F.struct("lpos", "strLabel", "subclass", "entity", "uriclass").alias("hit"))
    return _records(predictions.select(id_col), hits, id_col)


def _records(ids: DataFrame, hits: DataFrame, id_col: str) -> DataFrame:
    """One record per id with its hits' vocabulary rows in order (none: empty)."""
    every = ids.select(id_col, F.lit(None).cast(hits.schema["hit"].dataType).alias("hit")).unionByName(hits)
    listed = F.array_sort(F.collect_list("hit"))  # collect_list leaves nulls out
    return every.groupBy(id_col).agg(F.transform(listed, lambda x: F.struct(
        x["strLabel"].alias("strLabel"), x["subclass"].alias("subclass"), x["entity"].alias("entity"),
        x["uriclass"].alias("uriclass"))).alias("predicted_labels"))


# ------------------------------------------------------------------ X1 + F6 + A5 + J8 on matches
def accepted_labels(chunk_rows: DataFrame, label_col: str) -> DataFrame:
    """What each vocabulary word leads to, worked out once on the vocabulary: the
    labels that answering and parsing (F6) accept for its rows, in chunk order,
    with the first vocabulary row of each (J8).

    A label is answered as text and split at commas again, so a row's accepted
    labels are the parts of its label that its chunk offers."""
    offered = chunk_rows.select("chunk_id", F.col(label_col).alias("label")).distinct()
    parts = F.transform(F.split(F.col(label_col), ","), trim_space)
    rows = chunk_rows.where(F.col("strLabel").isNotNull()).select(
        F.lower("strLabel").alias("word"), "chunk_id", "pos_in_chunk", F.posexplode(parts).alias("part", "label"))
    rows = rows.join(offered, ["chunk_id", "label"], "left_semi")
    first = first_vocab_rows(chunk_rows, label_col).withColumnRenamed("_match", "label")
    return rows.join(first, "label", "left")


def lexical_hits(texts: DataFrame, accepted: DataFrame, blocks: DataFrame, id_col: str = "media_seg") -> DataFrame:
    """(id, place in the answer, label, vocabulary row) of every accepted label:
    rows follow the matches, not texts times chunks."""
    return matched_words(texts, blocks, id_col).join(accepted, "word").drop("word")


def lexical_predictions(texts: DataFrame, accepted: DataFrame, blocks: DataFrame, id_col: str = "media_seg") -> DataFrame:
    """J5 + X1 + F6 + A5 with the built-in classifier: per text, the accepted
    labels in chunk order (no dedupe)."""
    hits = lexical_hits(texts, accepted, blocks, id_col).select(id_col, F.struct("chunk_id", "pos_in_chunk", "part", "label").alias("hit"))
    every = texts.select(id_col, F.lit(None).cast(hits.schema["hit"].dataType).alias("hit")).unionByName(hits)
    return every.groupBy(id_col).agg(F.transform(F.array_sort(F.collect_list("hit")), lambda x: x["label"]).alias("labels"))


def lexical_records(texts: DataFrame, accepted: DataFrame, blocks: DataFrame, id_col: str = "media_seg") -> DataFrame:
    """The same up to J8: per text, the vocabulary rows of its labels."""
    hits = lexical_hits(texts, accepted, blocks, id_col).where(F.col("entity").isNotNull()).select(id_col, F.struct(
        "chunk_id", "pos_in_chunk", "part", "strLabel", "subclass", "entity", "uriclass").alias("hit"))
    return _records(texts.select(id_col), hits, id_col)


# ------------------------------------------------------------------ X5
def index_quads(resolved: DataFrame, seg_col: str = "media_seg") -> DataFrame:
    """(segment, uriclass, entity, graph = segment), as a set."""
    e = resolved.select(seg_col, F.explode("predicted_labels").alias("l"))
    return e.select(F.col(seg_col).alias("s"), F.col("l.uriclass").alias("p"),
                    F.col("l.entity").alias("o"), F.col(seg_col).alias("g")).dropDuplicates()


# ------------------------------------------------------------------ X6
class Vocabulary:
    """A4 + P1 + W1: a prepared vocabulary, shared by the flows that use it."""

    def __init__(self, raw: DataFrame, qualified: bool = True):
        self.rows = with_qualified(vocab_dedupe(raw))
        self.label_col = "vocas" if qualified else "strLabel"
        self.chunk_rows, self.n_chunks = vocab_chunks(self.rows)
        self.chunks = written(chunk_table(self.chunk_rows, self.label_col), "chunks")
        self.blocks = written(word_blocks(self.chunk_rows), "word-blocks")
        self.accepted = written(accepted_labels(self.chunk_rows, self.label_col), "accepted-labels")


def predict(texts: DataFrame, vocabulary: Vocabulary, classifier=None, id_col: str = "media_seg") -> DataFrame:
    """J5 + X1 + F6 + A5: per text, the accumulated list of accepted labels; texts
    that matched nothing still get a record (empty list)."""
    if classifier is None:
        return lexical_predictions(texts, vocabulary.accepted, vocabulary.blocks, id_col)
    # an external model answers differently on a re-run: write its answers once
    resp = written(plugin_response(texts, vocabulary.chunks, vocabulary.n_chunks, classifier, id_col=id_col), "answers")
    return collect_predictions(resp.select(id_col, "chunk_id", parse_response().alias("labels")), id_col)


def records(texts: DataFrame, vocabulary: Vocabulary, classifier=None, id_col: str = "media_seg") -> DataFrame:
    """Predictions with their vocabulary rows, one record per text."""
    if classifier is None:
        return lexical_records(texts, vocabulary.accepted, vocabulary.blocks, id_col)
    return resolve_entities(predict(texts, vocabulary, classifier, id_col), vocabulary.rows, vocabulary.label_col, id_col)


def index_flow(texts: DataFrame, vocabulary: Vocabulary, classifier=None, id_col: str = "media_seg") -> DataFrame:
    """Texts -> predictions -> entities -> quads."""
    if classifier is not None:
        return index_quads(records(texts, vocabulary, classifier, id_col), id_col)
    hits = lexical_hits(texts, vocabulary.accepted, vocabulary.blocks, id_col).where(F.col("entity").isNotNull())
    return hits.select(F.col(id_col).alias("s"), F.col("uriclass").alias("p"), F.col("entity").alias("o"),
                       F.col(id_col).alias("g")).dropDuplicates()
