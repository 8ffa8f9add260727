"""Jaccard join, nearest neighbours, token files, URL filter, BPE, mixing and the
pipeline against brute force, the tokenizers library and exact round trips."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import empty, frame, odd, odd_rows, words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quadrant.llm import bpe, common, dac, jaccard, language, mixing, urls, vptree
from quadrant.llm.common import batches_of, hashed_sample

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


def test_pieces_of_long_texts():
    rng = random.Random(13)
    texts = [None, "", words(rng, 300), "y" * 500, "a " * 100, words(rng, 3), "b\n" + "z" * 99 + " c"]
    for limit in (1, 7, 50, 10**6):
        joined = ["" for _ in texts]
        for numbers, parts in batches_of(texts, limit):
            assert len(numbers) == len(parts)
            for i, part in zip(numbers, parts, strict=True):
                joined[i] += part
                assert len(part) <= limit + max(map(len, re.split(r"\s", part))) + 1
        assert joined == [t or "" for t in texts]


def test_long_texts_give_the_same_in_pieces(monkeypatch):
    rng = random.Random(14)
    texts = [words(rng, 400), None, words(rng, 2), "it's " + "q" * 300 + " é́ <|endoftext|> a", words(rng, 50)]
    encoder = _encoder()[0]

    def results():
        models_words = sorted(language.count_grams([t or "" for t in texts]).tolist())
        return [x.tolist() for x in jaccard.shingle_sets(texts, 4)], [x.tolist() for x in encoder.encode(texts)], models_words
    whole = results()
    for module in (jaccard, bpe, language):
        monkeypatch.setattr(module, "batches_of", lambda t: batches_of(t, 40))
    assert results() == whole


class _Task:
    """Stands for a table and keeps the function that its tasks run."""

    def select(self, *_):
        return self

    def mapInArrow(self, run, schema):  # noqa: N802
        self.run = run
        return self

    def groupBy(self, *_):  # noqa: N802
        return self

    def agg(self, *_):
        return self

    def applyInArrow(self, run, schema):  # noqa: N802
        return self


def test_a_task_holds_few_counts_and_gives_its_memory_back(spark, monkeypatch):
    rng = random.Random(15)
    back = []
    monkeypatch.setattr(common, "give_back", lambda: back.append(1))
    monkeypatch.setattr(language, "HELD_GRAMS", 400)
    batches = [pa.RecordBatch.from_pydict({"text": [words(rng, 60), None, words(rng, 60)], "lang": ["en", "de", rng.choice(["de", "fr"])]}) for _ in range(12)]
    drawn, task = [], _Task()
    language.gram_counts(task)
    out = task.run(drawn.append(b) or b for b in batches)
    sent = [next(out)]
    assert len(drawn) < len(batches)  # counts leave before the task has read all
    got, want = Counter(), Counter()
    for part in [*sent, *out]:
        for r in part.to_pylist():
            got[tuple(r[c] for c in ("lang", "k", "h", "context", "suffix", "begins"))] += r["n"]
    for b in batches:
        for lang, text in zip(b["lang"].to_pylist(), b["text"].to_pylist(), strict=True):
            for k, h, context, suffix, begins, n in language.count_grams([text or ""]).tolist():
                want[lang, k, h, context, suffix, begins] += n
    assert got == want and len(back) == 1
    jaccard.counted_shingles(task, 3, "text", 4)
    assert len(list(task.run(iter(batches)))) == 1 and len(back) == 2


def test_freed_memory_goes_back_to_the_system():
    def resident():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096 >> 20
    kept = []

    def run(batches):
        for b in batches:
            parts = [np.ones(12_000) for _ in range(2_500)]  # 96 kB each, below malloc's border for maps of their own
            kept.append(parts[-1])  # lies behind what is freed
            del parts
            yield b
    batch = pa.RecordBatch.from_pydict({"a": [1]})
    before = resident()
    assert list(common.lean(run)(iter([batch]))) == [batch]
    assert resident() - before < 100


# ---------------------------------------------------------------- 5
def _components(rows, n, num, den):
    sets, home = [], defaultdict(list)
    for _, text, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(w[j:j + n]) for j in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
        for g in sets[-1]:
            home[g].append(len(sets) - 1)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    shared = Counter((a, b) for at in home.values() for k, a in enumerate(at) for b in at[k + 1:])
    for (a, b), both in shared.items():
        if den * both >= num * (len(sets[a]) + len(sets[b]) - both):
            parent[find(a)] = find(b)
    least = defaultdict(list)
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)].append(r[0])
    return Counter((r[0], len(sets[i]), min(least[find(i)], default=None) if sets[i] else r[0]) for i, r in enumerate(rows))


def near_copies(rng, first_id, copies, length, edits):
    base = words(rng, length).split()
    for i in range(copies):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(length)] = words(rng, 1)
        yield first_id + i, " ".join(w), "en", f"s{i % 5}"


@pytest.mark.parametrize("n,num,den", [(4, 85, 100), (5, 80, 100)])
def test_jaccard_against_brute_force(spark, n, num, den):
    """Small groups, groups larger than the limit for frequent shingles whose
    members lie on both sides of the threshold, and a passage that many share."""
    rng = random.Random(n)
    rows = odd_rows()
    for start, copies, length, edits in ((1000, 70, 60, 3), (2000, 50, 200, 9), (3000, 4, 30, 1), (3100, 3, 9, 1), (4000, 40, 25, 2)):
        rows += near_copies(rng, start, copies, length, edits)
    passage = words(rng, 55)
    rows += [(5000 + i, f"{words(rng, rng.randint(1, 30))} {passage} {words(rng, rng.randint(1, 30))}", "en", "s") for i in range(45)]
    rows += [(6000 + i, rows[50][1].upper(), "en", "s") for i in range(5)]
    got = jaccard.link_components(frame(spark, rows, clash=True), n, num, den)
    assert Counter(map(tuple, got.collect())) == _components(rows, n, num, den)


@pytest.mark.parametrize("n,num,den", [(4, 85, 100), (5, 80, 100), (2, 50, 100)])
def test_jaccard_of_short_texts_with_a_word_more(spark, n, num, den):
    """Short texts and the same with a word appended or prepended, of rare words
    and of shingles that many texts share: the smaller set loses nothing."""
    rng = random.Random(n + 1)
    rows, at = [], 1
    for length in range(1, 16):
        for copies in (1, 12):
            base = words(rng, length)
            for _ in range(copies):
                for text in (base, f"{base} {words(rng, 1)}", f"{words(rng, 1)} {base}", f"{words(rng, 1)} {base} {words(rng, 1)}"):
                    rows.append((at, text, "en", "s"))
                    at += 1
    got = jaccard.link_components(frame(spark, rows), n, num, den)
    assert Counter(map(tuple, got.collect())) == _components(rows, n, num, den)


def test_jaccard_empty_and_bounds(spark):
    assert jaccard.link_components(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        jaccard.link_components(empty(spark), num=40)


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**6), st.integers(30, 600), st.floats(0, 1), st.integers(80, 95))
def test_linked_sets_share_a_signature(seed, size, common, num):
    """Whatever shingles count as frequent, two sets that link share a signature."""
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
    lost = rng.random(len(a)) < rng.random() * 0.12
    b = np.unique(np.concatenate([a[~lost], rng.integers(0, 1 << 63, int(lost.sum() * rng.random())).astype(np.uint64)]))
    both = len(np.intersect1d(a, b))
    if 100 * both < num * (len(a) + len(b) - both) or (len(a) == len(b) == both):
        return
    frequent = {int(x): i + 1 for i, x in enumerate(rng.permutation(np.union1d(a, b))[:int(common * size)])}
    sigs = [set(jaccard.signatures(s, np.array([frequent.get(int(x), 0) for x in s]), num, 100)[0].tolist()) for s in (a, b)]
    assert sigs[0] & sigs[1]


# ---------------------------------------------------------------- 6
def vectors(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(300, 8)) * rng.uniform(0.2, 3, (300, 1))
    rows = [(i, [float(x) for x in v[i]]) for i in range(300)]
    rows += [(1000 + i, rows[5][1]) for i in range(60)]  # one vector, many rows
    rows += [(2000, None), (2001, [0.0] * 8), (2002, [1.0, None] + [0.0] * 6), (2003, [float("nan")] + [1.0] * 7), (2004, [float("inf")] + [1.0] * 7),
             (2005, []), (2020, [1.0, 2.0]), (2040, [2.0, 1.0]), (None, rows[1][1]), rows[7]]
    return rows, spark.createDataFrame([(*r, 0, 0) for r in rows], "vec_id long, embedding array<double>, shard int, q int").repartition(3)


def _nearest(rows, k):
    good = {i: v for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    out = {}
    for q in (i for i in good if i % 20 == 0):
        scores = sorted((-float(np.dot(good[q], v)), i) for i, v in good.items() if i != q and len(v) == len(good[q]))
        out[q] = [(i, round(-s, 9)) for s, i in scores[:k]]
    return {q: x for q, x in out.items() if x}


def test_exact_search_equals_brute_force(spark):
    rows, df = vectors(spark)
    got = defaultdict(list)
    for r in vptree.nearest(df, F.col("vec_id") % 20 == 0, k=20, factor=1.0, shard_rows=90, block_rows=7).orderBy("query_id", "rank").collect():
        assert r.rank == len(got[r.query_id]) + 1
        got[r.query_id].append((r.vec_id, round(r.score, 9)))
    assert dict(got) == _nearest(rows, 20)
    assert vptree.nearest(df.limit(0), F.lit(True)).count() == 0


def test_relaxed_search_recall():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 12))
    ids = np.arange(3000)
    exact = vptree.search(ids, x, ids[:100], x[:100], 10, 1.0)
    near = vptree.search(ids, x, ids[:100], x[:100], 10, 1.3)
    hits = sum(len({m for _, m in a} & {m for _, m in b}) for a, b in zip(exact, near, strict=True))
    brute = x[:100] @ x.T
    np.fill_diagonal(brute[:, :100], -np.inf)
    assert all({m for _, m in a} == set(np.argsort(-row)[:10].tolist()) for a, row in zip(exact, brute, strict=True))
    assert hits >= 0.9 * 1000


# ---------------------------------------------------------------- 7 and 9
@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_codes_give_random_access():
    rng = np.random.default_rng(0)
    for v in (rng.integers(0, 49408, 5000), rng.zipf(1.3, 3000) % 49408, np.zeros(0, int), np.array([0]), np.full(513, 65535), rng.integers(0, 2**32, 700)):
        codes = dac.Codes(bpe.from_bytes(np.frombuffer(bpe.to_file(dac.write_codes(v.astype(np.uint32))), np.uint8)))
        at = rng.integers(0, len(v), 300) if len(v) else np.zeros(0, int)
        assert len(codes) == len(v) and (codes.get(at) == v[at]).all()
        assert (codes.range(0, len(v)) == v).all() and (codes.range(len(v) // 3, len(v) // 2) == v[len(v) // 3:len(v) // 2]).all()


def test_token_files_equal_library(spark, library, monkeypatch):
    rows = odd_rows()
    manifest, folder = dac.store_tokens(odd(spark), PATH, end_id=2)
    got = sorted(map(tuple, dac.read_files(manifest, folder).collect()), key=lambda r: r[1])
    ids = {t: library.encode(t or "", add_special_tokens=False).ids + [2] for _, t, *_ in rows}
    want = Counter((i, len(ids[t]), zlib.crc32(np.array(ids[t], "<u4").tobytes())) for i, t, *_ in rows)
    assert Counter((r[0], r[2], r[3]) for r in got) == want
    assert [r[1] for r in got] == np.cumsum([0] + [r[2] for r in got])[:-1].tolist()
    assert [r[0] for r in got] == sorted([r[0] for r in got], key=lambda x: (x is not None, x or 0))
    manifest, folder = dac.store_tokens(empty(spark), PATH, end_id=2)
    assert manifest.count() == 0 and dac.read_files(manifest, folder).count() == 0


TEXT = st.text(st.sampled_from("ab'stmdrevl 1²é́\n!?-.AÉΣσİ𐐀ﬁ<|>漢 \x1c "), max_size=60)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=4))
def test_encoder_equals_library(texts):
    encoder, library = _encoder()
    ids, at = encoder.encode(texts)
    for i, t in enumerate(texts):
        assert ids[at[i]:at[i + 1]].tolist() == library.encode(t, add_special_tokens=False).ids


def _encoder(made=[]):  # noqa: B006  one for all examples
    if not made:
        vocabulary = bpe.Vocabulary(PATH)
        lexicon = ["a", "ab", "abs", "mess", "less", "é", "!?", "'s", "1"]
        made += [bpe.Encoder(vocabulary, bpe.from_bytes(np.frombuffer(bpe.to_file(bpe.compile_lexicon(lexicon, vocabulary)), np.uint8))),
                 Tokenizer.from_file(PATH)]
    return made


def test_automaton_is_minimal_and_numbers_words():
    ends = ["ing", "ings", "ed", "er", "ers"]
    listed = sorted({p + e for p in ("walk", "talk", "jump", "") for e in ends})
    arcs, final = bpe.minimal_automaton(listed)
    seen, todo = set(), [0]
    while todo:
        s = todo.pop()
        if s not in seen:
            seen.add(s)
            todo += arcs[s].values()

    def right(s):  # the words that a state accepts
        return frozenset([""] if final[s] else []) | {c + w for c, t in arcs[s].items() for w in right(t)}
    assert right(0) == set(listed) and len({right(s) for s in seen}) == len(seen)
    vocabulary = bpe.Vocabulary(PATH)
    encoder = bpe.Encoder(vocabulary, bpe.compile_lexicon(listed, vocabulary))
    points = np.array([ord(c) for w in listed + ["walks", "in"] for c in w], np.uint32)
    stops = np.cumsum([len(w) for w in listed + ["walks", "in"]])
    got = encoder.numbers(points, np.concatenate([[0], stops[:-1]]), stops)
    assert got.tolist() == [*range(len(listed)), -1, -1]


def test_long_words_merge_as_short_ones():
    vocabulary = bpe.Vocabulary(PATH)
    rng = random.Random(4)
    for w in ["".join(rng.choice("abeinorst") for _ in range(n)) for n in (1, 2, 30, 64, 65, 300)] + ["a" * 200]:
        assert vocabulary.merge_all([w, "x"])[0] == vocabulary.merge(w) == Tokenizer.from_file(PATH).encode(w, add_special_tokens=False).ids


def test_bpe_round_trip_equals_library(spark, library):
    rows = odd_rows()
    for most in (0, 7, bpe.MAX_WORDS):  # the lexicon never changes the ids
        out = bpe.decode(bpe.encode(odd(spark), PATH, max_words=most), PATH).collect()
        want = Counter()
        for i, t, *_ in rows:
            e = library.encode(t or "", add_special_tokens=False).ids
            want[i, tuple(e), library.decode(e, skip_special_tokens=False)] += 1
        assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in out) == want
    assert bpe.decode(bpe.encode(empty(spark), PATH), PATH).count() == 0


# ---------------------------------------------------------------- 8
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def test_url_rules(spark):
    cases = [("http://a.example.org/es/1", "a.example.org", "/es/1", "example.org/es/", "block"), ("HTTPS://Example.ORG/en/12?x#y", "example.org", "/en/12", "example.org/en/1", "block"),
             ("http://org/", "org", "/", "org/", "allow"), ("http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
             ("http://a.com/de/", "a.com", "/de/", "com/de/", "block"), ("http://a.com/DE/", "a.com", "/DE/", None, None), ("http://x.org", "x.org", "", None, None),
             ("http://a.org?p=http://b.org/es/", "a.org", "", None, None), ("no url", "", "", None, None), (None, "", "", None, None), ("", "", "", None, None),
             ("http://É.Com/fr/é", "É.com", "/fr/é", "com/fr/", "allow"), ("http://" + "x" * 50000 + ".com/fr/", "x" * 50000 + ".com", "/fr/", "com/fr/", "allow")]
    rows = [(i, c[0], 0.5, "h") for i, c in enumerate(cases)] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, score double, host string").repartition(2)
    got = urls.judge(df, RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        _, host, path, rule, verdict = cases[r.page_id]
        assert (r._url_host, r._url_path, r._url_rule) == (host, path, rule) and 0 <= r._url_score <= 1
        assert r._url_verdict == verdict or verdict is None and r._url_verdict in ("allow", "block")
    assert urls.judge(df.limit(0), RULES).count() == 0
    assert {r._url_verdict for r in urls.judge(df, []).collect()} == {"block"}  # no labels: score 0.5


def test_url_trees_learn(spark):
    rng = random.Random(6)
    pages = [(f"http://{words(rng, 1)}.net/{'win-cash-' + str(rng.randrange(10**9)) if bad else words(rng, 1)}{'?a=1&b=2&c=3' if bad else ''}", int(bad))
             for bad in (rng.random() < 0.4 for _ in range(400))]
    df = spark.createDataFrame(pages, "url string, label int")
    held = spark.createDataFrame(pages[300:], "url string, y int")
    got = urls.judge(held, [], labelled=df.limit(300)).collect()
    assert sum((r._url_verdict == "block") == bool(r.y) for r in got) >= 0.95 * len(got)


def test_url_suffix_statistics_count_all_labels(spark):
    """Hosts whose labelled urls fall outside the training sample are judged by them."""
    rng = random.Random(8)
    hosts = {f"{words(rng, 1)}{i}.net": i % 2 for i in range(120)}
    page = lambda host: f"http://{host}/{words(rng, 1)}/{words(rng, 1)}"
    labelled = spark.createDataFrame([(page(h), y) for h, y in hosts.items() for _ in range(8)], "url string, label int")
    held = spark.createDataFrame([(page(h), y) for h, y in hosts.items()], "url string, y int")
    got = urls.judge(held, [], labelled=labelled, max_train=60).collect()
    assert sum((r._url_verdict == "block") == bool(r.y) for r in got) >= 0.95 * len(got)
    counts = urls.suffix_statistics(urls.with_suffixes(urls.split_url(labelled)).withColumn("_url_y", F.col("label").cast("double")))
    assert {(r._url_s2_k, round(r._url_s2_rate, 9), round(r._url_s2_n, 6)) for r in counts["_url_s2"].collect()} == {
        (h, (8 * y + 1) / 10, round(float(np.log1p(8)), 6)) for h, y in hosts.items()}


def test_url_labels_do_not_leak(spark):
    """A host seen once must not tell its own label: where hosts are all different, the
    trees have to learn the lexical sign, right in 85 % of the urls."""
    rng = random.Random(9)

    def page(i: int) -> tuple[str, int]:
        bad = rng.random() < 0.5
        sign = bad if rng.random() < 0.85 else not bad
        return f"http://{words(rng, 1)}{i}.net/{words(rng, 1)}/{'x?a=1&b=2&c=3' if sign else 'x'}", int(bad)
    labelled = spark.createDataFrame([page(i) for i in range(1000)], "url string, label int")
    held = spark.createDataFrame([page(i) for i in range(1000, 1600)], "url string, y int")
    got = urls.judge(held, [], labelled=labelled).collect()
    assert sum((r._url_verdict == "block") == bool(r.y) for r in got) >= 0.8 * len(got)


def test_url_statistics_out_of_fold(spark):
    rng = random.Random(10)
    rows = [(f"http://{'ab'[rng.random() < 0.7]}.net/{rng.randrange(6)}/{i % 50}", float(rng.random() < 0.4)) for i in range(200)]
    labelled = urls.with_suffixes(urls.split_url(spark.createDataFrame(rows, "url string, _url_y double"))).withColumn("fold", urls.fold_of())
    mine = labelled.select("url", "_url_s2", "_url_p1", "_url_y", "fold").collect()
    out, names = urls.with_suffix_statistics(labelled, urls.suffix_statistics(labelled), F.col("fold"))
    assert set(names) < set(out.columns) and {r.fold for r in mine} == set(range(urls.FOLDS))
    for r in out.collect():
        for key in ("_url_s2", "_url_p1"):
            others = [x._url_y for x in mine if x[key] == r[key] and x.fold != r.fold]
            assert abs(r[f"{key}_rate"] - (sum(others) + 1) / (len(others) + 2)) < 1e-9
            assert abs(r[f"{key}_n"] - np.log1p(len(others))) < 1e-9


def test_hashed_sample(spark):
    df = spark.range(5000).withColumn("key", F.xxhash64("id"))
    few = hashed_sample(df, "key", 1000).collect()
    assert 900 < len(few) < 1100 and max(r.key for r in few) < min(set(r.key for r in df.collect()) - {r.key for r in few})
    copies = df.withColumn("key", F.xxhash64(F.col("id") % 40))
    assert hashed_sample(copies, "key", 1000).count() == 40 and hashed_sample(df.limit(0), "key", 10).count() == 0


def test_entropy(spark):
    got = spark.createDataFrame([("aabb",), ("",), ("a",), ("abcd",)], "u string").select(urls.entropy(F.col("u")).alias("e")).collect()
    assert [round(r.e, 9) for r in got] == [1.0, 0.0, 0.0, 2.0]


# ---------------------------------------------------------------- 10
def _targets(sizes, weights, share, cap):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: float(weights[i % len(weights)]) for i, s in enumerate(names)}
    total, full = share * sum(sizes.values()), {}
    while True:
        rest = {s: (total - sum(full.values())) * w[s] / sum(w[x] for x in names if x not in full) for s in names if s not in full}
        over = {s: cap * sizes[s] for s, t in rest.items() if t > cap * sizes[s]}
        if not over:
            return full | rest
        full |= over


def test_mixing_against_brute_force(spark):
    rng = random.Random(8)
    rows = odd_rows() + [(100 + i, words(rng, rng.randint(0, 50)), "en", rng.choice(["a", "b", "b", "b", "é", "z", "𐐀"])) for i in range(150)]
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += size(t)
    want = _targets(dict(sizes), (3, 1, 2), 1.5, 2.0)
    df = frame(spark, rows, clash=True)
    got = mixing.mix(df).collect()
    assert Counter((r.doc_id, r._mix_size, r.source) for r in got) == Counter((i, size(t), s) for i, t, _, s in rows)
    taken = Counter()
    for r in got:
        assert r._mix_source_size == sizes[r.source] and abs(r._mix_target - want[r.source]) < 1e-6 and 0 <= r._mix_taken <= 2 * r._mix_size
        taken[r.source] += r._mix_taken
    assert all(abs(taken[s] - want[s]) < 1 for s in want)
    again = mixing.mix(df.repartition(5), keep=("doc_id", "source")).collect()
    assert Counter((r.doc_id, r._mix_taken) for r in again) == Counter((r.doc_id, r._mix_taken) for r in got)
    # the rows of the mix hold just those words
    made = Counter()
    for r in mixing.mixed_rows(df).collect():
        made[r.source] += size(r.text)
    assert made == Counter({s: n for s, n in taken.items() if n})
    assert mixing.mix(empty(spark)).count() == 0 and mixing.mixed_rows(empty(spark)).count() == 0
    assert mixing.mix(frame(spark, [(1, None, "en", "s"), (2, " ", "en", None)])).filter("_mix_taken > 0").count() == 0


# ---------------------------------------------------------------- pipeline
def test_pipeline_stages(spark, library):
    import corpus_pipeline as P
    rng = random.Random(12)
    rows = odd_rows() + list(near_copies(rng, 3000, 6, 80, 1))
    rows += [(4000 + i, f"{words(rng, 20)}\nshared line of all sites\n{words(rng, 20)}", "en", f"site{i}") for i in range(12)]
    docs, kept = frame(spark, rows, clash=True), {}
    for name, stage in P.STAGES:
        out = P.written(stage(spark, docs, ""), f"test-{name}")
        if name != P.STAGES[-1][0]:
            assert out.columns == docs.columns
        kept[name] = out.collect()
        docs = out
    ids = {name: Counter(r.doc_id for r in found) for name, found in kept.items()}
    lettered = Counter(i for i, t, *_ in rows if any(c.isalpha() for c in t or ""))
    assert ids["language_id"] == lettered
    assert ids["line_dedup"] == lettered and sum("shared line" in r.text for r in kept["line_dedup"]) == 1
    assert ids["near_duplicates"] == Counter({i: 1 for i in lettered if i is None or not 3000 < i < 3006})
    assert set(ids["mix_sources"]) <= set(ids["near_duplicates"])
    texts = defaultdict(list)
    for r in kept["mix_sources"]:
        texts[r.doc_id].append(library.encode(r.text, add_special_tokens=False).ids)
    for r in kept["encode"]:
        assert list(r.ids) in texts[r.doc_id] and r.n_tokens == len(r.ids)
    assert ids["encode"] == ids["mix_sources"]
    docs = empty(spark)
    for _, stage in P.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0


def test_near_duplicates_by_row(spark):
    """Rows that share an id, or have none, against groups by brute force."""
    import corpus_pipeline as P
    rng = random.Random(8)
    a, b, c, d = (words(rng, 40) for _ in range(4))
    rows = [(3, a, "en", "s"), (7, a, "en", "s"), (7, b, "en", "s"), (7, c, "en", "s"), (None, d, "en", "s"), (None, d, "en", "s"), (None, d, "fr", "t"),
            (None, a + " more", "en", "s"), (None, words(rng, 30), "en", "s"), (-5, c + " x", "en", "s"), (9, "", "en", "s"), (9, "", "en", "s"), (None, None, "en", "s")]

    def shingles(text):
        w = text.split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
    sets = [shingles(t or "") for _, t, *_ in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    want = Counter()
    for g in set(group):
        members = sorted(((r[0] is None, r[0] or 0), r[:2]) for r, x in zip(rows, group, strict=True) if x == g)
        want[members[0][1]] += 1
    got = Counter((r.doc_id, r.text) for r in P.near_duplicates(spark, frame(spark, rows, clash=True), "").collect())
    assert got == want and got[7, b] == 1 and got[None, d] == 1 and got[9, ""] == 2


def test_large_alphabets_stay_small():
    words_ = [chr(0x4E00 + i % 4000) + chr(0x4E00 + (i * 7) % 4000) + chr(0x4E00 + i % 13) for i in range(8000)] + [f"word{i}" for i in range(20_000)]
    made = bpe.compile_lexicon(words_, bpe.Vocabulary(public_tokenizers.path("word_bpe_49k.json")))
    assert sum(a.nbytes for a in made.values()) < 5 << 20


def test_distinct_words():
    from quadrant.llm.segments import distinct_words
    texts = ["a b aa a ab ba", "b " * 500 + "x" * 3000 + " " + "x" * 3000 + " " + "x" * 2999]
    points = np.frombuffer("\n".join(texts).encode("utf-32-le"), "<u4")
    text = "\n".join(texts)
    spans = [m.span() for m in re.finditer(r"\S+", text)]
    starts, ends = np.array([s for s, _ in spans]), np.array([e for _, e in spans])
    first, which = distinct_words(points, starts, ends)
    names = [text[s:e] for s, e in spans]
    assert [names[first[w]] for w in which] == names and len(first) == len(set(names))


def test_queries_run_and_digests(spark, library):
    from quadrant.llm.queries import QUERIES
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op9_bpe"](spark, SF).collect():
        e = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(e) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, e)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(e, skip_special_tokens=False).encode()).hexdigest()
