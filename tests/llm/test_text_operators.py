"""Language ID, licence scan, fingerprints and line dedup against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from helpers import empty, frame, odd, odd_rows, words
from pyspark.sql import functions as F

from quadrant.llm import language, licences, lines, syncmers

SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- 1
def test_language_held_out(spark):
    from quadrant.llm.queries import op1_language
    got = op1_language(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id")
    held = got.filter("held_out")
    assert held.count() > 20 and held.filter("lang = lang_pred").count() >= 0.97 * held.count()
    assert got.filter("score < 0 or score > 1").count() == 0 and got.filter("rejected").count() <= 2


def test_language_odd_rows(spark):
    got = language.identify(odd(spark), F.lit(True), keep=("doc_id", "text", "size")).collect()
    assert len(got) == len(odd_rows())
    for r in got:
        has_letter = any(c.isalpha() for c in r.text or "")
        assert (r._lid_lang == "und") == (not has_letter) and (r._lid_score == 0.0 or has_letter) and (r._lid_rejected or has_letter)
    assert {r._lid_lang for r in got if r.doc_id and r.doc_id >= 10} == {"en", "fr"}
    assert language.identify(empty(spark), F.lit(True)).count() == 0
    nobody = language.identify(odd(spark), F.lit(False)).collect()
    assert {r._lid_lang for r in nobody} == {"und"} and len(nobody) == len(got)


def test_kneser_ney_against_definition(spark):
    """The hash tables give the probabilities of interpolated Kneser-Ney written
    out over strings."""
    rng = random.Random(3)
    texts = [words(rng, 40, "abc") for _ in range(6)]
    models = language.fit(frame(spark, [(i, t, "x", "s") for i, t in enumerate(texts)]).select("text", "lang"))
    n = language.ORDER
    counts = [Counter() for _ in range(n + 1)]
    for word in " ".join(texts).split():
        marked = "^" + word + "$"
        for i in range(1, len(marked)):
            for k in range(1, n + 1):
                if i - k + 1 >= 0:
                    counts[k][marked[i - k + 1:i + 1]] += 1
    used = {n: dict(counts[n])}
    for k in range(n - 1, 0, -1):
        before = defaultdict(set)
        for g in counts[k + 1]:
            before[g[1:]].add(g[0])
        used[k] = {g: c if g[0] == "^" and k > 1 else len(before[g]) or 1 for g, c in counts[k].items()}
    total, types, cut = defaultdict(float), defaultdict(int), {}
    for k in used:
        once, twice = (sum(c == x for c in used[k].values()) for x in (1, 2))
        cut[k] = min(0.95, max(0.1, (once + 0.5) / (once + 2 * twice + 1)))
        for g, c in used[k].items():
            total[k, g[:-1]] += c
            types[k, g[:-1]] += 1

    def p(history, char):
        k = len(history) + 1
        below = p(history[1:], char) if k > 1 else 1 / language.CHARACTERS
        if (k, history) not in total:
            return below
        c = used[k].get(history + char, 0)
        return (max(c - cut[k], 0) + cut[k] * types[k, history] * below) / total[k, history]
    for word in ["abca", "ccb", "a", "zab", "bbbbbb"]:
        marked = "^" + word + "$"
        want = sum(math.log(p(marked[max(0, i - n + 1):i], marked[i])) for i in range(1, len(marked)))
        h, size = models.texts([word])
        assert size[0] == len(word) + 1 and abs(-h[0, 0] * size[0] - want) < 1e-4
    assert abs(sum(p("^a", c) for c in "abc$") + (language.CHARACTERS - 4) * p("^a", "?") - 1) < 1e-6


def test_language_model_of_any_size_is_whole(spark):
    """A model too large to broadcast gives the same scores, with few labels or many."""
    rng = random.Random(4)
    rows = odd_rows() + [(1000 + i, words(rng, 30, "abcdefgh" if i % 3 else "efghijkl"), f"x{i % 25}", "s") for i in range(100)]
    df = frame(spark, rows)

    def results(most):
        out = language.identify(df, F.lit(True), max_grams=most).collect()
        return sorted((r.doc_id or 0, r._lid_lang, round(r._lid_entropy, 6), round(r._lid_score, 6), r._lid_rejected, r._lid_size) for r in out)
    assert isinstance(language.fit(df.filter("text is not null and lang is not null").select("text", "lang"), 50), language.Tables)
    whole = results(1 << 30)
    assert results(50) == whole and len(whole) == len(rows) and len({r[1] for r in whole}) > 10


# ---------------------------------------------------------------- 2
@pytest.mark.parametrize("text,rpn,names,level", [
    ("MIT", ["mit"], ["mit"], "permissive"),
    ("MIT OR GPL-3.0-only", ["mit", "gpl-3.0-only", "or"], ["gpl-3.0-only", "mit"], "permissive"),
    ("MIT AND GPL-3.0-only", ["mit", "gpl-3.0-only", "and"], ["gpl-3.0-only", "mit"], "copyleft"),
    ("a or b and c", ["a", "b", "c", "and", "or"], ["a", "b", "c"], "permissive"),
    ("(a or b) and c", ["a", "b", "or", "c", "and"], ["a", "b", "c"], "permissive"),
    ("GPL-2.0 WITH Classpath-exception-2.0", ["gpl-2.0", "classpath-exception-2.0", "with"], ["gpl-2.0 with classpath-exception-2.0"], "weak-copyleft"),
])
def test_expressions(text, rpn, names, level):
    assert licences.to_rpn(text) == rpn
    got, n = licences.evaluate(rpn)
    assert (got, licences.LEVELS[n]) == (names, level)


@pytest.mark.parametrize("text", ["", "and", "MIT MIT", "(MIT", "MIT)", "MIT or", "()", "MIT or or GPL", "MIT & GPL",
                                  "(MIT or GPL-2.0) with x", "mit with (a and b)", "mit with x with y", "mit with", "with x"])
def test_ill_formed_expressions(text):
    assert licences.to_rpn(text) is None


@pytest.mark.parametrize("expression,labels", [
    ("GPL-2.0+ WITH Classpath-exception-2.0 OR MIT", ["gpl-2.0+ with classpath-exception-2.0", "mit"]), ("LicenseRef-Acme AND Zlib", ["licenseref-acme", "zlib"]),
    ("whatever", None), ("MIT OR whatever", None), ("GPL-2.0 WITH MIT", None), ("Classpath-exception-2.0", None),
    ("(MIT or GPL-2.0) with Classpath-exception-2.0", None), ("MIT with (a and b)", None), ("MIT and", None),
])
def test_tags_name_known_licences(expression, labels):
    _, hits, expressions = licences.scan(licences.automaton(), f"# SPDX-License-Identifier: {expression}\n")
    found = [(h["kind"], h["label"]) for h in hits if h["kind"] in ("tag", "unparsed")]
    assert found == ([("unparsed", None)] if labels is None else [("tag", x) for x in labels])
    assert [e["licences"] for e in expressions] == ([] if labels is None else [labels])


def test_licences_against_brute_force(spark):
    rng = random.Random(5)
    parts = ["GNU General-Public\nLicense", "apache license, version 2.0", "CC BY", "cc", "by", "MIT License", "mit", "license", "été", "x1"]
    rows = [(i, " ".join(rng.choice(parts) for _ in range(rng.randint(0, 12))), "en", "s") for i in range(60)] + odd_rows()
    rows.append((99, "// SPDX-License-Identifier: (MIT OR Apache-2.0)\ncode\n# SPDX-License-Identifier: MIT &\n", "en", "s"))
    got = licences.scan_licences(frame(spark, rows, clash=True)).collect()
    assert len(got) == len(rows)
    want = Counter()
    for i, text, _, _ in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        hits = sorted((j, label) for phrase, label in licences.BASE.items() for j in range(len(w))
                      if w[j:j + phrase.count(" ") + 1] == phrase.split())
        want[i, len(w), tuple(hits)] += 1
    assert want == Counter((r.doc_id, r.n_words, tuple(sorted((h.word, h.label) for h in r.hits if h.kind == "base"))) for r in got)
    tagged = next(r for r in got if r.doc_id == 99)
    assert [e.licences for e in tagged.expressions] == [["apache-2.0", "mit"]] and [h.kind for h in tagged.hits].count("unparsed") == 1
    assert licences.scan_licences(empty(spark)).count() == 0


# ---------------------------------------------------------------- 3
def _hash(b: bytes) -> int:
    x = xxhash.xxh64_intdigest(b, seed=42)
    return x - (1 << 64) if x >> 63 else x


def _sketch(raw: bytes) -> list[int]:
    k, s = syncmers.K, syncmers.S
    inner = [_hash(raw[i:i + s]) for i in range(len(raw) - s + 1)]
    found = set()
    for i in range(len(raw) - k + 1):
        window = inner[i:i + k - s + 1]
        if min(window) in (window[0], window[-1]):
            found.add(_hash(raw[i:i + k]))
    return sorted(found)[:syncmers.SIZE] or [_hash(raw)]


def test_fingerprints_against_brute_force(spark):
    rng = random.Random(9)
    rows = [(i * 3, words(rng, rng.randint(0, 80), "aéb c"), "en", "s") for i in range(40)]
    rows += [(500 + i, "x" * i, "en", "s") for i in range(1, 16)] + [(600, words(rng, 3000), "en", "s"), (601, None, "en", "s"), (602, "", "en", "s")]
    got = {r.doc_id: r for r in syncmers.fingerprint_edits(frame(spark, rows, clash=True)).collect()}
    order = sorted(rows, reverse=True, key=lambda r: r[0])
    assert len(got) == len(rows)
    for (i, text, *_), (_, after, *_) in zip(order, [*order[1:], order[0]], strict=True):
        text, after = text or "", after or ""
        m = len(text) // 3
        edited = text[:len(text) - m] + after[:m]
        r = got[i]
        assert (r.n_chars, r.edited) == (len(text), edited)
        assert r.own == _sketch(text.encode()) and r.other == _sketch(edited.encode()) and r.next_own == _sketch(after.encode())


def test_fingerprints_odd_tables(spark):
    got = syncmers.fingerprint_edits(odd(spark)).collect()
    assert len(got) == len(odd_rows()) and all(r.edited is not None and r.next_own for r in got)
    one = syncmers.fingerprint_edits(frame(spark, [(1, "abcdef", "en", "s")])).collect()
    assert [r.edited for r in one] == ["abcdab"]
    assert syncmers.fingerprint_edits(empty(spark)).count() == 0


# ---------------------------------------------------------------- 4
def _deduped(rows, least):
    spread, first = defaultdict(set), {}
    parsed = [(i, s, t) for i, t, _, s in rows]
    for i, s, t in parsed:
        for j, line in enumerate((t if t is not None else "").split("\n")):
            line = line.strip(" \t\r\x0b\x0c")
            if line:
                spread[line].add(s)
                at = (i is not None, i or 0, j)
                first[line] = min(first.get(line, at), at)
    out = Counter()
    for i, _, t in parsed:
        if t is None:
            out[i, None] += 1
            continue
        keep = [x for j, x in enumerate(t.split("\n")) if len(spread.get(x.strip(" \t\r\x0b\x0c"), ())) < least
                or first[x.strip(" \t\r\x0b\x0c")] == (i is not None, i or 0, j)]
        out[i, "\n".join(keep)] += 1
    return out


def test_line_dedup_against_brute_force(spark):
    rng = random.Random(11)
    pool = [words(rng, 4) for _ in range(12)] + ["", "  ", "\t" + "home page "]
    rows = [(i, "\n".join(rng.choice(pool if rng.random() < 0.7 else [words(rng, 5)]) for _ in range(rng.randint(0, 9))), "en",
             rng.choice([f"s{k}" for k in range(14)] + [None])) for i in range(80)] + odd_rows()
    for least in (2, 9, 12, 15):
        got = lines.dedup_lines(frame(spark, rows, clash=True), min_sites=least)
        assert Counter((r.doc_id, r.text) for r in got.collect()) == _deduped(rows, least)
        assert set(frame(spark, rows, clash=True).columns) <= set(got.columns)
    assert lines.dedup_lines(empty(spark)).count() == 0


def test_line_dedup_of_repeated_ids(spark):
    """A place is kept for the line that is first there, not for another text of that id."""
    rows = [(1, "LL\nq1", "en", "s1"), (1, "MM\nq2", "en", "s2"), (0, "MM", "en", "s3"), (2, "LL", "en", "s4")]
    got = Counter((r.doc_id, r.text) for r in lines.dedup_lines(frame(spark, rows), min_sites=2).collect())
    assert got == Counter({(1, "LL\nq1"): 1, (1, "q2"): 1, (0, "MM"): 1, (2, ""): 1})


def test_digest_of_edited_text(spark):
    from quadrant.llm.queries import op3_syncmers
    r = op3_syncmers(spark, SF).orderBy("doc_id").first()
    texts = [x.text for x in spark.read.parquet(f"{SF}/documents.parquet").orderBy(F.desc("doc_id")).collect()]
    last, top = texts[-1], texts[0]
    m = len(last) // 3
    assert r.edited_sha256 == hashlib.sha256((last[:len(last) - m] + top[:m]).encode()).hexdigest()
    assert 0 <= r.near_next <= r.near_edited <= 1 and np.isfinite(r.near_edited)


def test_language_calibrates_on_every_row(spark):
    """Quantiles as numpy has them and a curve from all rows, however many."""
    import numpy as np
    n = 30_000
    rows = spark.range(n).select(F.lit("en").alias("lang"), F.when(F.col("id") % 10 == 0, "fr").otherwise("en").alias("lang_pred"),
                                 (F.floor(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / 64) / 5000).alias("cross_entropy"),
                                 (F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000).alias("lead"), F.when(F.col("id") % 3 == 0, 5.0).otherwise(300.0).alias("size"))
    got, data = language.Calibration(rows), rows.toPandas()
    data = data[data.lang_pred == data.lang]
    for band, size in ((2, 5.0), (8, 300.0)):
        high = np.quantile(data.cross_entropy[data["size"] == size], language.REJECT_QUANTILE)
        assert abs(dict(((lang, b), x) for lang, b, x in got.limits)["en", band] - high - language.REJECT_SLACK - 4 / 2 ** (band / 2)) < 1e-9
    x = np.minimum(rows.toPandas().lead * np.sqrt(rows.toPandas()["size"]), 60)
    right = 1 / (1 + np.exp(-(got.curve[0] + got.curve[1] * x)))
    assert abs(right.mean() - 0.9) < 1e-3  # the fit's mean is the share that is right
