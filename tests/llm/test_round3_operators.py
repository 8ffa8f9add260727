"""Suffix dedup, tokenizer alignment and conversation repair against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import product

import pytest
from helpers import empty, frame, odd, odd_rows, words

from quadrant.llm import alignment, conversations, suffixes


# ---------------------------------------------------------------- 13
def initial_of(code):
    return code.lower()


def brute(codes):
    """Cheapest edits of a row of codes, by trying all labels on each state of the pattern."""
    follow = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    best = {0: (0, "")}

    def offer(table, state, value):
        if state not in table or value < table[state]:
            table[state] = value

    def inserts(table):
        out = dict(table)
        for _ in range(4):
            for state, (cost, text) in list(out.items()):
                for who in "ua":
                    if who in follow[state]:
                        offer(out, follow[state][who], (cost + 5, text + "I"))
        return out
    for code in codes:
        new = {}
        for state, (cost, text) in inserts(best).items():
            offer(new, state, (cost + 2, text + "D"))
            if code == "x":
                continue
            more = 5 if code.isupper() else 0
            if code.lower() in follow[state]:
                offer(new, follow[state][code.lower()], (cost + more, text + "K"))
            for who in "ua":
                if who in follow[state]:
                    offer(new, follow[state][who], (cost + more + 1, text + "R"))
        best = new
    return min(v for s, v in inserts(best).items() if s in (0, 3))


def own(codes, cut=None):
    """The operator's answer: as one block, or as pieces of `cut` rows."""
    parts = [codes[i:i + cut] for i in range(0, len(codes), cut)] if cut else [codes]
    found = conversations.summary_of([conversations.combined([conversations.summary(p) for p in parts], e) for e in conversations.STATES])
    cost, exit_ = conversations.ending(*found)
    path = conversations.combined([conversations.summary(p) for p in parts], 0).path(exit_)
    at, out = 0, ""
    for part, (_, to) in zip(parts, path, strict=True):
        out += "".join(conversations.edits(part, at, to))
        at = to
    return cost, out + "I" * conversations.TAIL[exit_]


def test_viterbi_against_brute_force():
    rng = random.Random(5)
    for n in range(5):
        for codes in product("xsuaoU", repeat=n):
            assert own("".join(codes)) == brute("".join(codes)), codes
    for _ in range(300):
        codes = "".join(rng.choice("xsuaoSUAO" if rng.random() < 0.4 else "ua") for _ in range(rng.randint(1, 80)))
        want = brute(codes)
        assert own(codes) == want and own(codes, rng.randint(1, 7)) == want


def test_survivors_stay_few():
    """Edits are emitted as soon as the survivors agree; ties that last keep their suffix."""
    found = conversations.Survivors(0)
    for code in "ua" * 500:
        found.step(conversations.MOVES[code])
    assert len(found.emitted) > 950
    long = conversations.solve("o" * 3000, 0)
    assert sum(len(long.suffix(node)) for _, node in long.best.values()) + len(long.emitted) >= 3000


def brute_conversations(rows):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv]
        show = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        groups[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, found in groups.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        seen, codes, faults = set(), "", Counter()
        for _, role, text in found:
            bare = text.strip(" \t\n\x0b\x0c\r")
            kind = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[kind] += 1
            code = role[:1] if role[:1] in ("s", "u", "a") else "o"
            codes += "x" if kind in ("blank", "duplicate") else code.upper() if kind else code
        cost, audit = brute(codes)
        lines, state, i = [], 0, 0
        for edit in audit:
            if edit != "I":
                _, role, text = found[i]
                i += 1
            if edit == "D":
                continue
            who = "assistant" if state == 2 else "user"
            lines.append(f"{who}:" if edit == "I" else f"{who}:{text}" if edit == "R" else f"{role}:{text}")
            state = 1 if edit == "K" and role[0] == "s" else 3 if state == 2 else 2
        turns = {r[0] for r in found if r[0] is not None}
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults["blank"], faults["duplicate"], faults["truncated"],
                     sum(x[1][:1] + y[1][:1] not in ("su", "ua", "au") for x, y in zip(found, found[1:], strict=False)), cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def some_conversations():
    rng = random.Random(11)
    rows = [(None, 1, "user", "Hi."), (None, None, "assistant", "Oh?"), (2, None, None, "a."), (2, None, None, None), (3, 5, "user", None), (3, 9, "", "x."),
            (4, -3, "system", "\t \n"), (5, 1, "system", "Only this."), (6, 1, "unknown", "W" * 100_000), (6, 2, "Über", "é!")]
    for conv in range(10, 60):
        roles = ["system"] * (rng.random() < 0.3) + ["user", "assistant"] * rng.randint(0, 6)
        for turn, role in enumerate(roles):
            if rng.random() < 0.2:
                role = rng.choice(["user", "assistant", "system", "tool"])
            rows.append((conv, turn * rng.choice([1, 1, 1, 2]) if rng.random() > 0.05 else None, role, words(rng, 3) + rng.choice([".", "!", "", " .\n"])))
    rows += [(77, t, "user" if t % 2 else "assistant", "same." if t % 5 else f"t {t}." if t % 3 else f"cut {t}") for t in range(1700)]  # spans blocks
    seen = set()
    return [r for r in rows if not ((r[0], r[1]) in seen or seen.add((r[0], r[1])))]  # the order of equal turns is the operator's own


def run_conversations(spark, rows, tmp_path, extra=()):
    from quadrant.llm.queries import op13_conversations
    schema = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame([(*r, *["x"] * len(extra)) for r in rows], schema + "".join(f", {c} string" for c in extra))
    df.repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    return op13_conversations(spark, str(tmp_path))


def test_conversations_against_brute_force(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(conversations, "BLOCK", 64)
    monkeypatch.setattr(conversations, "FAN", 16)  # three levels
    rows = some_conversations()
    got = {r[0]: tuple(r[1:]) for r in run_conversations(spark, rows, tmp_path, ("pos", "blk", "ck", "blank")).collect()}
    assert got == brute_conversations(rows)


def test_conversations_repeated_and_empty(spark, tmp_path):
    rows = [(1, 1, "user", "Hello."), (1, 2, "assistant", "Yes.")] * 3 + [(8, 0, "user", "x")]
    got = {r.conv_id: r for r in run_conversations(spark, rows, tmp_path / "a").collect()}
    assert got[1].audit.count("D") == got[1].duplicate == 4 and got[1].gaps == 0
    assert run_conversations(spark, [], tmp_path / "b").count() == 0


def test_conversations_of_the_table(spark):
    from quadrant.llm.queries import op13_conversations
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {r[0]: tuple(r[1:]) for r in op13_conversations(spark, sf).collect()} == brute_conversations(rows)


# ---------------------------------------------------------------- 12
@pytest.fixture(scope="module")
def tokenizers_ab():
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def brute_alignment(rows, tools):
    """Groups by comparing byte offsets one by one; counts by a second reading."""
    from tokenizers.decoders import ByteLevel as Decoder  # noqa: F401
    a, b = tools
    letters = {c: i for i, c in enumerate(__import__("quadrant.llm.bpe", fromlist=["x"]).byte_letters())}

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode()
    found, counts = [], Counter()
    for doc, text in rows:
        groups = []
        if text:
            one = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
            two = [(i, piece(i)) for i in b.encode(text)]
            if b"".join(x for _, x in one) == b"".join(x for _, x in two) == (" " + text).encode():
                ends = [set(), set()]
                for side, tokens in enumerate((one, two)):
                    at = 0
                    for _, raw in tokens:
                        at += len(raw)
                        ends[side].add(at)
                for stop in sorted(ends[0] & ends[1]):
                    groups.append(([], []))
                    for side, tokens in enumerate((one, two)):
                        while tokens and (groups[-1][side] == [] or at_[side] < stop):
                            if not groups[-1][side]:
                                at_ = {0: at_[0], 1: at_[1]} if len(groups) > 1 or side else {0: 0, 1: 0}
                            i, raw = tokens.pop(0)
                            groups[-1][side].append(i)
                            at_[side] += len(raw)
        found.append((doc, groups))
        counts.update((g[0][-1], g[1][-1]) for g in groups)
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    out = []
    for doc, groups in found:
        links = [(g[0][-1], g[1][-1]) for g in groups]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links),
                    sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return Counter(out)


ALIGNED = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_alignment_against_brute_force(spark, tokenizers_ab):
    import public_tokenizers
    rows = odd_rows() + [(90, "a▁b", "en", "s"), (91, "x\0y  z\n\n\t ", "en", "s"), (92, "<s> </s> <unk> <0x41> <|endoftext|>", "en", "s"),
                         (93, "İẞ ﬁ  　x \U0001F468‍\U0001F469", "en", "s"), (94, " lead", "en", "s"), (95, " ", "en", "s")]
    rows = [r for r in rows if not (r[1] and len(r[1]) > 20_000)] + [(96, words(random.Random(1), 4000), "en", "s")]
    for slab in (alignment.SLAB_BYTES, 2000):
        got = alignment.align(frame(spark, rows, clash=True), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), slab_bytes=slab)
        assert Counter(tuple(r) for r in got.select(*ALIGNED).collect()) == brute_alignment([(r[0], r[1]) for r in rows], tokenizers_ab)


def test_alignment_of_the_table(spark, tokenizers_ab):
    from quadrant.llm.queries import op12_alignment
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = op12_alignment(spark, "/root/testdata/sf0.001").select(*ALIGNED).collect()
    assert Counter(tuple(r) for r in got) == brute_alignment([tuple(r) for r in rows], tokenizers_ab)


def test_alignment_odd_and_empty(spark):
    import public_tokenizers
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    got = {r.doc_id: r for r in alignment.align(odd(spark), *paths).collect()}
    assert got[1].n_a == got[2].n_b == 0 and got[1].groups_sha256 == "" and got[8].n_groups > 0
    assert alignment.align(empty(spark), *paths).count() == 0


# ---------------------------------------------------------------- 11
def brute_repeats(rows):
    """Bytes covered by a 50-byte string that also starts in a document of a smaller id."""
    last = float("inf")
    raw = [(last if i is None else i, (t or "").encode()) for i, t in rows]
    least = {}
    for i, text in raw:
        for p in range(len(text) - 49):
            w = text[p:p + 50]
            if i < least.get(w, last):
                least[w] = i
    out = []
    for (i, text), (doc, _) in zip(raw, rows, strict=True):
        gone, spans = bytearray(len(text)), []
        for p in range(len(text) - 49):
            if least.get(text[p:p + 50], last) < i:
                gone[p:p + 50] = b"\1" * 50
        for p in range(len(text)):
            if gone[p]:
                if p and gone[p - 1]:
                    spans[-1] = (spans[-1][0], p + 1)
                else:
                    spans.append((p, p + 1))
        out.append((doc, len(text), tuple(spans), bytes(c for c, g in zip(text, gone, strict=True) if not g)))
    return Counter(out)


def own_repeats(df, **more):
    return Counter((r[0], r.n_bytes, tuple((s.start, s.end) for s in r.spans), bytes(r.kept)) for r in suffixes.remove_repeats(df, **more).collect())


def repeats():
    rng = random.Random(4)
    passage = words(rng, 60)
    edge = words(rng, 20)[:60]
    rows = [(i, words(rng, 10) + passage[:rng.randint(40, 400)] + words(rng, 8)) for i in range(100, 140)]
    rows += [(200 + i, edge[i:i + 50 - i % 3] + "!" * (i % 4)) for i in range(10)]  # exactly a window, and just less
    rows += [(300, "ab" * 60), (301, "ab" * 60), (302, "ba" * 26), (299, "a" * 49), (303, "a" * 51), (304, "a" * 300)]
    near = words(rng, 80)
    for i in range(30):  # near copies
        cut = rng.randrange(len(near))
        rows.append((400 + i, near[:cut] + rng.choice("xyz") + near[cut + 1:]))
    line = "this very common line stands in many documents, "
    rows += [(500 + i, words(rng, 3) + line + words(rng, 3)) for i in range(60)]  # a hot gram in different surroundings
    rows += [(None, near), (None, passage + "é漢" * 40), (7, "é漢" * 40), (430, near), (430, passage)]
    return rows


@pytest.mark.parametrize("hot", [suffixes.HOT, 3])
def test_repeats_against_brute_force(spark, hot):
    rows = [(i, t) for i, t, _, _ in odd_rows() if not t or len(t) < 20_000] + repeats()
    df = frame(spark, [(i, t, "en", "s") for i, t in rows], clash=True).repartition(5)
    assert own_repeats(df, hot=hot) == brute_repeats(rows)


def test_repeats_in_blocks(monkeypatch):
    """Anchors don't depend on how a slab's bytes are cut."""
    rows = repeats()
    whole = suffixes.Slab([i for i, _ in rows], [t for _, t in rows])
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", 333)
    cut = suffixes.Slab([i for i, _ in rows], [t for _, t in rows])
    assert (whole.at == cut.at).all() and (whole.key == cut.key).all() and len(whole.at) > 100


def test_multikey_order():
    import numpy as np
    rng = np.random.default_rng(3)
    words_ = rng.integers(0, 3, (500, 6)).astype(np.uint64)
    order, group = suffixes.multikey_order(words_)
    found = [tuple(x) for x in words_[order].tolist()]
    assert found == sorted(found) and len(set(found)) == group[-1] + 1
    assert all((x == y) == (a == b) for x, y, a, b in zip(found, found[1:], group, group[1:], strict=False))


def test_repeats_of_the_table(spark):
    from quadrant.llm.queries import op11_suffix_dedup
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    want = Counter((d, n, sum(e - s for s, e in spans), len(spans), hashlib.sha256(kept).hexdigest()) for d, n, spans, kept in brute_repeats(rows).elements())
    assert Counter(tuple(r) for r in op11_suffix_dedup(spark, "/root/testdata/sf0.001").collect()) == want


def test_repeats_odd_and_empty(spark):
    got = suffixes.remove_repeats(odd(spark)).collect()
    assert len(got) == len(odd_rows()) and suffixes.remove_repeats(empty(spark)).count() == 0
