"""License scans (operator 2): an Aho-Corasick automaton finds identifier tags and
notice phrases in one pass over each whole text; a shunting-yard parser evaluates
the licence expressions (and / or / with) that follow a tag.

Words are the runs of ASCII letters and digits and of any non-ASCII characters,
with A-Z lower-cased; a phrase is found where its words stand consecutively,
whatever separates them. An expression is the rest of the tag's line.

Defined cases: a null or empty text has no words and no hits; a text of any
length is scanned whole, in memory bounded by a few times its size; repeated rows
give repeated results; an ill-formed expression gives a hit of kind `unparsed`
and no licence, and so does one with an id that isn't in the tables of licences and
exceptions (`LicenseRef-...` counts as one, a `+` behind an id as "or later"), or a
`with` that doesn't stand between one licence and one exception; an empty table gives an empty result; only the id and text
columns are read, so any other column may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrant.llm.common import python_ready, slices

#: phrase -> label; fixed by the query's contract.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: phrase -> label: notices that this operator adds.
NOTICES = {
    "all rights reserved": "all-rights-reserved",
    "apache license version 2 0": "apache-2.0",
    "boost software license": "bsl-1.0",
    "bsd 2 clause": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause",
    "bsd license": "bsd",
    "cc by nc": "cc-by-nc",
    "cc by nc nd": "cc-by-nc-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "cc0": "cc0-1.0",
    "eclipse public license": "epl",
    "gnu affero general public license": "agpl",
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "gnu lesser general public license": "lgpl",
    "isc license": "isc",
    "mozilla public license": "mpl",
    "permission is hereby granted free of charge": "mit",
    "public domain": "public-domain",
    "redistribution and use in source and binary forms": "bsd",
}
#: tags whose line goes on with a licence expression.
TAGS = ("spdx license identifier", "license expression")
#: how far a hit of a kind speaks for a licence.
WEIGHT = {"tag": 0.95, "base": 0.9, "notice": 0.8, "unparsed": 0.4}

# fixed values: ids of the public SPDX licence list, lower-cased
LICENCE_IDS = frozenset("""
0bsd afl-2.1 afl-3.0 agpl-1.0 agpl-3.0 agpl-3.0-only agpl-3.0-or-later apache-1.0 apache-1.1 apache-2.0 apsl-2.0
artistic-1.0 artistic-1.0-perl artistic-2.0 blueoak-1.0.0 bsd-1-clause bsd-2-clause bsd-2-clause-patent bsd-3-clause
bsd-3-clause-clear bsd-3-clause-lbnl bsd-4-clause bsl-1.0 busl-1.1 bzip2-1.0.6 cc-by-1.0 cc-by-2.0 cc-by-2.5 cc-by-3.0
cc-by-4.0 cc-by-nc-2.0 cc-by-nc-3.0 cc-by-nc-4.0 cc-by-nc-nd-3.0 cc-by-nc-nd-4.0 cc-by-nc-sa-3.0 cc-by-nc-sa-4.0
cc-by-nd-3.0 cc-by-nd-4.0 cc-by-sa-2.0 cc-by-sa-3.0 cc-by-sa-4.0 cc-pddc cc0-1.0 cddl-1.0 cddl-1.1 cecill-2.0
cecill-2.1 cecill-b cecill-c clartistic cpal-1.0 cpl-1.0 curl ecl-2.0 efl-2.0 elastic-2.0 epl-1.0 epl-2.0 eudatagrid
eupl-1.1 eupl-1.2 fsfap ftl gfdl-1.1 gfdl-1.2 gfdl-1.3 gfdl-1.3-only gfdl-1.3-or-later gpl-1.0 gpl-1.0-only
gpl-1.0-or-later gpl-2.0 gpl-2.0-only gpl-2.0-or-later gpl-3.0 gpl-3.0-only gpl-3.0-or-later hpnd icu ijg imatix imlib2
intel ipa ipl-1.0 isc jasper-2.0 json lgpl-2.0 lgpl-2.0-only lgpl-2.0-or-later lgpl-2.1 lgpl-2.1-only lgpl-2.1-or-later
lgpl-3.0 lgpl-3.0-only lgpl-3.0-or-later libpng libpng-2.0 libtiff lppl-1.3c mit mit-0 mit-cmu mpl-1.0 mpl-1.1 mpl-2.0
ms-pl ms-rl mulanpsl-2.0 ncsa nokia nosl npl-1.1 odbl-1.0 odc-by-1.0 ofl-1.0 ofl-1.1 oldap-2.8 openssl osl-1.0 osl-2.1
osl-3.0 pddl-1.0 php-3.0 php-3.01 postgresql psf-2.0 python-2.0 qpl-1.0 ruby sgi-b-2.0 sissl sleepycat spl-1.0 sspl-1.0
unicode-3.0 unicode-dfs-2016 unlicense upl-1.0 vim w3c wtfpl x11 xfree86-1.1 zend-2.0 zlib zpl-2.0 zpl-2.1
""".split())
EXCEPTION_IDS = frozenset("""
389-exception autoconf-exception-2.0 autoconf-exception-3.0 bison-exception-2.2 bootloader-exception
classpath-exception-2.0 clisp-exception-2.0 ecos-exception-2.0 font-exception-2.0 freertos-exception-2.0
gcc-exception-2.0 gcc-exception-3.1 gnu-javamail-exception gpl-3.0-linking-exception i2p-gpl-java-exception
libtool-exception linux-syscall-note llvm-exception lzma-exception mif-exception ocaml-lgpl-linking-exception
openjdk-assembly-exception-1.0 openvpn-openssl-exception qt-gpl-exception-1.0 qt-lgpl-exception-1.1
swift-exception u-boot-exception-2.0 universal-foss-exception-1.0 wxwindows-exception-3.1
""".split())

# how restrictive a licence is: an `and` is as restrictive as its strictest part,
# an `or` as its freest, a `with` exception makes a copyleft licence one step freer
LEVELS = ("public", "permissive", "weak-copyleft", "copyleft", "network-copyleft", "restricted")
_LEVEL = ((re.compile(r"(cc0|unlicense|public-domain|0bsd)"), 0), (re.compile(r"(.*-nc|.*-nd|.*proprietary|licenseref)"), 5),
          (re.compile(r"agpl"), 4), (re.compile(r"(gpl|cc-by-sa)"), 3), (re.compile(r"(lgpl|mpl|epl|cddl)"), 2))

_DROP = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_TAG_LINE = re.compile(r"(?i)(?:spdx[^0-9a-z\x80-\U0010ffff]+license[^0-9a-z\x80-\U0010ffff]+identifier|"
                       r"license[^0-9a-z\x80-\U0010ffff]+expression)\s*:[ \t]*([^\r\n]*)")
_TOKEN = re.compile(r"\s*(?:([()])|([A-Za-z0-9][A-Za-z0-9.+:-]*))")
_PRIORITY = {"or": 1, "and": 2, "with": 3}


def to_rpn(expression: str) -> list[str] | None:
    """Shunting-yard: the expression in postfix order (ids lower-cased), or None
    if it is ill-formed."""
    out: list[str] = []
    stack: list[str] = []
    operand = False  # does an operand stand just before?
    last = ""  # what stands just before: an operator or bracket, "id" or "exception"
    at, text = 0, expression.strip()
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            return None
        at, word = m.end(), (m[1] or m[2]).lower()
        if word == "(":
            if operand or last == "with":
                return None
            stack.append(word)
            last = word
        elif word == ")":
            if not operand:
                return None
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                return None
            stack.pop()
            last = word
        elif word in _PRIORITY:
            if not operand or word == "with" and last != "id":
                return None
            while stack and stack[-1] != "(" and _PRIORITY[stack[-1]] >= _PRIORITY[word]:
                out.append(stack.pop())
            stack.append(word)
            operand, last = False, word
        else:
            if operand:
                return None
            out.append(word)
            operand, last = True, "exception" if last == "with" else "id"
        if at < len(text) and text[at:].strip() == "":
            break
    if not operand or "(" in stack:
        return None
    return out + stack[::-1]


def known(rpn: list[str]) -> bool:
    """Are all ids in the tables, exceptions (the operand before a `with`) in theirs?"""
    for word, after in zip(rpn, [*rpn[1:], ""], strict=True):
        if word in _PRIORITY:
            continue
        if after == "with":
            if word not in EXCEPTION_IDS:
                return False
        elif word.removesuffix("+") not in LICENCE_IDS and not word.startswith(("licenseref-", "documentref-")):
            return False
    return True


def level_of(licence: str) -> int:
    """Index into LEVELS of a single licence id (permissive if unknown)."""
    return next((n for pattern, n in _LEVEL if pattern.match(licence)), 1)


def evaluate(rpn: list[str]) -> tuple[list[str], int]:
    """Licence ids named by the expression and its level."""
    names: list[str] = []
    stack: list[tuple[str, int]] = []
    for word in rpn:
        if word not in _PRIORITY:
            stack.append((word, level_of(word)))
            continue
        (right, b), (left, a) = stack.pop(), stack.pop()
        if word == "with":
            names.append(f"{left} with {right}")
            stack.append((f"{left} with {right}", a - 1 if a in (3, 4) else a))
        else:
            names += [x for x in (left, right) if x]
            stack.append(("", max(a, b) if word == "and" else min(a, b)))
    top, level = stack[0]
    return sorted({*names, *([top] if top else [])} - {x.split(" with ")[0] for x in names if " with " in x}), level


def automaton():
    import ahocorasick
    found = ahocorasick.Automaton()
    by_phrase: dict[str, list[tuple[str, str]]] = {}
    for kind, table in (("base", BASE), ("notice", NOTICES), ("tag", dict.fromkeys(TAGS, ""))):
        for phrase, label in table.items():
            by_phrase.setdefault(phrase, []).append((kind, label))
    for phrase, what in by_phrase.items():
        found.add_word(f" {phrase} ", (len(phrase) + 2, phrase.count(" ") + 1, what))
    found.make_automaton()
    return found


def scan(found, text: str | None) -> tuple[int, list[dict], list[dict]]:
    """Number of words, hits (label, kind, first word, words) and expressions."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_DROP).split(b" ")
    words = [w for w in words if w]
    line = f" {b' '.join(words).decode('latin-1')} "
    hits, places, at, word = [], 0, 0, 0
    for end, (length, n, what) in sorted(found.iter(line), key=lambda x: x[0] - x[1][0]):
        start = end - length + 1
        word, at = word + line.count(" ", at, start), start
        for kind, label in what:
            if kind == "tag":
                places += 1
            else:
                hits.append({"label": label, "kind": kind, "word": word, "words": n})
    expressions = []
    if places:
        for m in _TAG_LINE.finditer(text):
            written = re.split(r"\*/|-->|#>|\"|'|;", m[1])[0].strip().rstrip(".,")
            rpn = to_rpn(written)
            if rpn is None or not known(rpn):
                hits.append({"label": None, "kind": "unparsed", "word": None, "words": 0})
                continue
            names, level = evaluate(rpn)
            expressions.append({"text": written, "rpn": rpn, "licences": names, "level": LEVELS[level]})
            hits += [{"label": x, "kind": "tag", "word": None, "words": 0} for x in names]
    return len(words), hits, expressions


_HIT = pa.struct([("label", pa.string()), ("kind", pa.string()), ("word", pa.int64()), ("words", pa.int32())])
_EXPR = pa.struct([("text", pa.string()), ("rpn", pa.list_(pa.string())), ("licences", pa.list_(pa.string())), ("level", pa.string())])


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: id, n_words, hits, expressions."""
    python_ready(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton()
        for part in slices(batches, "text"):
            done = [scan(found, t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array([x[0] for x in done], pa.int64()),
                 pa.array([x[1] for x in done], pa.list_(_HIT)), pa.array([x[2] for x in done], pa.list_(_EXPR))],
                ["id", "n_words", "hits", "expressions"])
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_words long, hits array<struct<label:string,kind:string,word:long,words:int>>, "
                                "expressions array<struct<text:string,rpn:array<string>,licences:array<string>,level:string>>"
                           ).withColumnRenamed("id", id_col)
