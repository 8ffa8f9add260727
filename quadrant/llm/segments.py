"""Pre-tokenisation of the word-end BPE vocabularies, on whole slices of texts at
once: normal form C, lower case, then contractions, letter runs, single numbers
and runs of other characters; white space only separates.

Texts become one array of code points; token borders come from a class table.
"""

from __future__ import annotations

import unicodedata

import numpy as np

#: White space of the tokenizer's pattern language.
SPACE = "\t\n\x0b\x0c\r \x85\xa0                　"
LETTER, NUMBER, OTHER, SPECIAL = 1, 2, 3, 4
#: Special tokens stand in the array as lone surrogates, which no text can hold.
SPECIAL_CP = 0xD800

_classes: np.ndarray | None = None


def classes() -> np.ndarray:
    """Class of every code point (0: white space), made once a process."""
    global _classes
    if _classes is None:
        kind = {"L": LETTER, "N": NUMBER}
        table = np.fromiter((kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
        table[[ord(c) for c in SPACE]] = 0
        table[SPECIAL_CP:SPECIAL_CP + 0x800] = SPECIAL
        _classes = table
    return _classes


def normalized(text: str | None, specials: list[str]) -> str:
    if not text:
        return ""
    if "<|" in text:
        for i, special in enumerate(specials):
            text = text.replace(special, chr(SPECIAL_CP + i))
    if not text.isascii() and not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    return text.replace("Σ", "σ").lower()  # capital sigma has one lower case here, in any place


def segment(texts: list[str | None], specials: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, str]:
    """Code points of all texts, starts and ends of the tokens in them, the number
    of tokens before each text and at the end, and the string of the code points."""
    ready = [normalized(t, specials) for t in texts]
    whole = "\n".join(ready)
    points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass") + b"\0" * 12, "<u4")
    n = len(points) - 3
    cls = classes()[points[:n]]
    before = np.zeros_like(cls)
    before[1:] = cls[:-1]
    start = (cls != 0) & ((cls != before) | (cls == NUMBER) | (cls == SPECIAL))
    quote = np.flatnonzero((points[:n] == 39) & (before != OTHER))
    if len(quote):
        a, b = points[quote + 1], points[quote + 2]
        one = (a == 115) | (a == 116) | (a == 109) | (a == 100)  # s t m d
        two = ((a == 114) & (b == 101)) | ((a == 118) & (b == 101)) | ((a == 108) & (b == 108))  # re ve ll
        length = np.where(one, 2, np.where(two, 3, 0))
        quote, length = quote[length > 0], length[length > 0]
        start[quote + 1] = False
        after = quote + length
        after = after[after < n]
        start[after[cls[after] != 0]] = True
    edges = np.flatnonzero(start | ((cls == 0) & (before != 0)))
    opens = start[edges]
    starts, ends = edges[opens], np.append(edges[1:], n)[opens]
    borders = np.cumsum([0] + [len(t) + 1 for t in ready])
    return points[:n], starts, ends, np.searchsorted(starts, borders), whole


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n - 1 of the base and of its inverse, kept for the next slices."""
    global _powers
    if len(_powers[0]) < n:
        tables = []
        for root in (_BASE, _INVERSE):
            steps = np.full(n, root, np.uint64)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        _powers = (tables[0], tables[1])
    return _powers


def distinct_words(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, which): the number of the first of each distinct word, and of each word
    the distinct one that it is. Words are told apart by two 64-bit hashes of their
    characters, from running sums over the slice."""
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    up, down = _power_tables(len(points) + 1)
    keys = []
    for salt in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        letter = (points.astype(np.uint64) + np.uint64(1)) * np.uint64(salt)
        letter ^= letter >> np.uint64(29)
        letter *= np.uint64(salt)
        letter *= up[:len(points)]
        sums = np.zeros(len(points) + 1, np.uint64)
        np.cumsum(letter, out=sums[1:])
        keys.append((sums[ends] - sums[starts]) * down[starts])
    _, first, which = np.unique(keys[0], return_index=True, return_inverse=True)
    if (keys[1][first][which] != keys[1]).any():  # two words share the first hash: both decide
        _, first, which = np.unique(np.stack(keys, 1), axis=0, return_index=True, return_inverse=True)
    return first, which.reshape(-1)
