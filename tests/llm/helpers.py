"""Small tables with the odd cases that every operator must bear."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: names that operators use inside, as columns of the table
CLASH = "size long, id long, bucket string, class long, root long, h long, pos int, word string, kind int, key long"


def words(rng: random.Random, n: int, letters: str = "abcdefghij") -> str:
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


def odd_rows() -> list[tuple]:
    rng = random.Random(7)
    rows = [(1, None, "en", "s1"), (2, "", "en", "s1"), (3, " \t\n  ", None, "s2"), (4, "...!!! 123", "en", None),
            (None, words(rng, 30), "en", "s1"), (5, words(rng, 30), None, None)]
    rows += [(6, "same text here and more of it for all", "en", "s3")] * 3
    rows += [(7, words(rng, 40000), "en", "s1"), (8, "x" * 200_000, "en", "s2"), (9, "é́ÅΣ 漢字 \U0001F600 <|endoftext|> it's", "fr", "s2")]
    rows += [(10 + i, words(rng, rng.randint(1, 60), "klmnopqrst" if i % 2 else "abcdefghij"), "fr" if i % 2 else "en", f"s{i % 4}") for i in range(20)]
    return rows


def frame(spark, rows, clash: bool = False):
    full = [(i, t, la, s, None if t is None else len(t)) for i, t, la, s in rows]
    df = spark.createDataFrame([(*r, 0, 0, "b", 0, 0, 0, 0, "w", 0, 0) if clash else r for r in full], f"{DOCS}, {CLASH}" if clash else DOCS)
    return df.repartition(3)


def odd(spark):
    return frame(spark, odd_rows(), clash=True)


def empty(spark):
    return frame(spark, [])
